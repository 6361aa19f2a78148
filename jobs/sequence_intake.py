"""Measures sequences as their files come in, and counts the copies of each.

    python -m jobs.sequence_intake jobs/sequence_intake.json --source documents.parquet --output folder

A file stream over the texts, read as sequences: each new file is taken once. Every micro-batch
writes measures (length, N and GC counts, terminal inverted repeats, digest of the sequence or its
reverse complement, whichever is smaller) by batch and bucket of digests, then renews the copies
table in the buckets that it touched. A batch that is run again replaces what it wrote. The
checkpoint lies beside the tables and belongs to them; two runs into one output must not overlap.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators.sequences import reverse_complement, terminal_inverted_repeat
from spanforge.sources.hits import sequence_of
from spanforge.sources.store import read_or_none

log = logging.getLogger(__name__)

MEASURES = ["doc_id", "source", "lang", "length", "n_count", "gc_count", "digest", "tir_0", "tir_1", "tir_2", "tir_3"]


def count_of(seq: str, letters: str) -> Column:
    return (F.char_length(seq) - F.char_length(F.translate(seq, letters, ""))).cast("bigint")


def measured(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang, source) with the measures of their sequences, and bucket of the digest."""
    rows = docs.select("doc_id", "source", "lang", sequence_of(F.col("text")).alias("seq"))
    digest = F.sha2(F.least("seq", reverse_complement(F.col("seq"))), 256)
    own = F.struct("doc_id", "source", "lang", F.char_length("seq").cast("bigint").alias("length"), count_of("seq", "N").alias("n_count"), count_of("seq", "CG").alias("gc_count"), digest.alias("digest"))
    found = terminal_inverted_repeat(rows.select(own.alias("id"), "seq"))
    return found.select("id.*", "tir_0", "tir_1", "tir_2", "tir_3").withColumn("bucket", F.conv(F.substring("digest", 1, 1), 16, 10).cast("int"))


def run(spark: SparkSession, source: str, output: str, max_files: int = 1000) -> DataFrame | None:
    """Take the files of source that are new, wait for the end, and return measures with copies; None where there never was a row."""
    schema = spark.read.parquet(source).schema
    # as a pattern that matches source alone, since a stream takes one file by a pattern only
    place = source.rstrip("/")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{place[:-1]}[{place[-1]}]")
    replace = lambda df, *by: df.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic")

    def take(docs: DataFrame, batch: int) -> None:
        session = docs.sparkSession
        replace(measured(docs).withColumn("batch", F.lit(batch)), "batch", "bucket").parquet(f"{output}/measures")
        every = read_or_none(session, f"{output}/measures")
        touched = {} if every is None else {r["bucket"]: r["n"] for r in every.filter(F.col("batch") == batch).groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        log.info("batch %d of %s: wrote %d rows to %s/measures, buckets %s", batch, source, sum(touched.values()), output, sorted(touched))
        if touched:
            copies = every.filter(F.col("bucket").isin(sorted(touched))).groupBy("bucket", "digest").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_id"), F.count_distinct("source").alias("n_sources"))
            replace(copies, "bucket").parquet(f"{output}/copies")
            log.info("renewed %s/copies in %d buckets", output, len(touched))

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{output}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d new rows of %s", sum(p["numInputRows"] for p in query.recentProgress), source)
    return read(spark, output)


def read(spark: SparkSession, output: str) -> DataFrame | None:
    """Measures of all sequences with the number of copies, the smallest id among them and their sources."""
    measures, copies = (read_or_none(spark, f"{output}/{name}") for name in ("measures", "copies"))
    return None if copies is None else measures.join(copies, ["bucket", "digest"]).select(*MEASURES, "n_copies", "first_id", "n_sources")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("config")
    parser.add_argument("--source")
    parser.add_argument("--output")
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("sequence_intake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        config = json.loads(spark.read.text(given.config, wholetext=True).first()[0])
        config |= {k: v for k, v in vars(given).items() if k != "config" and v}
        run(spark, config["source"], config["output"], config["max_files"])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
