"""Takes new annotations into a store and renews the evidence of the families they belong to.

    python -m jobs.annotation_store jobs/annotation_store.json --source lineitem.parquet --store folder

The source is a growing table of order lines, read as hits; its key only rises. The store has three
tables: hits (by tool, bucket of families and batch), evidence (by tool and bucket) and marks. A run
takes the rows whose key is beyond the last mark, writes them as the next batch, renews evidence in
the partitions that got hits, and marks the batch as finished. A run that ends early leaves no mark:
the next one takes the same rows, and more if there are, and replaces what was written. Without new
rows nothing is written. Two runs into one store must not overlap.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators.evidence import family_evidence
from spanforge.sources import store as stored
from spanforge.sources.hits import hits_of

log = logging.getLogger(__name__)

KEY = "l_orderkey"


def run(spark: SparkSession, source: str, store: str, buckets: int = 16) -> DataFrame | None:
    """Take what is new in source into store; the whole evidence, or None where there never were hits."""
    done = stored.marks(spark, store)
    if done and done[-1]["buckets"] != buckets:
        raise ValueError(f"the store has {done[-1]['buckets']} buckets, not {buckets}")
    low = done[-1]["high"] if done else None
    lines = spark.read.parquet(source)
    new = lines.filter(F.col(KEY).isNotNull()) if low is None else lines.filter(F.col(KEY) > low)
    n_new, high = new.agg(F.count("*"), F.max(KEY)).first()
    log.info("read %s beyond %s: %d new rows up to %s", source, low, n_new, high)
    if n_new:
        batch = len(done)
        # rows that come in while this runs are left to the next one
        part = stored.write_batch(hits_of(new.filter(F.col(KEY) <= high)), store, batch, buckets)
        touched = part.groupBy("tool", "bucket").agg(F.count("*").alias("n")).collect()
        log.info("wrote %d hits to %s/hits, batch %d, %d partitions", sum(r["n"] for r in touched), store, batch, len(touched))
        _renew(spark, store, [(r["tool"], r["bucket"]) for r in touched])
        stored.write_mark(spark, store, batch, low, high, n_new, buckets)
    return stored.read_or_none(spark, f"{store}/evidence")


def _renew(spark: SparkSession, store: str, touched: list[tuple[str, int]]) -> None:
    """Evidence of all families in the partitions touched, which are no more than tools times buckets."""
    near = F.col("tool").isin(sorted({t for t, _ in touched})) & F.col("bucket").isin(sorted({b for _, b in touched}))
    own = F.broadcast(spark.createDataFrame(touched, "tool string, bucket int"))
    hits = stored.read_hits(spark, store).filter(near).join(own, ["tool", "bucket"], "left_semi")
    buckets = hits.groupBy("tool", "family").agg(F.first("bucket").alias("bucket"))
    rows = family_evidence(hits).join(buckets, ["tool", "family"])
    rows.write.partitionBy("tool", "bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{store}/evidence")
    log.info("renewed %s/evidence in %d partitions", store, len(touched))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("config")
    parser.add_argument("--source")
    parser.add_argument("--store")
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("annotation_store").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        config = json.loads(spark.read.text(given.config, wholetext=True).first()[0])
        config |= {k: v for k, v in vars(given).items() if k != "config" and v}
        run(spark, config["source"], config["store"], config["buckets"])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
