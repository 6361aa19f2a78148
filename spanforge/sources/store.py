"""An annotation store: hits as Parquet by tool and bucket of families, sorted by family and place.

A family lies in one bucket, so reading it prunes to that partition and, as files are sorted, to
few row groups. Each batch of hits is a partition of its own below; writing it again replaces it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ["tool", "bucket", "batch"]
MARKS = "batch int, low bigint, high bigint, n_new bigint, buckets int"


def bucket_of(family: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(family), F.lit(buckets)).cast("int")


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at path; None where nothing is there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def marks(spark: SparkSession, store: str) -> list:
    """The finished batches in order, a row for each run that found new hits."""
    done = read_or_none(spark, f"{store}/marks", MARKS)
    return [] if done is None else done.orderBy("batch").collect()


def write_batch(hits: DataFrame, store: str, batch: int, buckets: int) -> DataFrame:
    """Put hits(tool, family, chrom, s, e, ...) into the store with hit_len, as batch number ``batch``; the batch as it is stored."""
    rows = hits.withColumn("hit_len", F.col("e") - F.col("s")).withColumn("bucket", bucket_of(F.col("family"), buckets)).withColumn("batch", F.lit(batch))
    # ranges, so that a family of very many hits is dealt over tasks
    order = ["tool", "bucket", "family", "chrom", "s"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(*PARTS).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{store}/hits")
    return read_hits(hits.sparkSession, store).filter(F.col("batch") == batch)


def read_hits(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/hits").withColumn("tool", F.col("tool").cast("string"))


def read_family(spark: SparkSession, store: str, tool: str, family: str) -> DataFrame:
    """The hits of one family, from its partition alone."""
    buckets = marks(spark, store)[-1]["buckets"]
    return read_hits(spark, store).filter((F.col("tool") == tool) & (F.col("bucket") == bucket_of(F.lit(family), buckets)) & (F.col("family") == family))


def write_mark(spark: SparkSession, store: str, batch: int, low: int | None, high: int, n_new: int, buckets: int) -> None:
    """Say that a batch is finished; the last step of a run."""
    spark.createDataFrame([(batch, low, high, n_new, buckets)], MARKS).coalesce(1).write.mode("append").parquet(f"{store}/marks")
