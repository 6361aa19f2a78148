"""Rows that can't be used, dropped and counted by reason in the pass that reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

KEPT = "kept"


def split(df: DataFrame, reasons: dict[str, Column], name: str | None = None) -> tuple[DataFrame, Observation]:
    """The rows of df that no reason holds for, and how many rows each reason dropped once they have been read.

    The first reason that holds counts; one that is null doesn't hold.
    """
    why = F.lit(None).cast("string")
    for reason, holds in reversed(list(reasons.items())):
        why = F.when(F.coalesce(holds, F.lit(False)), reason).otherwise(why)
    seen = Observation(name) if name else Observation()
    marked = df.withColumn("__why", why)
    counts = [F.count_if(F.col("__why") == reason).alias(reason) for reason in reasons]
    return marked.observe(seen, F.count_if(F.col("__why").isNull()).alias(KEPT), *counts).filter("__why IS NULL").drop("__why"), seen


def counts(spark: SparkSession, seen: Observation) -> DataFrame:
    """reason, n of an observation whose rows have been read."""
    return spark.createDataFrame(sorted(seen.get.items()), "reason string, n bigint")
