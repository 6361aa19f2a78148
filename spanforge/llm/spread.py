"""Equi-joins that deal the rows of a hot key over many tasks."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one part in HOT of all rows is dealt over tasks; there can't be more such keys than this.
HOT = 4096
#: Fewer rows under a key are left as they are.
FEW = 256


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hot_keys(rows: DataFrame, key: str, length: str | None = None) -> dict:
    """The keys whose rows are dealt over tasks, at most HOT of them, with the number of parts of each.

    length: a column that counts the rows of each key, where rows has one row a key. rows should be cut.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n")) if length is None else rows.select(key, F.col(length).alias("n"))
    # a key with more than one part in HOT of all rows is among the HOT most frequent
    top = counts.filter((F.col("n") > FEW) & F.col(key).isNotNull()).orderBy(F.desc("n")).limit(HOT).collect()
    if not top:
        return {}
    total = rows.count() if length is None else counts.agg(F.sum("n")).first()[0]
    share = max(total / HOT, FEW)
    return {k: math.ceil(n / share) for k, n in top if n > share}


def spread_join(rows: DataFrame, values: DataFrame, key: str, hot: dict, by: list[str] | None = None) -> DataFrame:
    """rows joined with values, which has one row a key, by key (inner; null keys join with nothing).

    Rows of a key of hot (``hot_keys``) go to as many tasks as hold a share of 1 / HOT each, by a hash
    of the columns by (all by default), and its value is sent to all of these: at most 2 * HOT
    values are repeated, whatever the input.
    """
    if not hot:
        return rows.join(values, key)
    known = F.broadcast(rows.sparkSession.createDataFrame(pa.table({key: list(hot), "__parts": list(hot.values())}), f"{key} {values.schema[key].dataType.simpleString()}, __parts int"))
    parts = F.coalesce("__parts", F.lit(1))
    dealt = rows.join(known, key, "left").withColumn("__part", F.pmod(F.xxhash64(*(by or rows.columns)), parts).cast("int")).drop("__parts")
    repeated = values.join(known, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return dealt.join(repeated, [key, "__part"]).drop("__part")
