"""Permutation p-values as aggregates: rounds are rows, and a statistic is an expression.

A round orders a group's rows by a digest of its number and the row's name. Places are made from
counts of digest prefixes and places inside them, so no task orders a whole group. Round 0 gives
the places that stay; in every other round the value y of the row in a place meets x of the row
that has this place in round 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Statistic = Callable[[Column, Column], Column]


def correlation(x: Column, y: Column) -> Column:
    """Pearson's; of ranks Spearman's. Null where either side doesn't vary."""
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def rank_sum_excess(x: Column, y: Column) -> Column:
    """U of the rows with x = 1 against those with 0, over ranks y, less its mean. Null where a side is empty."""
    n1, n0 = F.count_if(x == 1), F.count_if(x == 0)
    return F.when((n1 > 0) & (n0 > 0), F.sum(F.when(x == 1, y)) - n1 * (n1 + 1) / 2 - n1 * n0 / 2)


def average_ranks(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """rows with the rank of value in its group, from 1, ties sharing their mean.

    Values are counted first, so what is ordered is a group's distinct values; a null value has no rank.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # as one value, in which null equals null
    key = F.struct(*by, value).alias("__key")
    ranks = counts.select(key, (before + (F.col("__n") + 1) / 2).alias(name))
    return rows.withColumn("__key", key).join(ranks, "__key", "left").drop("__key")


def places(rows: DataFrame, by: list[str], row: str, first: int, last: int) -> DataFrame:
    """by, row, round, place for rounds first to last: the row's place, from 1, by md5 of 'round:row' in its group."""
    dealt = rows.select(*by, row, F.explode(F.sequence(F.lit(first), F.lit(last))).alias("round"))
    dealt = dealt.withColumn("draw", F.md5(F.concat(F.col("round").cast("string"), F.lit(":"), F.col(row).cast("string")))).withColumn("part", F.substring("draw", 1, 2))
    before = Window.partitionBy(*by, "round").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*by, "round", "part").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy(*by, "round", "part").orderBy("draw", row))
    return dealt.join(starts, [*by, "round", "part"]).select(*by, row, "round", (F.col("start") + inside).alias("place"))


def permutation_p(rows: DataFrame, by: list[str], row: str, x: str, y: str, statistic: Statistic = correlation, rounds: int = 200) -> DataFrame:
    """rows(by, row, x, y) as by, n, observed, p: the share of rounds at least as far from 0, (hits + 1) / (rounds + 1).

    Rows where x or y is null are left out; row names rows of a group apart; a group with a null
    key is none. Without an observed value there is no p.
    """
    pairs = rows.select(*by, row, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL").dropna(subset=by)
    observed = pairs.groupBy(*by).agg(F.count("*").alias("n"), statistic(F.col("x"), F.col("y")).alias("observed"))
    fixed = places(pairs, by, row, 0, 0).join(pairs.select(*by, row, "x"), [*by, row]).select(*by, "place", "x")
    dealt = places(pairs, by, row, 1, rounds).join(pairs.select(*by, row, "y"), [*by, row]).select(*by, "round", "place", "y")
    null = dealt.join(fixed, [*by, "place"]).groupBy(*by, "round").agg(statistic(F.col("x"), F.col("y")).alias("value"))
    # sums of the same numbers in another order differ in their last digits
    far = F.abs("value") >= F.abs("observed") * (1 - 1e-9) - 1e-9
    hits = null.join(observed, by).groupBy(*by).agg(F.count_if(far).alias("hits"))
    return observed.join(hits, by, "left").select(*by, "n", "observed", F.when(F.col("observed").isNotNull(), (F.coalesce("hits", F.lit(0)) + 1) / (rounds + 1)).alias("p"))
