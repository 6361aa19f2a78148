"""Permutation p-values against plain rounds over the same orders."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.operators import permutation

PAIR = "g string, id long, x double, y double"


def plain_p(rows, statistic, rounds):
    """p of rows [(id, x, y)], each round in the order of its digests."""
    order = lambda r: sorted(range(len(rows)), key=lambda i: (hashlib.md5(f"{r}:{rows[i][0]}".encode()).hexdigest(), rows[i][0]))
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    seen, fixed = statistic(x, y), order(0)
    null = [statistic(x[fixed], y[order(r)]) for r in range(1, rounds + 1)]
    return seen, (sum(abs(v) >= abs(seen) - 1e-9 for v in null) + 1) / (rounds + 1)


def excess(x, y):
    n1, n0 = (x == 1).sum(), (x == 0).sum()
    return y[x == 1].sum() - n1 * (n1 + 1) / 2 - n1 * n0 / 2


@pytest.mark.parametrize(("statistic", "plain"), [(permutation.correlation, lambda x, y: float(np.corrcoef(x, y)[0, 1])), (permutation.rank_sum_excess, excess)])
def test_p_is_that_of_plain_rounds(spark, statistic, plain):
    rng = np.random.default_rng(2)
    groups = {"a": 40, "b": 700, "c": 5}
    rows = [(g, i, float(rng.integers(0, 2)), float(rng.integers(0, 9)) + (i % 2) * (g == "a")) for g, n in groups.items() for i in range(n)]
    got = {r["g"]: r for r in permutation.permutation_p(spark.createDataFrame(rows, PAIR), ["g"], "id", "x", "y", statistic, 60).collect()}
    for g, n in groups.items():
        seen, p = plain_p([r[1:] for r in rows if r[0] == g], plain, 60)
        assert got[g]["n"] == n and got[g]["observed"] == pytest.approx(seen) and got[g]["p"] == pytest.approx(p)


def test_groups_without_an_observed_value_have_no_p(spark):
    rows = [("flat", 1, 1.0, 2.0), ("flat", 2, 1.0, 3.0), ("one", 1, 1.0, 1.0), (None, 1, 1.0, 2.0), ("nulls", 1, None, 2.0), ("nulls", 2, 1.0, 2.0)]
    got = {r["g"]: (r["n"], r["observed"], r["p"]) for r in permutation.permutation_p(spark.createDataFrame(rows, PAIR), ["g"], "id", "x", "y", rounds=9).collect()}
    assert got == {"flat": (2, None, None), "one": (1, None, None), "nulls": (1, None, None)}
    assert permutation.permutation_p(spark.createDataFrame([], PAIR), ["g"], "id", "x", "y").count() == 0


def test_places_are_a_permutation_and_not_made_by_one_task(spark):
    rows = spark.range(3000).select(F.lit("g").alias("g"), F.col("id"))
    made = permutation.places(rows, ["g"], "id", 1, 3)
    for r in (1, 2, 3):
        assert sorted(x[0] for x in made.filter(f"round = {r}").select("place").collect()) == list(range(1, 3001))
    orders = {tuple(x[0] for x in made.filter(f"round = {r}").orderBy("id").select("place").collect()) for r in (1, 2, 3)}
    assert len(orders) == 3
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and plan.count("SinglePartition") == 0


def test_average_ranks(spark):
    rows = [("a", i, v, 0.0) for i, v in enumerate([3.0, 1.0, 3.0, None, 2.0, 3.0])] + [(None, 9, 5.0, 0.0), (None, 10, 5.0, 0.0)]
    got = {r["id"]: r["r"] for r in permutation.average_ranks(spark.createDataFrame(rows, PAIR), ["g"], "x", "r").collect()}
    assert got == {0: 4.0, 1: 1.0, 2: 4.0, 3: None, 4: 2.0, 5: 4.0, 9: 1.5, 10: 1.5}
