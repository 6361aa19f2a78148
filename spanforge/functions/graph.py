"""Graph operators on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.session import cut, remove_table, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """edges as node, component: the smallest node that can be reached, itself included.

    Each round points every node at the smallest of its neighbours and itself, follows the
    pointers by doubling until they rest, and goes on with the edges between what is left: those
    inside a component are gone, so the rounds' sizes fall. Rounds are written tables, which carry
    no plan on; one that has been used is deleted.
    """
    old: list[str] = []

    def step(df: DataFrame) -> DataFrame:
        out, path = written(df, "components")
        old.append(path)
        return out

    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    left = step(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = step(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")))
    left = left.filter("a <> b")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = step(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("to"), F.lit(True).alias("moved")))
        while not to.filter("moved AND node <> to").isEmpty():
            onward = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            to = step(to.join(onward, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
        labels = step(labels.join(to.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        moved = left.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        left = step(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        for path in old[:-2]:
            remove_table(edges.sparkSession, path)
        del old[:-2]
    labels = cut(labels)
    for path in old:
        remove_table(edges.sparkSession, path)
    return labels


def spanning_forest(edges: DataFrame) -> DataFrame:
    """The maximum spanning forest of edges(a, b, w): of all edges ordered by (w, a, b) those that no path of larger ones joins already.

    In each round every component takes its largest edge to another one, which the forest always
    has, and components that such edges join become one. As no two edges are equal, the choices
    form trees with one pair of components each that chose the same edge: the smaller is the root.
    Rounds are written tables; components at least halve in each.
    """
    spark = edges.sparkSession
    old: list[str] = []

    def step(df: DataFrame, name: str) -> DataFrame:
        out, path = written(df, name)
        old.append(path)
        return out

    rows = edges.filter("a <> b").select(F.struct("w", "a", "b").alias("edge"), F.col("a").alias("x"), F.col("b").alias("y"))
    rows = step(rows.distinct(), "forest-edges")
    forest = rows.select("edge").limit(0)
    while not rows.isEmpty():
        both = rows.unionByName(rows.select("edge", F.col("y").alias("x"), F.col("x").alias("y")))
        best = step(both.groupBy("x").agg(F.max(F.struct("edge", "y")).alias("best")).select("x", "best.edge", F.col("best.y").alias("to")), "forest-best")
        forest = step(forest.unionByName(best.select("edge").distinct()), "forest")
        back = best.select(F.col("x").alias("to"), F.col("to").alias("back"))
        to = step(best.join(back, "to").select("x", F.when((F.col("back") == F.col("x")) & (F.col("x") < F.col("to")), F.col("x")).otherwise(F.col("to")).alias("to"), F.lit(True).alias("moved")), "forest-roots")
        while not to.filter("moved").isEmpty():
            onward = to.select(F.col("x").alias("to"), F.col("to").alias("next"))
            to = step(to.join(onward, "to").select("x", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "forest-roots")
        ends = [to.select(F.col("x").alias(c), F.col("to").alias(f"root_{c}")) for c in ("x", "y")]
        moved = rows.join(ends[0], "x").join(ends[1], "y").select("edge", F.col("root_x").alias("x"), F.col("root_y").alias("y"))
        rows = step(moved.filter("x <> y"), "forest-edges")
    out = cut(forest.select("edge.a", "edge.b", "edge.w"))
    for path in old:
        remove_table(spark, path)
    return out
