"""Families of several tools as a graph: edges, mutual-best and density linkage, votes, gates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.functions.graph import connected_components, spanning_forest
from spanforge.operators.intervals import TILE, in_tiles, paint, point_join, sweep, tiled
from spanforge.session import cut
from spanforge.settings import DEFAULT, Settings


#: Classification paths that don't vote (fixed values).
VAGUE_PATHS = ["", "repeat", "repeat:TE"]


#: Paths of families that aren't interspersed repeats begin with one of these (fixed values).
OTHER_PATHS = ("repeat:tandem", "repeat:multigene", "repeat:artefact")
#: Scopes of tools whose families are clustered (fixed values).
SCOPES = ("general_homology", "structural_te", "ltr_only")


def repeat_families(rows: DataFrame, path: str = "path", name: str = "family") -> DataFrame:
    """rows whose path is none of OTHER_PATHS and whose name is no simple repeat's, which begins with a bracket; a null path stays."""
    other = F.coalesce(F.col(path), F.lit(""))
    out = F.lit(False)
    for prefix in OTHER_PATHS:
        out |= other.startswith(prefix)
    return rows.filter(~out & ~F.coalesce(F.col(name).startswith("("), F.lit(False)))


def tool_status(hits: DataFrame) -> DataFrame:
    """hits(tool, family, cons_start) as a row a tool: counts, share with consensus coordinates, whether it names each copy or hardly names any."""
    rows = hits.groupBy("tool").agg(F.count("*").alias("n_hits"), F.count_distinct("family").alias("n_names"), F.avg(F.col("cons_start").isNotNull().cast("double")).alias("coord_fraction"))
    return rows.withColumn("per_copy_ids", F.expr("n_names = n_hits AND n_hits > 100")).withColumn("mask_only", F.expr("n_names <= 3 AND n_hits > 1000"))


def eligible_tools(manifest: DataFrame, status: DataFrame) -> DataFrame:
    """manifest(tool, scope) with its tools' status, ran (whether it has hits) and clusterable: it ran, names families and has a scope of SCOPES."""
    rows = manifest.join(status.withColumn("ran", F.lit(True)), "tool", "left").withColumn("ran", F.coalesce("ran", F.lit(False)))
    named = F.coalesce(~F.col("per_copy_ids") & ~F.col("mask_only"), F.lit(False))
    return rows.withColumn("clusterable", F.col("ran") & named & F.coalesce(F.col("scope").isin(*SCOPES), F.lit(False)))


def footprints(painted: DataFrame) -> DataFrame:
    return painted.groupBy("tool", "family").agg(F.sum(F.col("e") - F.col("s")).cast("bigint").alias("footprint"))


def _for_tools(rows: DataFrame, hits: DataFrame, tool: str, name: str, after: bool) -> DataFrame:
    """rows once for each other tool of hits, as column ``name``: only later ones if ``after``. Tools are few."""
    tools = F.array(*[F.lit(r["tool"]) for r in hits.select("tool").distinct().orderBy("tool").collect() if r["tool"] is not None]).cast("array<string>")
    return rows.withColumn(name, F.explode(F.filter(tools, lambda t: t > F.col(tool) if after else t != F.col(tool))))


def joint_bases(hits: DataFrame) -> DataFrame:
    """tool_a, family_a, tool_b, family_b, bp: bases that a family of one tool and a family of a later one own both, as the last to be painted there; without tool_b, all that a family owns.

    A tile of a chromosome holds the hits of all tools, so each tool is painted there and the
    pieces are laid over each other at once: no pieces are joined, and only sums leave the tile.
    """
    rows = tiled(hits.filter("tool IS NOT NULL AND e > s").select("chrom", "tool", "family", "s", "e", "ord"), TILE)
    columns = ["chrom", "tile", "tool", "s", "e", "family"]
    made = in_tiles(rows, ["chrom", "tile"], ["tool", "ord", "family"], columns, _joint, "tool_a string, family_a string, tool_b string, family_b string, bp long")
    return made.groupBy("tool_a", "family_a", "tool_b", "family_b").agg(F.sum("bp").alias("bp"))


def _joint(part: pa.Table) -> pa.Table:
    """``joint_bases`` of whole tiles; chromosomes without a name share no bases."""
    painted = sweep(part, ["chrom", "tool"], "family")
    chrom, tool, family = (painted.column(c).combine_chunks().dictionary_encode() for c in ("chrom", "tool", "family"))
    named, families = chrom.is_valid().to_numpy(False), len(family.dictionary) + 1
    at, code = pc.fill_null(tool.indices, 0).to_numpy().astype(np.int64), pc.fill_null(family.indices, families - 1).to_numpy().astype(np.int64)
    s, e = painted.column("s").to_numpy(), painted.column("e").to_numpy()
    out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for x in range(len(tool.dictionary)):
        out.append((x, -1, code[at == x], (e - s)[at == x]))
    # all chromosomes on one line, of which each point begins a segment
    base = pc.fill_null(chrom.indices, 0).to_numpy().astype(np.int64) * ((e.max() if len(e) else 0) - min(s.min() if len(s) else 0, 0) + 1)
    points = np.unique(np.concatenate([s + base, e + base]))
    width = np.append(np.diff(points), 0)
    owners = []
    for x in range(len(tool.dictionary)):
        mine = np.flatnonzero((at == x) & named)
        mine = mine[np.argsort(s[mine] + base[mine])]
        owner = np.full(len(points), -1, np.int64)
        if len(mine):
            last = np.searchsorted(s[mine] + base[mine], points, "right") - 1
            inside = (last >= 0) & ((e[mine] + base[mine])[last] > points)
            owner[inside] = code[mine[last[inside]]]
        owners.append(owner)
    order = sorted(range(len(owners)), key=lambda x: tool.dictionary[x].as_py())
    for i, x in enumerate(order):
        for y in order[i + 1 :]:
            both = np.flatnonzero((owners[x] >= 0) & (owners[y] >= 0))
            out.append((x, y, owners[x][both] * families + owners[y][both], width[both]))
    columns: dict[str, list] = {c: [] for c in ("tool_a", "family_a", "tool_b", "family_b", "bp")}
    names = [*family.dictionary.to_pylist(), None]
    for x, y, pair, bp in out:
        kinds, place = np.unique(pair, return_inverse=True)
        total = np.zeros(len(kinds), np.int64)
        np.add.at(total, place, bp)
        one, other = (kinds, None) if y < 0 else (kinds // families, kinds % families)
        columns["tool_a"] += [tool.dictionary[x].as_py()] * len(kinds)
        columns["family_a"] += [names[k] for k in one.tolist()]
        columns["tool_b"] += [None if y < 0 else tool.dictionary[y].as_py()] * len(kinds)
        columns["family_b"] += [None] * len(kinds) if other is None else [names[k] for k in other.tolist()]
        columns["bp"] += total.tolist()
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.table([pa.array(v, k) for v, k in zip(columns.values(), kinds, strict=True)], names=list(columns))


def edges(hits: DataFrame, min_joint: int, min_reciprocal: float) -> DataFrame:
    """Pairs of families of different tools: a, b, joint_bp, w_bp = joint over the smaller footprint."""
    bases = cut(joint_bases(hits))
    joint = bases.filter("tool_b IS NOT NULL").withColumnRenamed("bp", "joint_bp")
    size = bases.filter("tool_b IS NULL")
    for side in ("a", "b"):
        joint = joint.join(size.select(F.col("tool_a").alias(f"tool_{side}"), F.col("family_a").alias(f"family_{side}"), F.col("bp").alias(f"size_{side}")), [f"tool_{side}", f"family_{side}"])
    least = F.least("size_a", "size_b")
    kept = joint.filter((F.col("joint_bp") >= min_joint) & (F.col("joint_bp") >= min_reciprocal * least))
    return kept.select(F.expr("tool_a || ':' || family_a").alias("a"), F.expr("tool_b || ':' || family_b").alias("b"), "joint_bp", (F.col("joint_bp") / least).alias("w_bp"))


def coannotation(hits: DataFrame) -> DataFrame:
    """For each family and family of another tool: the share of its hits whose midpoint the other has painted."""
    painted = paint(hits, ["tool", "chrom"], "family", F.col("ord")).select("chrom", F.col("tool").alias("other_tool"), F.col("family").alias("other_family"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    middle = _for_tools(hits.select("tool", "family", "chrom", F.expr("(s + e) div 2").alias("mid")), hits, "tool", "other_tool", False)
    found = point_join(middle, painted, ["chrom", "other_tool"], "mid").groupBy("tool", "family", "other_tool", "other_family").agg(F.count("*").alias("n_inside"))
    total = hits.groupBy("tool", "family").agg(F.count("*").alias("n_copies"))
    return found.join(total, ["tool", "family"]).withColumn("fraction", F.col("n_inside") / F.col("n_copies"))


def with_copy_weight(edges_: DataFrame, hits: DataFrame) -> DataFrame:
    """edges with w_copy: the larger of both ways' shares of hits whose midpoint the other family has painted, 0 if none has."""
    share = coannotation(hits).select(F.expr("tool || ':' || family").alias("a"), F.expr("other_tool || ':' || other_family").alias("b"), "fraction")
    there = edges_.join(share.withColumnRenamed("fraction", "there"), ["a", "b"], "left")
    back = share.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("fraction").alias("back"))
    both = there.join(back, ["a", "b"], "left")
    return both.withColumn("w_copy", F.greatest(F.coalesce("there", F.lit(0.0)), F.coalesce("back", F.lit(0.0)))).drop("there", "back")


def with_evidence(members: DataFrame, evidence: DataFrame) -> DataFrame:
    """members with their evidence, null where there is none; a member that evidence holds twice is an error."""
    own = [c for c in evidence.columns if c != "member"]
    once = evidence.groupBy("member").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in own])
    checked = once.select("member", *[F.when(F.col("n") == 1, F.col(c)).otherwise(F.raise_error(F.lit("evidence holds a member twice"))).alias(c) for c in own])
    return members.join(checked, "member", "left")


def both_ways(edges_: DataFrame) -> DataFrame:
    other = edges_.select(F.col("b").alias("a"), F.col("a").alias("b"), "w_bp")
    return edges_.select("a", "b", "w_bp").unionByName(other)


def mutual_best(edges_: DataFrame) -> DataFrame:
    """Edges that are the best of both ends among edges to the other end's tool.

    Of edges that weigh the same the one to the smaller name counts, at any order of rows.
    """
    rows = both_ways(edges_)
    rank = F.row_number().over(Window.partitionBy("a", F.split("b", ":", 2)[0]).orderBy(F.col("w_bp").desc(), "b"))
    best = rows.withColumn("rank", rank).filter("rank = 1").select("a", "b")
    return best.join(best.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi").filter("a < b")


def cluster_key(members: Column) -> Column:
    """The first 10 hex digits of SHA-1 over the sorted members joined by semicolons."""
    return F.substring(F.sha1(F.array_join(F.array_sort(members), ";")), 1, 10)


def clusters(pairs: DataFrame) -> DataFrame:
    """Components of two members and more: member, cluster_key, n_members; and cluster_id by (size, members)."""
    nodes = connected_components(pairs)
    grouped = nodes.groupBy("component").agg(F.array_sort(F.collect_set("node")).alias("list")).withColumn("cluster_key", cluster_key(F.col("list")))
    place = F.row_number().over(Window.orderBy(F.size("list"), F.array_join("list", ";"))) - 1
    return grouped.withColumn("cluster_id", place.cast("int")).select("cluster_id", "cluster_key", F.size("list").alias("n_members"), F.explode("list").alias("member"))


def lenient_clusters(edges_: DataFrame, density: float = 0.5, most_depth: int = 12) -> DataFrame:
    """Components whose weakest edges go until a sparse part falls apart: cluster_key, n_members, member.

    A part of more than two members whose share of possible edges is under ``density`` loses its
    weakest edges, by (w_bp, a, b), until it is disconnected; edges that lie inside a half come back,
    and halves are judged again, up to ``most_depth`` times. What first disconnects a part is the
    weakest edge of its maximum spanning tree, and the halves' trees are what is left of it, so the
    forest is made once and each level takes one edge off each sparse part's tree. Single members go.
    """
    edges_ = cut(edges_.select("a", "b", "w_bp").filter("a <> b").distinct())
    tree = spanning_forest(edges_.withColumnRenamed("w_bp", "w"))
    labels = connected_components(edges_).select("node", F.col("component").alias("part"))
    done = None
    for depth in range(most_depth + 2):
        near = edges_.join(labels.select(F.col("node").alias("a"), "part"), "a").join(labels.select(F.col("node").alias("b"), F.col("part").alias("other")), "b").filter("part = other")
        size = labels.groupBy("part").agg(F.count("*").alias("n")).join(near.groupBy("part").agg(F.count("*").alias("m")), "part", "left").filter("n > 1")
        whole = (F.col("n") == 2) | (F.lit(depth) > most_depth) | (F.col("m") / (F.col("n") * (F.col("n") - 1) / 2) >= density)
        judged = cut(size.select("part", whole.alias("whole")))
        found = labels.join(judged.filter("whole").select("part"), "part").select("node", "part")
        done = found if done is None else done.unionByName(found)
        open_ = judged.filter("NOT whole").select("part")
        if open_.isEmpty():
            break
        owned = tree.join(labels.select(F.col("node").alias("a"), "part"), "a").join(open_, "part")
        weakest = owned.groupBy("part").agg(F.min(F.struct("w", "a", "b")).alias("weakest"))
        tree = cut(owned.join(weakest, "part").filter(F.struct("w", "a", "b") != F.col("weakest")).select("a", "b", "w"))
        halves = connected_components(tree).select("node", F.col("component"))
        labels = cut(labels.join(open_, "part").join(halves, "node", "left").select("node", F.coalesce("component", "node").alias("part")))
    listed = done.groupBy("part").agg(F.array_sort(F.collect_set("node")).alias("list"))
    return listed.select(cluster_key(F.col("list")).alias("cluster_key"), F.size("list").alias("n_members"), F.explode("list").alias("member"))


def diagnostics(members: DataFrame, edges_: DataFrame, order_of: DataFrame) -> DataFrame:
    """One row: clusters, members, largest, 99th percentile of size, median density, share of mixed orders."""
    size = members.groupBy("cluster_key").agg(F.count("*").alias("n"))
    ends = members.select("member", "cluster_key")
    inside = edges_.join(ends.withColumnRenamed("member", "a"), "a").join(ends.select(F.col("member").alias("b"), F.col("cluster_key").alias("other")), "b").filter("cluster_key = other").groupBy("cluster_key").agg(F.count("*").alias("m"))
    orders = members.join(order_of, "member", "left").groupBy("cluster_key").agg((F.count_distinct("order_name") > 1).cast("int").alias("mixed"))
    every = size.join(inside, "cluster_key", "left").join(orders, "cluster_key", "left")
    return every.agg(
        F.count("*").alias("n_clusters"), F.sum("n").alias("n_members"), F.max("n").alias("largest"), F.floor(F.percentile("n", 0.99)).cast("bigint").alias("p99"),
        F.round(F.median(F.coalesce("m", F.lit(0)) / (F.col("n") * (F.col("n") - 1) / 2)), 6).alias("median_density"), F.round(F.avg("mixed"), 6).alias("mixed_fraction"),
    )


def weighted_vote(members: DataFrame, abstain: list[str]) -> DataFrame:
    """members(cluster_key, member, vote, weight): winner and its share of all votes cast; null and ``abstain`` don't vote."""
    cast = members.filter(F.col("vote").isNotNull() & ~F.col("vote").isin(*abstain)).withColumn("w", F.coalesce("weight", F.lit(0.0)) + 1)
    by = cast.groupBy("cluster_key", "vote").agg(F.sum("w").alias("w"), F.min("member").alias("first"))
    win = F.row_number().over(Window.partitionBy("cluster_key").orderBy(F.col("w").desc(), "first"))
    share = F.col("w") / F.sum("w").over(Window.partitionBy("cluster_key"))
    won = by.withColumn("win", win).withColumn("share", share).filter("win = 1").select("cluster_key", F.col("vote").alias("winner"), "share")
    return members.select("cluster_key").distinct().join(won, "cluster_key", "left")


def class_paths(rows: DataFrame, label: str, class_map: DataFrame) -> DataFrame:
    """rows(tool, label) with path: that of class_map(label, tool, path) for the label and tool, or else for the label under no tool, or null.

    Labels are compared in lower case. Of several entries the smallest path counts.
    """
    entries = class_map.groupBy(F.lower("label").alias("__label"), F.nullif("tool", F.lit("")).alias("__tool")).agg(F.min("path").alias("path"))
    own = entries.filter("__tool IS NOT NULL").withColumnRenamed("path", "__own")
    general = entries.filter("__tool IS NULL").select(F.col("__label"), F.col("path").alias("__general"))
    named = rows.withColumn("__label", F.lower(label)).withColumn("__tool", F.col("tool"))
    found = named.join(own, ["__label", "__tool"], "left").join(general, "__label", "left")
    return found.withColumn("path", F.coalesce("__own", "__general")).drop("__label", "__tool", "__own", "__general")


def gates(members: DataFrame, votes: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Six gates on each cluster; a missing figure fails the gates on figures. evidence columns may be null.

    The tandem share is that of all bases: a member without a fraction adds bases and no tandem ones.
    """
    figures = members.groupBy("cluster_key").agg(
        F.coalesce(F.sum("n_full_len"), F.lit(0.0)).alias("pooled_full_len"), F.coalesce(F.bool_or(F.col("cov") >= settings.min_deep), F.lit(False)).alias("deep"),
        F.when(F.sum("genomic_bp") > 0, F.coalesce(F.sum(F.col("frac_tandem") * F.col("genomic_bp")), F.lit(0.0)) / F.sum("genomic_bp")).alias("tandem"),
        F.median("div_median").alias("div"), F.count_distinct("tool").alias("n_tools"), F.count("*").alias("n_members"),
    )
    rows = figures.join(votes, "cluster_key", "left")
    tests = {
        "g1": F.col("pooled_full_len") >= settings.min_full, "g2": F.col("deep"), "g3": F.col("share") >= settings.min_coherence,
        "g4": F.col("tandem") <= settings.max_tandem, "g5": F.col("div") <= settings.max_divergence, "g6": F.col("n_tools") >= settings.min_tools,
    }
    tests = {k: F.coalesce(v, F.lit(False)) for k, v in tests.items()}
    passed = sum((v.cast("int") for v in list(tests.values())[1:]), tests["g1"].cast("int"))
    return rows.select("cluster_key", "n_members", "n_tools", "winner", F.round("share", 6).alias("share"), F.round("tandem", 6).alias("tandem"), F.round("div", 6).alias("div"), *[v.alias(k) for k, v in tests.items()], passed.alias("n_gates"), (passed >= settings.min_gates).alias("candidate"))
