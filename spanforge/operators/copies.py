"""Hits to copies, copies to loci: merging with a gap veto, caps, full length, length modes, sampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.functions.graph import connected_components
from spanforge.operators.intervals import TILE, in_tiles, modal_over_span, overlap_groups, paint, tile_changes, tiled
from spanforge.session import written

MAX_GAP = 20_000
MEMBER = ["tool", "family"]
#: A total order of a member's hits: those that share start and ord go by end, then strand.
ORDER = ["chrom", "s", "ord", "e", "strand"]


def _gaps(hits: DataFrame) -> DataFrame:
    by = Window.partitionBy(*MEMBER, "chrom").orderBy(*ORDER)
    rows = hits.withColumn("gap", F.col("s") - F.lag("e").over(by)).withColumn("before", F.lag("e").over(by))
    same = F.lag("strand").over(by) == F.col("strand")
    return rows.withColumn("joins", F.coalesce(same & F.col("gap").between(0, MAX_GAP), F.lit(False)))


def foreign_cover(gaps: DataFrame, hits: DataFrame) -> DataFrame:
    """gaps(cluster, chrom, s, e) with covered: the share of its bases under hits(cluster, chrom, s, e) of any other cluster.

    A gap is told by its cluster and place, which is all that its cover depends on. Hits and gaps
    are cut at tiles and swept tile by tile, so a row costs the same however many hits a gap holds
    or gaps a hit lies in. Gaps that nothing covers aren't returned.
    """
    wanted = gaps.filter("e > s").select("cluster", "chrom", "s", "e", F.col("s").alias("gap_s"), F.col("e").alias("gap_e"))
    empty = F.lit(None).cast("bigint")
    every = hits.filter("e > s").select("cluster", "chrom", "s", "e", empty.alias("gap_s"), empty.alias("gap_e")).unionByName(wanted)
    schema = ", ".join(f"{c} {every.schema[c].dataType.simpleString()}" for c in ("cluster", "chrom", "gap_s", "gap_e")) + ", bp long"
    bp = in_tiles(tiled(every, TILE), ["chrom", "tile"], [], ["cluster", "chrom", "tile", "s", "e", "gap_s", "gap_e"], _foreign_bases, schema)
    bp = bp.groupBy("cluster", "chrom", "gap_s", "gap_e").agg(F.sum("bp").alias("bp"))
    return bp.select("cluster", "chrom", F.col("gap_s").alias("s"), F.col("gap_e").alias("e"), (F.col("bp") / (F.col("gap_e") - F.col("gap_s"))).alias("covered"))


def _foreign_bases(part: pa.Table) -> pa.Table:
    """Of whole tiles' hits and pieces of gaps, each piece's bases under hits of other clusters: all covered ones but those of its own cluster alone."""
    names = ["cluster", "chrom", "gap_s", "gap_e", "bp"]
    group = tile_changes(part, ["chrom", "tile"]).cumsum()
    # clusters by number; hits without one are of no cluster that a gap has
    cluster = pc.fill_null(part.column("cluster").combine_chunks().dictionary_encode().indices, -1).to_numpy().astype(np.int64) + 1
    s, e = (part.column(c).to_numpy() - part.column("tile").to_numpy() * TILE + group * (TILE + 1) for c in "se")
    is_gap = part.column("gap_s").is_valid().to_numpy()
    line = int(group[-1] + 1) * (TILE + 1) if len(group) else 1
    # the union of each cluster's hits
    at = np.flatnonzero(~is_gap)
    at = at[np.lexsort((s[at], cluster[at]))]
    own = cluster[at] * line
    reach = np.maximum.accumulate(e[at] + own) if len(at) else own
    new = np.ones(len(at), bool)
    new[1:] = (s[at] + own)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    begin, code = s[at][first], cluster[at][first]
    end = np.append(reach[first[1:] - 1], reach[-1:]) - code * line if len(at) else begin
    # between neighbouring ends the number of clusters is the same
    points, place = np.unique(np.concatenate([begin, end]), return_inverse=True)
    step, owner = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for value, to in ((np.ones(len(code), np.int64), step), (code, owner)):
        np.add.at(to, place[: len(code)], value)
        np.subtract.at(to, place[len(code) :], value)
    depth, owner = np.cumsum(step), np.cumsum(owner)
    width = np.append(np.diff(points), 0)
    covered, alone = np.flatnonzero(depth > 0), np.flatnonzero(depth == 1)
    alone = alone[np.argsort(owner[alone], kind="stable")]

    def below(where: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many bases of disjoint segments in rising order lie before each place."""
        total = np.concatenate([[0], np.cumsum(sizes)])
        i = np.searchsorted(starts, where, "right")
        last = np.maximum(i - 1, 0)
        return total[i] - np.where(i > 0, np.maximum(starts[last] + sizes[last] - where, 0), 0) if len(starts) else np.zeros(len(where), np.int64)

    gap = np.flatnonzero(is_gap)
    low, high, mine = s[gap], e[gap], cluster[gap] * line
    every = below(high, points[covered], width[covered]) - below(low, points[covered], width[covered])
    starts = owner[alone] * line + points[alone]
    bp = every - (below(high + mine, starts, width[alone]) - below(low + mine, starts, width[alone]))
    # members of a cluster may share a gap
    _, once = np.unique(np.stack([group[gap], cluster[gap], part.column("gap_s").to_numpy()[gap], part.column("gap_e").to_numpy()[gap]]), axis=1, return_index=True) if len(gap) else (None, np.zeros(0, np.int64))
    once = once[bp[once] > 0]
    return part.select(names[:4]).take(pa.array(gap[once])).append_column("bp", pa.array(bp[once], pa.int64()))


def merge_copies(hits: DataFrame, gap_aware: bool = False, veto: float = 0.5, cluster: Column | None = None, every: DataFrame | None = None) -> DataFrame:
    """Consecutive hits of a member on one chromosome and strand within MAX_GAP as one copy.

    A hit that overlaps or lies inside the one before doesn't join it; hits that share start and
    ord go by end, then strand. ord may repeat or be null. gap_aware: a gap of which hits of
    families outside the member's cluster, of its own tool too, cover more than ``veto`` stays open;
    only gaps that would close are probed. cluster: each hit's; by default, and where it is null, a
    family is its own. every: all hits that may cover gaps, if hits are some of them.
    """
    rows = _gaps(hits)
    if gap_aware:
        alone = F.concat_ws(":", *MEMBER)
        named = alone if cluster is None else F.coalesce(cluster.cast("string"), alone)
        rows = rows.withColumn("gap_cluster", named)
        gaps = rows.filter("joins AND gap > 0").select(F.col("gap_cluster").alias("cluster"), "chrom", F.col("before").alias("s"), F.col("s").alias("e"))
        open_ = foreign_cover(gaps, (hits if every is None else every).withColumn("cluster", named)).filter(F.col("covered") > veto)
        open_ = open_.select(F.col("cluster").alias("gap_cluster"), "chrom", F.col("s").alias("before"), F.col("e").alias("s"), F.lit(True).alias("vetoed"))
        rows = rows.join(open_, ["gap_cluster", "chrom", "before", "s"], "left").withColumn("joins", F.col("joins") & F.col("vetoed").isNull())
    by = Window.partitionBy(*MEMBER, "chrom").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("block", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(by))
    return _reduce(rows, "block").drop("block")


def copy_counts(hits: DataFrame) -> DataFrame:
    """tool, family, n_copies: how many copies ``merge_copies`` makes of hits, of which none is put together."""
    rows = _gaps(hits.select(*MEMBER, "chrom", "s", "e", "ord", "strand"))
    return rows.groupBy(*MEMBER).agg(F.count_if(~F.col("joins")).alias("n_copies"))


def hit_id_copies(hits: DataFrame) -> DataFrame:
    """Hits of a member that share a hit_id as one copy, on the chromosome of its first; null ids are left out.

    A member none of whose hits has an id is merged by its gaps instead.
    """
    named = hits.withColumn("ids", F.count("hit_id").over(Window.partitionBy(*MEMBER)))
    by_gap = merge_copies(named.filter("ids = 0").drop("ids")).withColumn("hit_id", F.lit(None).cast("string"))
    by_id = _reduce(named.filter("hit_id IS NOT NULL").drop("ids"), "hit_id", ())
    return by_id.unionByName(by_gap)


def _reduce(rows: DataFrame, block: str, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    piece = F.struct("s", "ord", "e")
    chrom = [] if keys else [F.min_by("chrom", F.struct("s", "ord", "e", "strand")).alias("chrom")]
    return rows.groupBy(*MEMBER, *keys, block).agg(
        *chrom, F.min("s").alias("start"), F.max("e").alias("end"), F.min_by("strand", F.struct("s", "ord", "e", "strand")).alias("strand"), F.count("*").alias("n_fragments"),
        F.round(F.avg("div"), 6).alias("div"), F.min("cons_start").alias("cons_start"), F.max("cons_end").alias("cons_end"), F.max("cons_len").alias("cons_len"),
        F.transform(F.array_sort(F.collect_list(piece)), lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"))).alias("fragments"),
    )


def split_widest(starts: list[int], ends: list[int], cap: float) -> list[tuple[int, int]]:
    """Index ranges of a block cut at its widest gap again and again until each spans ``cap`` at most; the first of equal gaps counts.

    The cuts form a tree of gaps with the widest on top, which one pass with a stack builds; the
    largest end of every range comes from the ranges below it.
    """
    n = len(starts)
    left, right, stack = [-1] * n, [-1] * n, []
    for i in range(1, n):
        gap, below = starts[i] - ends[i - 1], -1
        while stack and starts[stack[-1]] - ends[stack[-1] - 1] < gap:
            below = stack.pop()
        left[i] = below
        if stack:
            right[stack[-1]] = i
        stack.append(i)
    # every cut before those under it, with the range that it parts
    order = [(stack[0], 0, n)] if stack else []
    for at, i, j in order:
        order += [(x, a, b) for x, a, b in ((left[at], i, at), (right[at], at, j)) if x >= 0]
    reach = [0] * n
    for at, i, j in reversed(order):
        reach[at] = max(reach[left[at]] if left[at] >= 0 else ends[i], reach[right[at]] if right[at] >= 0 else ends[j - 1])
    done, todo = [], [(stack[0] if stack else -1, 0, n)]
    while todo:
        at, i, j = todo.pop()
        if at < 0 or reach[at] - starts[i] <= cap:
            done.append((i, j))
        else:
            todo += [(right[at], at, j), (left[at], i, at)]
    return done


def split_greedy(starts: list[int], ends: list[int], cap: float) -> list[tuple[int, int]]:
    """Index ranges of a block from left to right: one closes before the fragment that would take it beyond ``cap``."""
    cuts = [0]
    for i in range(1, len(starts)):
        if ends[i] - starts[cuts[-1]] > cap:
            cuts.append(i)
    return list(zip(cuts, [*cuts[1:], len(starts)], strict=True))


def _split(copies: DataFrame, cap: Column, how: Callable[[list[int], list[int], float], list[tuple[int, int]]]) -> DataFrame:
    """copies with fragments as the pieces that ``how`` cuts them into: member, chrom, start, end, n_fragments. Without a cap they stay whole."""
    names = [*MEMBER, "chrom", "start", "end", "n_fragments"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, end, count = [], [], [], []
            caps, lists = batch.column("cap").to_pylist(), batch.column("fragments")
            for r, most in enumerate(caps):
                fragments = lists[r].values
                starts, ends = fragments.field("start").to_pylist(), fragments.field("end").to_pylist()
                for i, j in how(starts, ends, float("inf") if most is None else most):
                    row.append(r)
                    start.append(starts[i])
                    end.append(max(ends[i:j]))
                    count.append(j - i)
            kept = [batch.column(c).take(pa.array(row, pa.int64())) for c in names[:3]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in (start, end, count))], names=names)

    rows = copies.filter(F.size("fragments") > 0).select(*names[:3], cap.cast("double").alias("cap"), "fragments")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names[:3])
    return rows.mapInArrow(run, kinds + ", start long, end long, n_fragments long")


def cap_widest_gap(copies: DataFrame, ratio: float = 1.5) -> DataFrame:
    """Copies that span more than ratio * cons_len split at their widest gaps; others as they are."""
    columns = [*MEMBER, "chrom", "start", "end", "n_fragments"]
    long = F.coalesce((F.col("end") - F.col("start") > ratio * F.col("cons_len")) & (F.col("n_fragments") > 1), F.lit(False))
    return copies.filter(~long).select(columns).unionByName(_split(copies.filter(long), ratio * F.col("cons_len"), split_widest))


def cap_greedy(copies: DataFrame, length: Column, ratio: float = 1.5) -> DataFrame:
    """Copies re-cut from left to right: a piece closes before the fragment that would take it beyond ratio * length."""
    return _split(copies, ratio * length, split_greedy)


def inherited_lengths(bare: DataFrame, hits: DataFrame, lengths: DataFrame, row: str) -> DataFrame:
    """bare(row, chrom, s, e) with cons_len: the length of clustermates that owns most of its bases, the smallest on ties.

    lengths(tool, family, cons_len): of mates that have one. Where mates overlap, the one with more
    hits owns a base, of equal ones the later name.
    """
    counted = hits.groupBy(*MEMBER).agg(F.count("*").alias("n_hits"))
    known = lengths.filter("cons_len > 0").join(counted, MEMBER)
    rows = hits.select(*MEMBER, "chrom", "s", "e").join(known, MEMBER)
    painted = paint(rows, ["chrom"], "cons_len", F.struct("n_hits", F.concat_ws(":", *MEMBER)))
    return modal_over_span(bare, painted, ["chrom"], row, "cons_len")


def near_full(length: Column, edge: int = 20, share: float = 0.8, span_only: bool = False) -> Column:
    """Whether cons_start and cons_end take in nearly all of the consensus; missing figures say no."""
    span = F.try_divide(F.col("cons_end") - F.col("cons_start"), length) >= share
    ends = (F.col("cons_start") <= edge) & (F.col("cons_end") >= length - edge)
    return F.coalesce(span if span_only else span & ends, F.lit(False))


def deconvolve(lengths: DataFrame, ratio: float = 1.8, near: float = 1.3) -> DataFrame:
    """lengths(cluster_key, member, cons_len, protected): what becomes of each member's own length.

    A length that is ``ratio`` times its mates' median becomes the median of the mates that agree
    on one, if two and half of them do; a protected one, or one without agreement, abstains.
    Work grows with members and with the square of a cluster's different lengths, not of its members.
    """
    named = lengths.filter("cons_len IS NOT NULL AND member IS NOT NULL AND cluster_key IS NOT NULL")
    own = named.groupBy("cluster_key", "member").agg(F.first("cons_len").alias("own"), F.first("protected").alias("protected"), F.array_sort(F.collect_list("cons_len")).alias("lengths"))
    # mates are counted by length, once for all members of the same lengths
    counts = named.groupBy("cluster_key", F.col("cons_len").alias("other_len")).agg(F.count("*").alias("times"))
    left = F.col("times") - F.size(F.filter("lengths", lambda x: x == F.col("other_len")))
    rest = own.select("cluster_key", "lengths").distinct().join(counts, "cluster_key").withColumn("times", left).filter("times > 0")
    key = ["cluster_key", "lengths"]
    center = rest.groupBy(*key).agg(F.percentile("other_len", 0.5, F.col("times")).alias("mate"), F.sum("times").alias("n"))
    agrees = F.col("other_len").between(F.col("mate") / near, F.col("mate") * near)
    figures = rest.join(center, key).groupBy(*key).agg(
        F.first("mate").alias("mate"), F.first("n").alias("n"), F.sum(F.when(agrees, F.col("times")).otherwise(0)).alias("agree"),
        F.percentile(F.when(agrees, F.col("other_len")), 0.5, F.col("times")).alias("ref"),
    )
    # a member of several lengths meets its mates with each
    each = F.size("lengths")
    agreed = own.join(figures, key).withColumn("n", F.col("n") * each).withColumn("agree", F.col("agree") * each)
    verdict = (
        F.when((F.col("n") < 2) | (F.col("own") / F.col("mate") < ratio), "keep").when(F.col("protected"), "abstain")
        .when((F.col("agree") < 2) | (F.col("agree") < 0.5 * F.col("n")), "abstain").when(F.col("own") / F.col("ref") >= ratio, "deconvolve").otherwise("keep")
    )
    return agreed.withColumn("verdict", verdict).select("cluster_key", "member", "verdict", F.when(F.col("verdict") == "deconvolve", F.col("ref")).otherwise(F.col("own")).cast("double").alias("cons_len"))


def loci(copies: DataFrame, share: float = 0.5) -> DataFrame:
    """copies(copy_id, chrom, start, end, ...) with locus_id: copies that overlap by ``share`` of the shorter, directly or through others; copy_id names one copy.

    Most loci lie in one tile and are done when it is swept; only groups with a copy that reaches
    into another tile are joined by their links. The swept copies are a written table.
    """
    takes_part = F.coalesce((F.col("end") > F.col("start")) & F.col("copy_id").isNotNull(), F.lit(False))
    rows = copies.filter(takes_part).withColumnsRenamed({"start": "s", "end": "e"})
    swept, _ = written(overlap_groups(rows, "chrom", "copy_id", share), "loci")
    parts = connected_components(swept.filter("__crosses").select("__group", "copy_id"), "__group", "copy_id")
    done = swept.filter("__begins").withColumnsRenamed({"s": "start", "e": "end"})
    far = done.filter("__open").join(parts.withColumnRenamed("node", "__group"), "__group").withColumn("locus_id", F.col("component"))
    names = [*copies.columns, "locus_id"]
    placed = done.filter("NOT __open").withColumn("locus_id", F.col("__group")).select(names).unionByName(far.select(names))
    return placed.unionByName(copies.filter(~takes_part).withColumn("locus_id", F.col("copy_id")))


def locus_table(placed: DataFrame) -> DataFrame:
    """One row a locus: figures over its copies, and its representative, a real row."""
    last = lambda c: F.when(F.col(c), 0).when(~F.col(c), 1).otherwise(2)
    best = F.struct(last("is_full").alias("a"), last("measured").alias("b"), "n_fragments", (F.col("end") - F.col("start")).alias("c"), "copy_id")
    member = F.concat_ws(":", "tool", "family")
    figures = placed.groupBy("locus_id").agg(
        F.count("*").alias("n_members"), F.collect_set("tool").alias("tools"), F.collect_set(member).alias("members"),
        F.bool_or("is_full").alias("any_full"), F.min("start").alias("locus_start"), F.max("end").alias("locus_end"),
        F.min_by(F.struct("chrom", "start", "end", "is_full", "cons_len", member.alias("member")), best).alias("best"),
    )
    return figures.select("locus_id", "n_members", F.size("tools").cast("bigint").alias("n_tools"), F.array_join(F.array_sort("members"), ";").alias("members"), "any_full", "locus_start", "locus_end", "best.*")


def length_modes(lengths: DataFrame, key: str, ratio: float = 2.0) -> DataFrame:
    """lengths(key, member, tool, cons_len) as modes: sorted lengths break where one exceeds ratio times the one before."""
    by = Window.partitionBy(key).orderBy("cons_len", "member")
    rows = lengths.filter("cons_len IS NOT NULL").withColumn("new", F.when(F.col("cons_len") > ratio * F.lag("cons_len").over(by), 1).otherwise(0))
    rows = rows.withColumn("mode_index", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "mode_index").agg(
        F.median("cons_len").alias("centre"), F.min("cons_len").cast("double").alias("low"), F.max("cons_len").cast("double").alias("high"), F.count("*").alias("n_members"),
        F.count_distinct("tool").alias("n_tools"), F.array_join(F.array_sort(F.collect_set("tool")), ";").alias("tools"), (F.count_distinct("tool") >= 2).alias("credible"),
    )


def nearest_mode(rows: DataFrame, modes: DataFrame, key: str, span: Column) -> DataFrame:
    """rows with the mode nearest by ratio, the first on ties; 0 where there is none. Modes of a key are few."""
    few = modes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("mode_index", "centre"))).alias("modes"))
    joined = rows.join(few, key, "left").withColumn("span_", F.greatest(span, F.lit(1)).cast("double"))
    far = F.transform("modes", lambda m: F.struct(F.abs(F.ln("span_") - F.ln(m["centre"])).alias("far"), m["mode_index"].alias("mode_index"), m["centre"].alias("centre")))
    return joined.withColumn("near", F.array_min(far)).withColumn("mode_index", F.coalesce("near.mode_index", F.lit(0))).withColumn("mode_centre", F.col("near.centre")).drop("modes", "near", "span_")


def stratified_sample(rows: DataFrame, key: str, cap: int, floor: int, full_share: float, draw: Column) -> DataFrame:
    """At most cap rows of each key: a share of full ones, the rest from five bands of consensus midpoint.

    rows(key, row, is_full, cons_start, cons_end, cons_len); draw: a fixed random number. Each band
    gives as many; what is short comes from all other partial ones, then from full ones.
    """
    mid = F.try_divide((F.col("cons_start") + F.col("cons_end")) / 2, F.col("cons_len"))
    band = F.when(mid.isNull(), -1).when(mid <= 0.2, 0).when(mid <= 0.4, 1).when(mid <= 0.6, 2).when(mid <= 0.8, 3).otherwise(4)
    r = rows.withColumn("__draw", draw).withColumn("__band", band)
    counts = r.groupBy(F.col(key).alias("__key"), "is_full", "__band").agg(F.count("*").alias("c"))
    sizes = counts.groupBy("__key").agg(
        F.sum("c").alias("__n"), F.sum(F.when(F.col("is_full"), F.col("c")).when(~F.col("is_full"), 0)).alias("__n_full"), F.size(F.collect_set(F.when(~F.col("is_full"), F.col("__band")))).alias("__bands"),
    )
    sizes = sizes.withColumn("__take", F.least(F.lit(cap), F.col("__n"))).withColumn("__full_quota", F.least(F.bround(F.col("__take") * full_share).cast("long"), F.col("__n_full"))).withColumn("__part_quota", F.col("__take") - F.col("__full_quota"))
    sizes = sizes.withColumn("__per", F.greatest(F.lit(1), F.floor(F.try_divide(F.col("__part_quota"), F.col("__bands")))))
    # none beyond these of its band is ever chosen, so each task passes on so many
    r = r.withColumn("__in_band", F.row_number().over(Window.partitionBy(key, "is_full", "__band").orderBy("__draw", "row"))).filter(F.col("__in_band") <= max(cap, floor, 1))
    r = r.join(sizes, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    r = r.withColumn("__first_round", ~F.col("is_full") & (F.col("__in_band") <= F.col("__per")))
    order = [F.col("__first_round").desc(), F.when(F.col("__first_round"), F.col("__band")).otherwise(99), "__draw", "row"]
    r = r.withColumn("__place", F.row_number().over(Window.partitionBy(key, "is_full").orderBy(*order)))
    # partial ones that are missing are replaced by full ones
    r = r.withColumn("__n_part", F.col("__n") - F.col("__n_full")).withColumn("__spare", F.greatest(F.lit(0), F.col("__part_quota") - F.col("__n_part")))
    chosen = F.when(F.col("__n") <= F.greatest(F.lit(floor), F.lit(1)), True).when(F.col("is_full"), F.col("__place") <= F.col("__full_quota") + F.col("__spare")).otherwise(F.col("__place") <= F.col("__part_quota"))
    small = F.col("__n") <= F.greatest(F.lit(floor), F.lit(1))
    return r.filter(chosen).withColumn("cov_band", F.when(small | F.col("is_full"), -1).otherwise(F.col("__band"))).select(*rows.columns, "cov_band")
