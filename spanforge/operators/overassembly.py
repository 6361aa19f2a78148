"""Consensi that hold their unit several times: phases of match ends, conditions, reasons, verdicts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.session import cut

KEY = ["tool", "family"]


@dataclass(frozen=True)
class Params:
    """Thresholds; factors: how often a unit may stand in its consensus, decoys: factors that no array has."""

    factors: tuple[float, ...] = (2.0, 3.0, 4.0, 5.0)
    decoys: tuple[float, ...] = (2.5, 3.5, 4.5)
    bins: int = 10
    end_bp: float = 20.0
    end_share: float = 0.05
    low_ratio: float = 0.70
    high_ratio: float = 1.30
    min_enrichment: float = 1.5
    min_z: float = 5.0
    most_full: float = 0.02
    full_slop: float = 20.0
    full_share: float = 0.80
    occupied: float = 0.05
    min_hits: int = 50
    min_length: float = 100.0
    min_agreement: float = 0.50


PARAMS = Params()
#: Why a family isn't tested, in the order of the tests (fixed values).
REJECTED = ("too_few_hits_with_cons_coords", "consensus_too_short", "consensus_length_inconsistent", "too_few_internal_endpoints")


def consensus_lengths(hits: DataFrame) -> DataFrame:
    """tool, family, cons_len, conslen_frac: the modal implied length, the smallest on ties, and the share of hits within 1 % or 1 of it; null if not positive."""
    implied = hits.select(*KEY, (F.col("repeat_end") + F.col("repeat_left")).alias("implied")).filter("implied IS NOT NULL")
    return _modal(implied.groupBy(*KEY, "implied").agg(F.count("*").alias("times")))


def _modal(counted: DataFrame) -> DataFrame:
    """``consensus_lengths`` of counted(tool, family, implied, times)."""
    rounded = counted.groupBy(*KEY, F.bround("implied").cast("bigint").alias("length")).agg(F.sum("times").alias("times"))
    modal = rounded.groupBy(*KEY).agg((-F.max(F.struct("times", (-F.col("length")).alias("low")))["low"]).cast("double").alias("cons_len"))
    near = F.abs(F.col("implied") - F.col("cons_len")) <= F.greatest(F.lit(1.0), 0.01 * F.col("cons_len"))
    rows = counted.join(modal, KEY).groupBy(*KEY).agg(F.first("cons_len").alias("cons_len"), (F.sum(F.when(near, F.col("times")).otherwise(0)) / F.sum("times")).alias("conslen_frac"))
    good = F.col("cons_len") > 0
    return rows.select(*KEY, F.when(good, F.col("cons_len")).alias("cons_len"), F.when(good, F.col("conslen_frac")).alias("conslen_frac"))


def internal_endpoints(hits: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Starts and ends of matches of hits(tool, family, repeat_start, repeat_end, cons_len) as x, without those at the consensus's ends."""
    edge = F.greatest(F.lit(p.end_bp), p.end_share * F.col("cons_len"))
    rows = hits.select(*KEY, "cons_len", edge.alias("edge"), F.explode(F.array(F.col("repeat_start").cast("double"), F.col("repeat_end").cast("double"))).alias("x"))
    return rows.filter("x > edge AND x < cons_len - edge").drop("edge")


def _counted(ends: DataFrame) -> DataFrame:
    """ends with times, how often each stands there: no more rows a family than its consensus has places."""
    return ends if "times" in ends.columns else ends.groupBy(*KEY, "x", "cons_len").agg(F.count("*").alias("times"))


def phases(ends: DataFrame, factors: tuple[float, ...], p: Params = PARAMS) -> DataFrame:
    """ends(tool, family, x, cons_len) by factor k: n, hits of the phase bin around multiples of cons_len / k, enrichment over an even spread, z."""
    laid = _counted(ends).withColumn("k", F.explode(F.array(*map(F.lit, factors)))).withColumn("period", F.col("cons_len") / F.col("k"))
    phase = F.pmod(F.pmod(F.col("x"), F.col("period")) / F.col("period") + 0.5 / p.bins, F.lit(1.0))
    first = F.when(F.floor(phase * p.bins) == 0, F.col("times")).otherwise(0)
    counted = laid.withColumn("first", first).groupBy(*KEY, "k").agg(F.sum("times").alias("n"), F.sum("first").alias("hits"))
    even = F.col("n") / p.bins
    return counted.withColumn("enrichment", F.col("hits") / even).withColumn("z", (F.col("hits") - even) / F.sqrt(even * (1 - 1 / p.bins)))


def boundary_occupancy(ends: DataFrame, factors: tuple[float, ...] = PARAMS.factors, half_width: float = 0.05) -> DataFrame:
    """ends by whole factor k and boundary j inside (1 to k - 1): the share of ends within half_width periods of it, to three digits."""
    whole = [k for k in factors if float(k).is_integer()]
    laid = _counted(ends).withColumn("k", F.explode(F.array(*map(F.lit, whole)))).withColumn("period", F.col("cons_len") / F.col("k"))
    laid = laid.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1)))
    near = F.abs(F.col("x") - F.col("j") * F.col("period")) <= half_width * F.col("period")
    return laid.groupBy(*KEY, "k", "j").agg((F.sum(F.when(near, F.col("times")).otherwise(0)) / F.sum("times")).alias("share")).withColumn("occupancy", F.bround("share", 3)).drop("share")


def measured(hits: DataFrame, p: Params = PARAMS) -> DataFrame:
    """hits(tool, family, repeat_start, repeat_end, repeat_left, hit_len) as counts of values: tool, family, kind, v, w, times.

    All that ``family_records`` needs in one pass. kind: what v is. length: of a hit, w is 1 where its
    consensus coordinates are complete; of the complete ones implied: the consensus length, end: a
    start or end, head: a start within full_slop, w its end. Values are places and lengths on a
    consensus, so a family's rows are bounded by its consensus, however many its hits.
    """
    complete = F.col("repeat_start").isNotNull() & F.col("repeat_end").isNotNull() & F.col("repeat_left").isNotNull()
    row = lambda kind, v, w=None: F.struct(F.lit(kind).alias("kind"), v.cast("double").alias("v"), (F.lit(None) if w is None else w).cast("double").alias("w"))
    start, end = F.col("repeat_start"), F.col("repeat_end")
    values = F.array(
        row("length", F.col("hit_len"), complete.cast("int")), F.when(complete, row("implied", end + F.col("repeat_left"))), F.when(complete, row("end", start)), F.when(complete, row("end", end)),
        F.when(complete & (start <= p.full_slop), row("head", start, end)),
    )
    return cut(hits.select(*KEY, F.explode(F.array_compact(values)).alias("x")).groupBy(*KEY, "x.kind", "x.v", "x.w").agg(F.count("*").alias("times")))


def family_records(hits: DataFrame, factors: tuple[float, ...] | None = None, p: Params = PARAMS) -> DataFrame:
    """hits(tool, family, repeat_start, repeat_end, repeat_left, hit_len) as one row a family with all figures, flag and reason.

    Of the factors that meet all conditions the one with the largest (enrichment, k) is taken.
    Families that a guard rejects have the reason alone, in the guards' order.
    """
    return records(measured(hits, p), factors, p)


def records(counts: DataFrame, factors: tuple[float, ...] | None = None, p: Params = PARAMS) -> DataFrame:
    """``family_records`` from the counts of ``measured``."""
    factors = p.factors if factors is None else factors
    kind = lambda name: counts.filter(F.col("kind") == name)
    own = lambda x: F.when(F.col("w") == 1, F.col(x))
    every = kind("length").groupBy(*KEY).agg(
        F.sum("times").alias("n_hits"), F.coalesce(F.sum(own("times")), F.lit(0)).alias("n_hits_conscoord"), F.percentile("v", 0.5, F.col("times")).alias("all_median"), F.percentile("v", 0.9, F.col("times")).alias("all_p90"),
    )
    lengths = _modal(kind("implied").select(*KEY, F.col("v").alias("implied"), "times"))
    span = F.try_divide(F.col("w") - F.col("v"), F.col("cons_len"))
    full = (F.col("w") >= F.col("cons_len") - p.full_slop) & (span >= p.full_share)
    # a share among the hits whose fullness is known, which all are where there is a length
    whole = kind("head").join(lengths, KEY).groupBy(*KEY).agg(F.sum(F.when(full, F.col("times")).otherwise(0)).alias("n_full"))
    own_lengths = kind("length").filter("w = 1").groupBy(*KEY).agg(F.percentile("v", 0.5, F.col("times")).alias("own_median"), F.percentile("v", 0.9, F.col("times")).alias("own_p90"), F.sum("times").alias("n_own"))
    share = F.when(F.col("cons_len").isNotNull(), F.bround(F.coalesce("n_full", F.lit(0)) / F.col("n_own"), 4))
    figures = own_lengths.join(lengths, KEY).join(whole, KEY, "left").select(*KEY, "own_median", "own_p90", share.alias("full_span_frac"))
    edge = F.greatest(F.lit(p.end_bp), p.end_share * F.col("cons_len"))
    ends = kind("end").join(lengths, KEY).filter((F.col("v") > edge) & (F.col("v") < F.col("cons_len") - edge)).select(*KEY, F.col("v").alias("x"), "cons_len", "times")
    by_factor = phases(ends, factors, p).join(figures.select(*KEY, "own_median", "full_span_frac"), KEY).join(lengths, KEY)
    ratio = F.col("own_median") * F.col("k") / F.col("cons_len")
    passes = ratio.between(p.low_ratio, p.high_ratio) & (F.col("enrichment") >= p.min_enrichment) & (F.col("z") >= p.min_z) & (F.col("full_span_frac") < p.most_full)
    best = by_factor.withColumn("rho", ratio).groupBy(*KEY).agg(
        F.max("n").alias("n_internal_endpoints"), F.max(F.struct("enrichment", (-F.col("k")).alias("k"))).alias("any"),
        F.max(F.when(passes, F.struct("enrichment", "k", "rho", "z"))).alias("best"),
    )
    occupied = boundary_occupancy(ends, factors).groupBy(*KEY, F.col("k").alias("occ_k")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", "occupancy"))), lambda x: x["occupancy"].cast("string")), ";").alias("boundary_occ"),
        F.count_if(F.col("occupancy") >= p.occupied).alias("boundary_support"),
    ) if any(float(k).is_integer() for k in factors) else None
    rows = every.join(lengths, KEY, "left").join(figures, KEY, "left").join(best, KEY, "left")
    if occupied is not None:
        rows = rows.withColumn("occ_k", F.col("best.k")).join(occupied, [*KEY, "occ_k"], "left")
    else:
        rows = rows.withColumn("boundary_occ", F.lit(None).cast("string")).withColumn("boundary_support", F.lit(None).cast("bigint"))
    few = F.col("n_hits_conscoord") < p.min_hits
    guard = (
        F.when(few, REJECTED[0]).when(F.col("cons_len").isNull() | (F.col("cons_len") < p.min_length), REJECTED[1]).when(F.col("conslen_frac") < p.min_agreement, REJECTED[2])
        .when(F.coalesce("n_internal_endpoints", F.lit(0)) < p.min_hits, REJECTED[3])
    )
    rows = rows.withColumn("guard", guard)
    tested, flagged = F.col("guard").isNull(), F.col("guard").isNull() & F.col("best").isNotNull()
    long_enough = tested | F.col("guard").isin(REJECTED[3])
    reason = F.coalesce("guard", F.when(F.col("best").isNotNull(), "over_assembly").when(F.col("full_span_frac") >= p.most_full, "consensus_length_is_realised").otherwise("no_k_passes"))
    return rows.select(
        *KEY, "n_hits", "n_hits_conscoord", F.when(~few, F.col("cons_len")).alias("cons_len"), F.when(~few, F.col("conslen_frac")).alias("conslen_frac"),
        F.when(few, F.col("all_median")).otherwise(F.col("own_median")).alias("median_len"), F.when(few, F.col("all_p90")).otherwise(F.col("own_p90")).alias("p90_len"),
        F.when(long_enough, F.col("full_span_frac")).alias("full_span_frac"), F.when(long_enough, F.coalesce("n_internal_endpoints", F.lit(0))).otherwise(F.lit(0)).alias("n_internal_endpoints"),
        F.when(flagged, F.col("best.k")).otherwise(F.lit(0.0)).alias("k"), F.when(flagged, F.bround(F.col("cons_len") / F.col("best.k"), 1)).alias("unit_len"),
        F.when(flagged, F.bround("best.rho", 3)).alias("rho"), F.when(flagged, F.bround("best.enrichment", 3)).alias("phase_enrich"), F.when(flagged, F.bround("best.z", 2)).alias("phase_z"),
        F.when(flagged, F.coalesce("boundary_occ", F.lit(""))).otherwise(F.lit("")).alias("boundary_occ"), F.when(flagged, F.coalesce("boundary_support", F.lit(0))).otherwise(F.lit(0)).alias("boundary_support"),
        F.when(tested, F.bround("any.enrichment", 3)).alias("best_enrich_any_k"), F.when(tested, -F.col("any.k")).otherwise(F.lit(0.0)).alias("best_enrich_k"),
        flagged.alias("flag"), reason.alias("reason"),
    )


def flag_order(records: DataFrame) -> DataFrame:
    """Flagged families first, each part by enrichment, the largest first; names decide ties."""
    return records.orderBy(F.col("flag").desc(), F.col("phase_enrich").desc_nulls_last(), *KEY)


def decoy_ratio(real: DataFrame, decoy: DataFrame, p: Params = PARAMS) -> DataFrame:
    """n_real, n_decoy (scaled to as many factors) and their ratio, from records of both."""
    every = real.select("flag", F.lit(True).alias("real")).unionByName(decoy.select("flag", F.lit(False).alias("real")))
    both = every.agg(F.count_if(F.col("flag") & F.col("real")).alias("n_real"), F.count_if(F.col("flag") & ~F.col("real")).alias("flagged"))
    scaled = F.col("flagged") * F.lit(len(p.factors) / len(p.decoys))
    return both.select("n_real", scaled.alias("n_decoy"), F.try_divide(F.col("n_real").cast("double"), scaled).alias("real_over_decoy"))


def verdicts(records: DataFrame, clusters: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """records with a verdict on each flag by the clustermates: clusters(cluster_id, tool, family).

    Mates are unflagged members with a length. A flag is confirmed if its length over their
    median is its factor, within ``tolerance``; a family is in one cluster, the last by id counts.
    """
    last = clusters.groupBy(*KEY).agg(F.max("cluster_id").alias("cluster_id"))
    placed = records.join(last, KEY, "left")
    mates = clusters.join(records.filter("NOT flag"), KEY).groupBy("cluster_id").agg(F.count("cons_len").alias("n_mates"), F.median("cons_len").alias("mate"))
    rows = placed.join(mates, "cluster_id", "left").withColumn("n_mates", F.when(F.col("flag") & F.col("cluster_id").isNotNull(), F.coalesce("n_mates", F.lit(0))))
    over, unit = F.bround(F.col("cons_len") / F.col("mate"), 3), F.bround(F.col("unit_len") / F.col("mate"), 3)
    known = F.col("n_mates") > 0
    verdict = (
        F.when(~F.col("flag"), "").when(F.col("cluster_id").isNull(), "suspect_no_cluster").when(~known, "suspect_no_mate_length")
        .when(F.abs(over - F.col("k")) <= tolerance, "confirmed_over_assembly").otherwise("suspect_coordinate_only")
    )
    out = {"n_mates_with_len": F.col("n_mates"), "mate_median_cons_len": F.when(known, F.col("mate")), "length_over_mate": F.when(known, over), "unit_over_mate": F.when(known, unit), "verdict": verdict}
    return rows.select(*records.columns, F.when(F.col("flag"), F.col("cluster_id")).alias("cluster_id"), *[v.alias(k) for k, v in out.items()])


def per_tool(records: DataFrame, untestable: DataFrame | None = None) -> DataFrame:
    """One row a tool: families, tested and flagged ones, the flagged ones' modal factor and medians; untestable(tool, status) adds its tools with zeros."""
    flagged = lambda c: F.when(F.col("flag"), F.col(c))
    confirmed = F.count_if(F.col("flag") & (F.col("verdict") == "confirmed_over_assembly")) if "verdict" in records.columns else F.lit(0).cast("bigint")
    tested = F.count_if(~F.col("reason").isin(*REJECTED))
    table = records.groupBy("tool").agg(
        F.lit("tested").alias("status"), F.count("*").alias("n_families_bed"), tested.alias("n_families_tested"), F.count_if("flag").alias("n_flagged"),
        F.bround(F.count_if("flag") / F.greatest(tested, F.lit(1)), 4).alias("frac_flagged"), F.coalesce(F.mode(flagged("k"), True), F.lit(0.0)).cast("bigint").alias("modal_k"),
        F.median(flagged("cons_len")).alias("median_cons_len"), F.median(flagged("unit_len")).alias("median_unit_len"),
        F.count_if(F.col("flag") & (F.col("boundary_support") >= 2)).alias("n_multi_boundary"), confirmed.alias("n_confirmed"),
    )
    if untestable is None:
        return table
    zero = {"n_families_bed", "n_families_tested", "n_flagged", "modal_k", "n_multi_boundary", "n_confirmed"}
    return table.unionByName(untestable.select("tool", "status", *[(F.lit(0).cast("bigint") if c in zero else F.lit(None).cast("double")).alias(c) for c in table.columns[2:]]))
