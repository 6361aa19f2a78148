"""Figures over built packets, alignments of sequences with themselves, and the use of classification paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdicts on a factor by the share of the expected match that is found (fixed values).
SUPPORT = ((0.50, "SUPPORTS"), (0.20, "weak/partial support for"))


# Alignments ----------------------------------------------------------------------------------------


def flanking_repeats(hits: DataFrame, min_identity: float = 80.0, min_cover: float = 0.7, end_share: float = 0.05, least_slop: int = 50) -> DataFrame:
    """Whether a short consensus stands at both ends of a long one: the internal interval, 0-based and half open.

    hits(pair, length, identity, start, end, strand, short_len, long_len) of the short one on the
    long one. Null internal_start and internal_end where the ends aren't both reached, the strands
    differ, the outer hits overlap or fewer than two are good; reason tells which.
    """
    good = (F.col("identity") >= min_identity) & (F.col("length") >= min_cover * F.col("short_len"))
    low, high = F.least("start", "end"), F.greatest("start", "end")
    span = F.struct(low.alias("low"), high.alias("high"), "strand")
    rows = hits.groupBy("pair").agg(
        F.count_if(good).alias("n_hits"), F.min(F.when(good, span)).alias("first"), F.max(F.when(good, span)).alias("last"), F.first("short_len").alias("ltr_len"), F.first("long_len").alias("n"),
    )
    slop = F.greatest(F.floor(end_share * F.col("n")), F.lit(least_slop))
    reason = (
        F.when(F.col("n_hits") < 2, "too_few_hits").when((F.col("first.low") > slop) | (F.col("last.high") < F.col("n") - slop), "not_anchored")
        .when(F.col("first.strand") != F.col("last.strand"), "inverted").when(F.col("last.low") <= F.col("first.high"), "overlapping")
    )
    rows = rows.withColumn("reason", reason)
    found = lambda c: F.when(F.col("reason").isNull(), c)
    return rows.select("pair", "n_hits", "reason", "ltr_len", found(F.col("first.high")).alias("internal_start"), found(F.col("last.low") - 1).alias("internal_end"))


def subject_rollup(hits: DataFrame, least: int = 100, n: int = 20) -> DataFrame:
    """hits(subject, subject_len, q_start, q_end, strand, length): the n subjects with most matches of ``least`` and more, and where these lie in order."""
    good = hits.filter(F.col("length") >= least)
    block = F.concat(F.lit("q"), F.col("q_start").cast("string"), F.lit("-"), F.col("q_end").cast("string"), F.lit("("), "strand", F.lit(")"))
    rows = good.groupBy("subject").agg(
        F.max("subject_len").alias("subject_len"), F.count("*").alias("n_matches"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("q_start", "q_end", "strand", block.alias("b")))), lambda x: x["b"]), " ").alias("blocks"),
    )
    return rows.withColumn("subject", F.substring("subject", 1, 42)).orderBy(F.col("n_matches").desc(), "subject", "subject_len").limit(n)


def factor_support(matches: DataFrame, factors: list[int], tolerance: float = 0.15, least: int = 100) -> DataFrame:
    """For each sequence and factor k: the longest same-strand match with itself at a multiple of len / k, its share of what an array of k has, and a verdict.

    matches(seq, len, q_start, s_start, strand, length).
    """
    every = matches.select("seq", "len").distinct().withColumn("k", F.explode(F.array(*map(F.lit, factors))))
    off = F.col("q_start") - F.col("s_start")
    good = matches.withColumn("off", off).filter((F.col("strand") == "plus") & (F.col("length") >= least) & (F.col("off") > 0) & (F.col("off") <= 0.98 * F.col("len")))
    laid = good.withColumn("k", F.explode(F.array(*map(F.lit, factors)))).withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    target = F.col("j") * F.col("len") / F.col("k")
    at = laid.filter(F.col("off").between(target * (1 - tolerance), target * (1 + tolerance)))
    # of matches that are as long the smallest offset
    best = at.groupBy("seq", "k").agg(F.max(F.struct("length", (-F.col("off")).alias("back"))).alias("b"))
    rows = every.join(best, ["seq", "k"], "left").withColumn("unit", F.col("len") / F.col("k"))
    cover = F.coalesce(F.try_divide(F.col("b.length"), (F.col("k") - 1) * F.col("unit")), F.lit(0.0))
    named = F.concat(F.when(cover >= SUPPORT[0][0], SUPPORT[0][1]).when(cover >= SUPPORT[1][0], SUPPORT[1][1]).otherwise("NO support for"), F.lit(" k="), F.col("k").cast("string"))
    return rows.select("seq", "k", "unit", F.coalesce("b.length", F.lit(0)).alias("best_bp"), F.coalesce(-F.col("b.back"), F.lit(0)).alias("best_offset"), cover.alias("tandem_cover"), named.alias("verdict"))


# Packets -------------------------------------------------------------------------------------------


def engine_disagreement(packets: DataFrame) -> DataFrame:
    """packets(path_depth, first_cons, second_cons) with abs_diff, rel_diff and shallow; a packet without a consensus or path is a failure and no disagreement."""
    good = packets.filter("path_depth > 0 AND first_cons > 0 AND second_cons > 0")
    gap = F.abs(F.col("first_cons") - F.col("second_cons"))
    return good.withColumn("abs_diff", gap).withColumn("rel_diff", gap / ((F.col("first_cons") + F.col("second_cons")) / 2)).withColumn("shallow", F.col("path_depth") <= 4)


def disagreement_by_depth(ok: DataFrame) -> DataFrame:
    return ok.groupBy("path_depth").agg(F.count("*").alias("packets"), F.median("abs_diff").alias("median_abs"), F.median("rel_diff").alias("median_rel"), F.avg((F.col("abs_diff") == 0).cast("double")).alias("frac_exact"))


def packet_health(packets: DataFrame) -> DataFrame:
    """By engine: packets(engine, cons, lint_err, coord_warn, verified, n_rows) summed, nulls as 0, and how many have no consensus."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    none = F.coalesce("cons", F.lit(0)) == 0
    return packets.groupBy("engine").agg(F.count("*").alias("n_packets"), total("lint_err"), total("coord_warn"), total("verified"), total("n_rows"), F.count_if(none).alias("n_degenerate"), F.avg(none.cast("double")).alias("degenerate_rate"))


def support_per_cluster(loci: DataFrame, levels: list[int]) -> DataFrame:
    """loci(cluster, n_tools, any_full): a column with the share of full loci for each number of tools, and whether it never falls."""
    wide = loci.groupBy("cluster").pivot("n_tools", levels).agg(F.avg(F.col("any_full").cast("double")))
    names = [str(x) for x in levels]
    known = F.filter(F.array(*[F.col(f"`{n}`") for n in names]), lambda x: x.isNotNull())
    return wide.select("cluster", *[F.col(f"`{n}`").alias(f"tools_{n}") for n in names], (known == F.array_sort(known)).alias("monotonic"))


# Classification paths --------------------------------------------------------------------------------


def with_tp(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """rows with the tp and tp_status of their path; a path that isn't mapped gets none, and is never guessed."""
    own = mapping.select(F.col("canonical_path").alias("path"), "tp", F.col("status").alias("tp_status")).dropDuplicates(["path"])
    return rows.join(own, "path", "left").withColumn("tp_status", F.coalesce("tp_status", F.lit("unmapped")))


def usage(families: DataFrame, members: DataFrame, mapping: DataFrame) -> DataFrame:
    """scope, canonical_path, n, status: how often each path stands among all families, clustered and candidate members.

    families(member, path); members(member, candidate); each member counts once in a scope.
    """
    status = mapping.select("canonical_path", "status").dropDuplicates(["canonical_path"])
    inside = members.groupBy("member").agg(F.max("candidate").alias("candidate"))
    joined = families.join(inside, "member", "left")
    scopes = F.array(F.lit("all_families"), F.when(F.col("candidate").isNotNull(), "clustered"), F.when(F.col("candidate"), "candidate"))
    rows = joined.select(F.explode(F.filter(scopes, lambda x: x.isNotNull())).alias("scope"), F.col("path").alias("canonical_path"))
    counts = rows.groupBy("scope", "canonical_path").agg(F.count("*").alias("n"))
    return counts.join(status, "canonical_path", "left").select("scope", "canonical_path", "n", F.coalesce("status", F.lit("UNMAPPED")).alias("status"))


def usage_coverage(used: DataFrame) -> DataFrame:
    """By scope: distinct paths, mapped ones, entries, covered and exact ones, and both as percents."""
    mapped = F.col("status") != "UNMAPPED"
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    percent = lambda c: F.bround(100 * F.col(c) / F.greatest(F.col("entries"), F.lit(1)), 1)
    rows = used.groupBy("scope").agg(F.count("*").alias("paths"), F.count_if(mapped).alias("mapped_paths"), F.sum("n").alias("entries"), total(mapped).alias("covered"), total(F.col("status") == "exact").alias("exact"))
    return rows.withColumn("covered_percent", percent("covered")).withColumn("exact_percent", percent("exact"))


def accepted_names(lines: DataFrame) -> DataFrame:
    """name of a class list's lines(value): both columns of each, without comments and header words."""
    text = F.trim("value")
    parts = F.transform(F.split(text, "\t", 2), F.trim)
    rows = lines.filter((text != "") & ~text.startswith("#")).select(F.explode(parts).alias("name"))
    return rows.filter("name <> '' AND name NOT IN ('rm_class', 'dfam_lineage')").distinct()


def long_names(lines: DataFrame) -> DataFrame:
    """short, long of a class list's lines that have both."""
    text = F.trim("value")
    parts = F.split(text, "\t", 2)
    rows = lines.filter((text != "") & ~text.startswith("#")).select(F.trim(F.get(parts, F.lit(0))).alias("short"), F.trim(F.get(parts, F.lit(1))).alias("long"))
    return rows.filter("short <> '' AND long <> '' AND short <> 'rm_class'")


def percentiles(rows: DataFrame, value: str, points: tuple[int, ...] = (5, 25, 50, 75, 95)) -> DataFrame:
    return rows.agg(*[F.percentile(value, p / 100).alias(f"p{p}") for p in points])


def lint_clean(codes: DataFrame) -> DataFrame:
    """codes(packet, severity, code, failed): whether a packet's check ran, found no error and no warning on coordinates."""
    coordinate = (F.col("severity") == "WARN") & F.coalesce(F.col("code").startswith("COORD"), F.lit(False))
    bad = F.coalesce(F.col("failed"), F.lit(False)) | F.coalesce(F.col("severity") == "ERROR", F.lit(False)) | F.coalesce(coordinate, F.lit(False))
    return codes.groupBy("packet").agg((F.count_if(bad) == 0).alias("clean"))


def capped(name: Column, most: int = 80) -> Column:
    """A name of ``most`` characters at most."""
    return F.substring(name, 1, most)


def as_json(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, json: value's structs as JSON text."""
    return rows.select(key, F.to_json(value).alias("json"))
