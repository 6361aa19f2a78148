"""Which clusters, copies and models go on: quotas, measured lengths, models by length mode, over-extension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def path_depth(path: Column) -> Column:
    """Levels of a classification path; 0 for none."""
    return F.when(F.coalesce(path, F.lit("")) == "", 0).otherwise(F.size(F.split(path, ":")))


def quota_select(rows: DataFrame, want: int, draw: Column, share_of_four: float = 0.45) -> DataFrame:
    """``want`` rows by depth of majority_path: all of depth 3, a share of depth 4, the rest from all others.

    rows(cluster_id, majority_path, n_tools, majority_order, candidate); only candidates are taken.
    Within a depth rows are dealt in turn from numbers of tools and orders; draw orders the rows of
    one of these.
    """
    depth = path_depth(F.col("majority_path"))
    r = rows.filter("candidate").withColumn("path_depth", depth).withColumn("__part", F.when(depth.isin(3, 4), depth).otherwise(5))
    # no row beyond the number wanted of its own stratum is ever dealt
    number = F.row_number().over(Window.partitionBy("__part", "n_tools", "majority_order").orderBy(draw, "cluster_id"))
    sizes = r.agg(F.count_if(F.col("__part") == 3).alias("n3"), F.count_if(F.col("__part") == 4).alias("n4"))
    three = F.least(F.col("n3"), F.lit(want))
    four = F.least(F.bround(F.col("n4") * share_of_four).cast("bigint"), F.lit(want) - three)
    quotas = sizes.select(F.explode(F.array(*[F.struct(F.lit(i).alias("__part"), q.alias("__quota")) for i, q in ((3, three), (4, four), (5, F.lit(want) - three - four))])).alias("q")).select("q.*")
    dealt = r.withColumn("__number", number).filter(F.col("__number") <= want)
    place = F.row_number().over(Window.partitionBy("__part").orderBy("__number", "n_tools", "majority_order"))
    return dealt.withColumn("__place", place).join(F.broadcast(quotas), "__part").filter("__place <= __quota").select(*rows.columns, "path_depth")


def measured_or_all(rows: DataFrame, key: str, measured: Column) -> DataFrame:
    """Of each key the rows that are measured, or all of them where none is."""
    some = F.max(F.coalesce(measured, F.lit(False))).over(Window.partitionBy(key))
    return rows.withColumn("__some", some).filter(~F.col("__some") | F.coalesce(measured, F.lit(False))).drop("__some")


def member_medians(loci: DataFrame, key: str) -> DataFrame:
    """key, member, cons_len: the median length of each member's measured loci, of all where a key has no measured length."""
    known = loci.filter("cons_len IS NOT NULL")
    return measured_or_all(known, key, F.col("cons_len_source") == "bed16").groupBy(key, "member").agg(F.median("cons_len").alias("cons_len"))


def over_length(rows: DataFrame, ratio: float = 1.5) -> DataFrame:
    """rows(member, mode_index, span, reference) longer than ratio times their reference, counted by member and by mode: scope, name, n, n_over."""
    over = F.count_if(F.coalesce(F.col("span") > ratio * F.col("reference"), F.lit(False)))
    by = rows.select("span", "reference", F.explode(F.array(F.struct(F.lit("member").alias("scope"), F.col("member").alias("name")), F.struct(F.lit("mode").alias("scope"), F.col("mode_index").cast("string").alias("name")))).alias("x"))
    return by.groupBy("x.scope", "x.name").agg(F.count("*").alias("n"), over.alias("n_over"))


def models(modes: DataFrame, key: str) -> DataFrame:
    """The length modes that get a model, numbered from 0 by centre: credible ones, or else the one with most members, the first on ties."""
    by = Window.partitionBy(key)
    most = F.row_number().over(by.orderBy(F.col("n_members").desc(), "mode_index"))
    rows = modes.withColumn("any", F.max("credible").over(by)).withColumn("most", most).filter("credible OR (NOT any AND most = 1)")
    return rows.withColumn("index", (F.row_number().over(by.orderBy("mode_index")) - 1).cast("int")).withColumn("n_models", F.count("*").over(by)).select(key, "index", "centre", "n_members", "n_tools", "tools", "n_models")


def fan_out(loci: DataFrame, models_: DataFrame, key: str, ratio: float = 1.5, least: int = 2) -> DataFrame:
    """Each model with the number of its loci, of those longer than ratio times its centre, and an error where too few are left.

    loci(key, span): each belongs to the model nearest by ratio, the first on ties; a model of a
    key with several needs ``least`` loci.
    """
    few = models_.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("index", "centre"))).alias("models"))
    far = F.transform("models", lambda m: F.struct(F.abs(F.ln(F.greatest(F.col("span"), F.lit(1)).cast("double")) - F.ln(m["centre"])).alias("far"), m["index"].alias("index"), m["centre"].alias("centre")))
    placed = loci.join(few, key).withColumn("near", F.array_min(far))
    counts = placed.groupBy(key, F.col("near.index").alias("index")).agg(F.count("*").alias("n_loci"), F.count_if(F.col("span") > ratio * F.col("near.centre")).alias("n_over"))
    rows = models_.join(counts, [key, "index"], "left").na.fill(0, ["n_loci", "n_over"]).withColumn("n_eligible", F.col("n_loci") - F.col("n_over"))
    error = F.when((F.col("n_models") > 1) & (F.col("n_eligible") < least), F.concat(F.lit("only "), F.col("n_eligible").cast("string"), F.lit(" loci in this mode")))
    return rows.withColumn("error", error)


def over_extended(length: Column, median: Column, ratio: float = 1.5) -> Column:
    """Whether a consensus is longer than ratio times the median of its members' lengths; no median says no."""
    return F.coalesce(length > ratio * median, F.lit(False))


def keep_members(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """rows whose key is among names."""
    return rows.join(names.select(key).distinct(), key, "left_semi")


def skip_existing(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def top_candidates(rows: DataFrame, n: int) -> DataFrame:
    """The n candidates with most pooled full-length copies; cluster_key decides ties."""
    return rows.filter("candidate").orderBy(F.col("pooled_full_len").desc(), "cluster_key").limit(n)
