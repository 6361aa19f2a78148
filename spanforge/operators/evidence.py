"""What hits say of each family: counts, lengths, coverage, divergence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.operators.copies import MEMBER, copy_counts, near_full
from spanforge.operators.intervals import islands


def consensus_depth(hits: DataFrame, lengths: DataFrame, least: int = 3) -> DataFrame:
    """tool, family, covered: the share of consensus places 1 to length that ``least`` hits or more take in.

    hits(tool, family, cons_start, cons_end), lengths(tool, family, length). Ends are summed by
    place first, so a family is as many rows as its consensus has places, however many its hits.
    """
    ends = hits.filter("cons_start IS NOT NULL AND cons_end >= cons_start").select(*MEMBER, F.explode(F.array(F.struct(F.col("cons_start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("cons_end") + 1).alias("at"), F.lit(-1).alias("d")))).alias("x"))
    steps = ends.groupBy(*MEMBER, F.col("x.at").alias("at")).agg(F.sum("x.d").alias("d"))
    by = Window.partitionBy(*MEMBER).orderBy("at")
    runs = steps.withColumn("depth", F.sum("d").over(by.rowsBetween(Window.unboundedPreceding, 0))).withColumn("to", F.lead("at").over(by)).filter(F.col("depth") >= least)
    inside = runs.join(lengths, MEMBER).withColumn("places", F.greatest(F.least("to", F.col("length") + 1) - F.greatest("at", F.lit(1)), F.lit(0)))
    return inside.groupBy(*MEMBER).agg((F.sum("places") / F.first("length")).alias("covered"))


def family_evidence(hits: DataFrame) -> DataFrame:
    """hits(tool, family, chrom, s, e, strand, ord, div and consensus columns) as one row a family.

    n_hits, n_copies (hits merged by their gaps), n_full_len (of the hits' own lengths), genomic_bp
    (bases under the union of hits), modal_len (the smallest of the most frequent), cov_ge3_frac
    (null without a modal length) and div_median.
    """
    length = F.mode("cons_len", True)
    figures = hits.groupBy(*MEMBER).agg(F.count("*").alias("n_hits"), F.count_if(near_full(F.col("cons_len"))).alias("n_full_len"), length.alias("modal_len"), F.round(F.median("div"), 6).alias("div_median"))
    merged = copy_counts(hits)
    union = islands(hits, [*MEMBER, "chrom"]).groupBy(*MEMBER).agg(F.sum(F.col("e") - F.col("s")).alias("genomic_bp"))
    lengths = figures.filter("modal_len > 0").select(*MEMBER, F.col("modal_len").alias("length"))
    both = figures.join(merged, MEMBER).join(union, MEMBER, "left").join(consensus_depth(hits, lengths), MEMBER, "left")
    share = F.when(F.col("modal_len") > 0, F.round(F.coalesce("covered", F.lit(0.0)), 6))
    return both.select(*MEMBER, "n_hits", "n_copies", "n_full_len", F.coalesce("genomic_bp", F.lit(0)).alias("genomic_bp"), "modal_len", share.alias("cov_ge3_frac"), "div_median")
