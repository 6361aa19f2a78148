"""Rows that an engine gives back: their places, their sequence against the genome, their ends; flanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from spanforge.operators.sequences import reverse_complement
from spanforge.sources.drops import split
from spanforge.sources.indexed import BLOCK, fetch


def flipped(strand: Column) -> Column:
    return F.when(strand == "+", "-").otherwise("+")


def strand_called(strand: Column) -> Column:
    """Whether the strand is one; anything else is taken as plus."""
    return F.coalesce(strand.isin("+", "-"), F.lit(False))


def read_back(ids: DataFrame, copies: DataFrame) -> DataFrame:
    """ids(row_id) as chrom, start, end, strand of the genome; null where an id can't be read or its copy isn't known.

    copies(seq_id, chrom, start, end, strand). Three forms: seq_id; _R_ and seq_id, which turns the
    strand; seq_id:a-b_s, a range from 1 on the extracted sequence, which on the minus strand counts
    from the 3' end, and s of minus turns the strand.
    """
    name = F.regexp_replace("row_id", "^_R_", "")
    turned = F.col("row_id").startswith("_R_")
    part = lambda i: F.regexp_extract(name, r"^(.+):(\d+)-(\d+)_([+-])$", i)
    known = copies.select("seq_id", "chrom", F.col("start").alias("s0"), F.col("end").alias("e0"), F.col("strand").alias("strand0"))
    rows = ids.withColumn("seq_id", name).withColumn("head", part(1)).withColumn("a", part(2).try_cast("bigint")).withColumn("b", part(3).try_cast("bigint")).withColumn("sign", part(4)).withColumn("turned", turned)
    whole = rows.join(known, "seq_id", "left")
    inner = known.select(F.col("seq_id").alias("other"), *[F.col(c).alias(f"{c}_") for c in ("chrom", "s0", "e0", "strand0")])
    # a row that needs no second look keeps its own name: what would be left of it, a chromosome or nothing, is the same for very many
    found = F.col("s0").isNotNull() & F.col("chrom").isNotNull()
    both = whole.withColumn("other", F.when(found | (F.col("head") == ""), F.col("seq_id")).otherwise(F.col("head"))).join(inner, "other", "left")
    plus = F.col("strand0_") == "+"
    start = F.when(F.col("s0").isNotNull(), F.col("s0")).when(plus, F.col("s0_") + F.col("a") - 1).otherwise(F.col("e0_") - F.col("b"))
    end = F.when(F.col("s0").isNotNull(), F.col("e0")).when(plus, F.col("s0_") + F.col("b")).otherwise(F.col("e0_") - F.col("a") + 1)
    own = F.when(F.col("s0").isNotNull(), F.col("strand0")).when(F.col("sign") == "-", flipped(F.col("strand0_"))).otherwise(F.col("strand0_"))
    strand = F.when(F.col("turned"), flipped(own)).otherwise(own)
    chrom = F.coalesce("chrom", "chrom_")
    return both.select(*ids.columns, chrom.alias("chrom"), F.when(chrom.isNotNull(), start).alias("start"), F.when(chrom.isNotNull(), end).alias("end"), F.when(chrom.isNotNull(), strand).alias("strand"))


def read_back_known(ids: DataFrame, copies: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows of ``read_back`` that have a place, and a count of those dropped: unreadable without a copy of their name and no range in it, unknown with a range of no known copy."""
    ranged = F.regexp_replace("row_id", "^_R_", "").rlike(r"^.+:\d+-\d+_[+-]$")
    lost = F.col("chrom").isNull()
    return split(read_back(ids, copies), {"unreadable": lost & ~F.coalesce(ranged, F.lit(False)), "unknown_copy": lost})


def verify_rows(rows: DataFrame, blocks: DataFrame, size: int = BLOCK) -> DataFrame:
    """rows(row_id, chrom, start, end, strand, seq) with reason: null where the row without gaps is what the genome has there.

    blocks(chrom, block, seq): the genome in blocks of ``size``, of which a row reads those that it
    touches. A chromosome that the genome lacks, and a row without a place, are reasons of their own.
    """
    clean = F.translate(F.upper(F.coalesce("seq", F.lit(""))), ".-", "")
    given = rows.withColumn("__clean", clean).drop("seq")
    found = fetch(given, blocks, size)
    ref = F.upper(F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
    reason = F.when(F.col("seq").isNull(), "chrom_absent").when(F.col("start").isNull() | F.col("end").isNull(), "no_place").when(F.col("__clean") != ref, "sequence_mismatch")
    return found.withColumn("reason", reason).withColumn("row_len", F.char_length("__clean")).withColumn("ref_len", F.char_length(ref)).withColumn("seq", F.col("__clean")).drop("__clean")


def failures(checked: DataFrame, most: int = 20) -> DataFrame:
    """The first ``most`` rows of ``verify_rows`` that failed, by row_id, with both lengths."""
    return checked.filter("reason IS NOT NULL").orderBy("row_id", "chrom", "start", "end").limit(most).select("row_id", "chrom", "start", "end", "strand", "reason", "row_len", "ref_len")


def verification(checked: DataFrame) -> DataFrame:
    """n_rows, n_verified, n_bad, all_verified of verified rows."""
    return checked.agg(F.count("*").alias("n_rows"), F.count_if(F.col("reason").isNull()).alias("n_verified"), F.count_if(F.col("reason").isNotNull()).alias("n_bad"), (F.count_if(F.col("reason").isNotNull()) == 0).alias("all_verified"))


def trim_columns(rows: DataFrame, low: Column, high: Column, least: int = 1) -> DataFrame:
    """Aligned rows(aln_id, row_id, seq, start, end, strand) cut to columns [low, high), coordinates moved by the bases that go.

    On the minus strand those on the left come off the end. Rows with fewer than ``least`` bases
    inside go; columns that are gaps in all rows left go too.
    """
    bases = lambda x: F.char_length(F.replace(x, F.lit("-"), F.lit("")))
    cut = rows.withColumn("lo", low.cast("int")).withColumn("hi", high.cast("int"))
    left, right = F.expr("substring(seq, 1, lo)"), F.expr("substring(seq, hi + 1)")
    cut = cut.withColumn("nl", bases(left)).withColumn("nr", bases(right)).withColumn("seq", F.expr("substring(seq, lo + 1, greatest(hi - lo, 0))"))
    plus = F.col("strand") == "+"
    cut = cut.withColumn("start", F.col("start") + F.when(plus, F.col("nl")).otherwise(F.col("nr"))).withColumn("end", F.col("end") - F.when(plus, F.col("nr")).otherwise(F.col("nl")))
    cut = cut.filter(bases(F.col("seq")) >= least).select("aln_id", "row_id", "seq", "start", "end", "strand")
    cells = F.filter(F.transform(F.split("seq", ""), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda c: (c["x"] != "-") & (c["x"] != ""))
    used = cut.select("aln_id", F.explode(cells).alias("c")).groupBy("aln_id").agg(F.array_sort(F.collect_set("c.i")).alias("used"))
    joined = cut.join(used, "aln_id")
    kept = F.array_join(F.transform("used", lambda i: F.substring(F.col("seq"), i + 1, F.lit(1))), "")
    return joined.withColumn("seq", kept).select("aln_id", "row_id", "seq", "start", "end", "strand")


def with_flanks(rows: DataFrame, blocks: DataFrame, sizes: DataFrame, flank: int, size: int = BLOCK) -> DataFrame:
    """rows(row, chrom, start, end, strand) as sequences with and without flanks, and the flanks that the genome has.

    blocks(chrom, block, seq), sizes(chrom, size): the genome in blocks and its lengths; rows of
    other chromosomes go. Flanks are added on the genome, before a minus row is turned. That the
    flanked length is the row's and both flanks' is asserted.
    """
    joined = rows.select("row", "chrom", "start", "end", "strand").join(sizes.select("chrom", F.col("size").alias("__size")), "chrom")
    wide = joined.withColumn("__start", F.greatest(F.col("start") - flank, F.lit(0))).withColumn("__end", F.col("end") + flank)
    found = fetch(wide.withColumnsRenamed({"start": "__s", "end": "__e", "__start": "start", "__end": "end"}), blocks, size)
    before = F.col("__s") - F.col("start")
    after = F.least("__size", "end") - F.col("__e")
    minus = F.col("strand") == "-"
    turned = lambda x: F.when(minus, reverse_complement(x)).otherwise(x)
    inner = F.substring(F.col("seq"), (before + 1).cast("int"), (F.col("__e") - F.col("__s")).cast("int"))
    out = found.select(
        "row", turned(inner).alias("seq"), turned(F.col("seq")).alias("flanked"), F.when(minus, after).otherwise(before).cast("bigint").alias("flank_left"), F.when(minus, before).otherwise(after).cast("bigint").alias("flank_right"), (F.col("__e") - F.col("__s")).alias("element_bp"),
    )
    right = F.char_length("flanked") == F.char_length("seq") + F.col("flank_left") + F.col("flank_right")
    n = F.char_length("flanked") - F.char_length(F.replace(F.upper("flanked"), F.lit("N"), F.lit("")))
    checked = F.when(right, F.char_length("flanked")).otherwise(F.raise_error(F.lit("flank accounting failed")).cast("int"))
    return out.withColumn("length", checked).withColumn("n_bases", n).withColumn("n_fraction", n / F.greatest(F.char_length("flanked"), F.lit(1)))
