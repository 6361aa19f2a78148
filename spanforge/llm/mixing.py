"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the mix by its weight; a share above ``max_epochs`` times the source
is clamped there and the excess goes to the open sources by weight, until none is above its cap.
A source then gives whole repetitions of every document, and its fractional repetition goes to
documents in the order of a seeded digest until the target is met; the document at the boundary
gives its first words only, so a source's words come within one word of its target.

Edge cases: a null or empty text has size 0 and takes 0; a null source is a source of its own,
after all others; rows that share a doc_id count one by one; an empty table gives an empty
result; further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm.spread import unused
from spanforge.session import cut

#: ASCII white space separates words.
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_fill(sources: DataFrame, total: Column, max_epochs: int) -> DataFrame:
    """sources(weight, source_size, ...) with target: least of the cap and the level by weight.

    Sources are taken by cap over weight. The one at which the level first stays under the cap,
    and those after it, are open. ``total`` is the mix's size as a fraction (numerator over 2).
    One row a source is ordered in a single task; documents never are.
    """
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy((cap / F.col("weight")).asc(), F.col("rank").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    steps = sources.select(
        "*",
        cap.alias("cap"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("clamped"),
        F.sum("weight").over(after).alias("open_weight"),
        F.sum("source_size").over(Window.partitionBy()).alias("all_size"),
    )
    # level = (total - clamped) / open_weight, kept as a fraction of whole numbers
    steps = steps.withColumn("over", total - 2 * F.col("clamped")).withColumn("under", 2 * F.col("open_weight"))
    fits = F.col("over") * F.col("weight") <= F.col("cap") * F.col("under")
    first = F.min(F.when(fits, F.struct("pos", "over", "under"))).over(Window.partitionBy())
    steps = steps.withColumn("pos", F.row_number().over(order)).withColumn("first", first)
    level = (F.col("weight") * F.col("first.over")).cast("double") / F.col("first.under").cast("double")
    return steps.withColumn(
        "target", F.when(F.col("pos") < F.coalesce(F.col("first.pos"), F.lit(2147483647)), F.col("cap").cast("double")).otherwise(level)
    ).select(*sources.columns, "target")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    percent: int = 150,
    max_epochs: int = 2,
    seed: str = "mix",
    bucket_digits: int = 3,
) -> DataFrame:
    """docs(doc_id, text, source) as doc_id, size, source_size, target, whole, taken; one row for each row.

    weights: repeat over the sources in code point order. percent: size of the mix against all
    sizes. bucket_digits: hex digits of the digest that split a source, so that no task ever
    orders a whole source.
    """
    draw = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = cut(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")))
    sized = sized.withColumn("draw", draw).withColumn("bucket", F.substring("draw", 1, bucket_digits))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    buckets = cut(buckets.withColumn("missing", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit(""))))

    rank = F.row_number().over(Window.orderBy("missing", "source"))
    by_source = buckets.groupBy("missing", "source").agg(F.sum("bucket_size").alias("source_size")).withColumn("rank", rank)
    by_source = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1).cast("bigint"))
    # twice the mix's size, a whole number
    total = F.floor(F.col("all_size") * percent / 50)
    filled = water_fill(by_source.filter("source_size > 0"), total, max_epochs)
    filled = by_source.select("missing", "source", "source_size").join(filled.select("missing", "source", "target"), ["missing", "source"], "left")
    quota = F.coalesce(F.round("target"), F.lit(0)).cast("bigint")
    filled = filled.select(
        "missing", "source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        F.floor(quota / F.greatest("source_size", F.lit(1))).alias("whole"),
        quota.alias("quota"),
    )
    filled = filled.withColumn("rest", F.col("quota") - F.col("whole") * F.col("source_size"))

    ordered = Window.partitionBy("missing", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("bucket_size").over(ordered), F.lit(0)))
    plan = starts.join(filled, ["missing", "source"]).select("missing", "source", "bucket", "source_size", "target", "whole", "rest", "start")

    keyed = sized.withColumn("missing", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    joined = keyed.join(plan, ["missing", "source", "bucket"])
    inside = Window.partitionBy("missing", "source", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.least(F.greatest(F.col("rest") - begin, F.lit(0)), F.col("size"))
    return joined.select("doc_id", "size", "source_size", "target", "whole", (F.col("whole") * F.col("size") + part).alias("taken"))


def repetitions(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """docs with a row for each repetition the mix takes: copy (from 1; __copy if docs has a copy) and, in text, its words.

    The last repetition of a boundary document is cut behind the words it gives. Rows that share a
    doc_id and a size get one each of what the mix takes of such rows, so their sum is the mix's.
    """
    key, taken, nth, number, row = (unused(docs, x) for x in ("__key", "__taken", "__nth", "__number", "__row"))
    copy = "copy" if unused(docs, "copy") == "copy" else unused(docs, "__copy")
    # as one value, in which null equals null
    shares = mixed.filter("size > 0").select(F.struct("doc_id", "size").alias(key), F.col("taken").alias(taken))
    wanted = cut(shares.groupBy(key).agg(F.sum(taken).alias(taken), F.count("*").alias(number)))
    same = F.struct(F.col("doc_id"), count_words(F.col("text")).alias("size")) == F.col(key)
    joined = docs.join(wanted.filter((F.col(number) == 1) & (F.col(taken) > 0)).drop(number), same)
    shared = wanted.filter(F.col(number) > 1).select(key)
    if not shared.isEmpty():
        # checkpointed, so that a row keeps its number
        several = cut(docs.join(shared, same).withColumn(row, F.monotonically_increasing_id()))
        ranked = _numbered(several.select(row, key, F.xxhash64("text").alias(taken)), key, taken, row, nth).select(row, nth)
        parts = cut(shares.join(shared, key, "left_semi").withColumn(row, F.monotonically_increasing_id()))
        parts = _numbered(parts, key, taken, row, nth).select(key, nth, taken)
        dealt = several.join(ranked, row).join(parts, [key, nth]).filter(F.col(taken) > 0)
        joined = joined.unionByName(dealt.select(joined.columns))
    size = F.col(key)["size"]
    joined = joined.withColumn(nth, F.explode(F.sequence(F.lit(1), F.ceil(F.col(taken) / size).cast("int"))))
    left = F.col(taken) - (F.col(nth) - 1) * size
    # a word with the white space before it
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(words, 1, F.greatest(left, F.lit(1)).cast("int")), "")
    joined = joined.withColumn("text", F.when(left >= size, F.col("text")).otherwise(head))
    return joined.select(*docs.columns, F.col(nth).alias(copy))


def _numbered(rows: DataFrame, key: str, order: str, row: str, name: str, buckets: int = 1024) -> DataFrame:
    """rows with their place, from 1, among those of their key: by hash buckets of ``order``, so that no task orders all of a key.

    Rows that are alike in order are dealt over 64 buckets by their number.
    """
    bucket, start = f"{name}_bucket", f"{name}_start"
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(order), F.lit(buckets)) * 64 + F.pmod(F.col(row), F.lit(64)))
    before = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(key, bucket).agg(F.count("*").alias(start)).withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(key, bucket).orderBy(order, row))
    return dealt.join(starts, [key, bucket]).withColumn(name, F.col(start) + inside).drop(bucket, start)
