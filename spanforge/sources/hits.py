"""Interval annotations: the file reader, and a view of that shape over order lines."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.session import table

#: Columns of an annotation file, in order, with types.
ANNOTATION = (
    "chrom string, chrom_start bigint, chrom_end bigint, name string, score string, strand string, sw_score double, perc_div double, "
    "perc_del double, perc_ins double, query_left string, class_path string, repeat_start bigint, repeat_end bigint, repeat_left bigint, hit_id string"
)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated annotations under a header line; NA, a dot or nothing is null."""
    raw = spark.read.option("sep", "\t").option("header", True).schema(", ".join(c.strip().split()[0] + " string" for c in ANNOTATION.split(","))).csv(path)
    kinds = [c.strip().split() for c in ANNOTATION.split(",")]
    empty = lambda c: F.col(c).isin("NA", "", ".")
    return raw.select(*[F.when(~empty(c), F.col(c).try_cast(t)).alias(c) for c, t in kinds])


#: Base for each letter of a text, in alphabetical order; anything beyond ASCII is taken as z, an N.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTRACGTAACGTACGTACGTACGN"


def letters_of(text: Column, letters: dict[str, str]) -> Column:
    """A text's ASCII characters among ``letters`` as what they stand for; all characters beyond ASCII as z, anything else goes; null stays.

    Texts are taken as UTF-8, in which a character has one byte from 0xC0 on at most and others
    below it, so one pass over the bytes does it.
    """
    table, kept = bytearray(256), set(range(0xC0, 256)) | {ord(x) for x in letters}
    for byte in range(256):
        table[byte] = ord(letters.get(chr(byte) if byte < 0x80 else "z", "-"))
    fixed, gone = bytes(table), bytes(x for x in range(256) if x not in kept)

    def run(values: pa.Array) -> pa.Array:
        return pa.array((None if x is None else x.translate(fixed, gone).decode("ascii") for x in values.to_pylist()), pa.string())

    return F.arrow_udf(run, "string")(text.cast("binary"))


def sequence_of(text: Column) -> Column:
    """A text as a sequence: all its letters as bases; null is empty."""
    return F.coalesce(letters_of(text, dict(zip(LETTERS + LETTERS.upper(), 2 * BASES, strict=True))), F.lit(""))


#: The same in SQL, of a column text.
SEQUENCE_SQL = rf"translate(regexp_replace(regexp_replace(coalesce(text, ''), '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'), '[^\x00-\x7F]', 'z', 'g'), '{LETTERS}{LETTERS.upper()}', '{2 * BASES}')"


def demo_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_of(table(spark, sf_dir, "lineitem"))


def hits_of(lines: DataFrame) -> DataFrame:
    """Order lines as hits of three tools: tool, family, chrom, s, e, strand, div, ord and consensus coordinates."""
    s = F.expr("l_orderkey * 100 + l_partkey % 100")
    size = F.expr("CAST(floor(l_quantity * 10) AS BIGINT)")
    begin = F.expr("1 + l_partkey % 60")
    measured = F.expr("l_returnflag <> 'R'")
    family_length = F.expr("200 + (l_suppkey % 20) * 15")
    return lines.select(
        F.col("l_returnflag").alias("tool"), F.expr("'F' || (l_suppkey % 20)").alias("family"), F.expr("'chr' || l_linenumber").alias("chrom"),
        s.alias("s"), (s + size).alias("e"), F.expr("CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END").alias("strand"), F.expr("l_discount * 100").alias("div"),
        F.expr("((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey").alias("ord"),
        F.when(measured, begin).alias("cons_start"), F.when(measured, F.least(begin + size, family_length)).alias("cons_end"),
        F.when(measured, family_length + F.expr("CASE WHEN l_partkey % 11 = 0 THEN l_partkey % 7 ELSE 0 END")).alias("cons_len"),
        F.expr("CASE WHEN l_partkey % 3 > 0 THEN 'h' || (l_orderkey % 1000) END").alias("hit_id"),
    )


#: The same in SQL, as common table expressions.
DEMO_SQL = """
hits AS (
  SELECT l_returnflag AS tool, 'F' || (l_suppkey % 20) AS family, 'chr' || l_linenumber AS chrom,
         l_orderkey * 100 + l_partkey % 100 AS s, l_orderkey * 100 + l_partkey % 100 + CAST(floor(l_quantity * 10) AS BIGINT) AS e,
         CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_discount * 100 AS div,
         ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey AS ord,
         CASE WHEN l_returnflag <> 'R' THEN 1 + l_partkey % 60 END AS cons_start,
         CASE WHEN l_returnflag <> 'R' THEN least(1 + l_partkey % 60 + CAST(floor(l_quantity * 10) AS BIGINT), 200 + (l_suppkey % 20) * 15) END AS cons_end,
         CASE WHEN l_returnflag <> 'R' THEN 200 + (l_suppkey % 20) * 15 + CASE WHEN l_partkey % 11 = 0 THEN l_partkey % 7 ELSE 0 END END AS cons_len,
         CASE WHEN l_partkey % 3 > 0 THEN 'h' || (l_orderkey % 1000) END AS hit_id
  FROM lineitem)"""
