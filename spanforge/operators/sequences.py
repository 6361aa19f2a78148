"""Sequences and alignments: complements, extraction, terminal repeats, occupancy, consensus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.session import cut

#: Complements (fixed values): each letter and what stands against it.
LETTERS = "ACGTRYKMSWBDHVNacgtrykmswbdhvn"
OPPOSITE = "TGCAYRMKSWVHDBNtgcayrmkswvhdbn"
#: Codes of tied bases (fixed values).
TIED = {
    "A": "A", "C": "C", "G": "G", "T": "T", "AG": "R", "CT": "Y", "GT": "K", "AC": "M", "CG": "S", "AT": "W",
    "CGT": "B", "AGT": "D", "ACT": "H", "ACG": "V", "ACGT": "N",
}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, LETTERS, OPPOSITE))


def extract(seq: Column, start: Column, end: Column, strand: Column) -> Column:
    """seq[start, end) clamped to the sequence, reverse-complemented on the minus strand; empty if nothing is left."""
    low = F.greatest(start, F.lit(0))
    piece = F.substring(seq, low + 1, F.greatest(F.least(end, F.char_length(seq)) - low, F.lit(0)).cast("int"))
    return F.when(strand == "-", reverse_complement(piece)).otherwise(piece)


def interval_id(assembly: Column, chrom: Column, start: Column, end: Column, strand: Column) -> Column:
    """assembly:chrom:start-end_strand, 1-based and closed; a strand other than minus is plus."""
    sign = F.when(strand == "-", "-").otherwise("+")
    return F.concat(assembly, F.lit(":"), chrom, F.lit(":"), (start + 1).cast("string"), F.lit("-"), end.cast("string"), F.lit("_"), sign)


def parse_interval_id(name: Column) -> Column:
    part = lambda i: F.regexp_extract(name, r"^(?:_R_)?([^:]+):(.+):(\d+)-(\d+)_([+-])$", i)
    flipped = name.startswith("_R_")
    sign = F.when(flipped, F.when(part(5) == "-", "+").otherwise("-")).otherwise(part(5))
    return F.struct(part(1).alias("assembly"), part(2).alias("chrom"), (part(3).try_cast("bigint") - 1).alias("start"), part(4).try_cast("bigint").alias("end"), sign.alias("strand"))


def terminal_inverted_repeat(seqs: DataFrame, tolerances: tuple[int, ...] = (0, 1, 2, 3), most: int = 120) -> DataFrame:
    """seqs(id, seq): for each tolerance the longest prefix that meets its own reverse complement with so many mismatches at most."""
    n = F.least(F.lit(most), F.floor(F.char_length("seq") / 2)).cast("int")
    rows = seqs.withColumn("n", n).withColumn("head", F.expr("substring(seq, 1, n)")).withColumn("tail", F.expr("substring(reverse(translate(seq, '" + LETTERS + "', '" + OPPOSITE + "')), 1, n)"))
    pairs = F.slice(F.zip_with(F.split("head", ""), F.split("tail", ""), lambda a, b: a != b), F.lit(1), F.col("n"))
    # before the place of the first mismatch too many
    missed = rows.withColumn("missed", F.filter(F.transform(pairs, lambda x, i: F.when(x, i)), lambda i: i.isNotNull()))
    return missed.select("id", *[F.coalesce(F.get("missed", F.lit(t)), F.greatest("n", F.lit(0))).cast("int").alias(f"tir_{t}") for t in tolerances])


def alignment_cells(rows: DataFrame) -> DataFrame:
    """rows(aln_id, row_id, seq) as cells: aln_id, row_id, col, base, with all gap letters as -."""
    clean = F.translate(F.upper("seq"), "._~", "---")
    return rows.select("aln_id", "row_id", F.posexplode(F.filter(F.split(clean, ""), lambda x: x != "")).alias("col", "base"))


def occupancy(cells: DataFrame) -> DataFrame:
    """aln_id, col, a, c, g, t, bases, cover, occ: bases in a column over the rows whose span takes it in."""
    filled = cells.filter("base <> '-'")
    spans = filled.groupBy("aln_id", "row_id").agg(F.min("col").alias("lo"), F.max("col").alias("hi"))
    events = spans.select("aln_id", F.col("lo").alias("col"), F.lit(1).alias("d")).unionByName(spans.select("aln_id", (F.col("hi") + 1).alias("col"), F.lit(-1).alias("d")))
    steps = events.groupBy("aln_id", "col").agg(F.sum("d").alias("d"))
    counts = cells.groupBy("aln_id", "col").agg(*[F.count_if(F.col("base") == x).alias(x.lower()) for x in "ACGT"], F.count_if(F.col("base") != "-").alias("bases"))
    both = counts.join(steps, ["aln_id", "col"], "left")
    cover = F.sum(F.coalesce("d", F.lit(0))).over(Window.partitionBy("aln_id").orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("cover", cover).drop("d").withColumn("occ", F.coalesce(F.try_divide("bases", "cover"), F.lit(0.0)))


def _clean(rows: DataFrame) -> DataFrame:
    """rows(seq) in upper case with all gap letters as -; a null sequence is empty."""
    return rows.withColumn("seq", F.translate(F.upper(F.coalesce("seq", F.lit(""))), "._~", "---"))


#: All gap letters as -, others in upper case, by byte.
_PLAIN = bytes(ord("-") if chr(i) in "._~" else ord(chr(i).upper()) if i < 128 else i for i in range(256))


def _letters(seq: str) -> np.ndarray:
    """The code of each letter in upper case, all gap letters as -."""
    if seq.isascii():
        return np.frombuffer(seq.encode("ascii").translate(_PLAIN), np.uint8)
    return np.frombuffer(seq.upper().translate({ord(x): "-" for x in "._~"}).encode("utf-32-le"), np.uint32)


def _tally(spans: bool):
    """Of a partition's rows(aln_id, row_id, seq), by column: bases, and the steps of the rows' spans. Column -1 has the number of rows as bases, and their width as a.

    spans: in place of steps a row of column -2 for each with bases, whose ends are a and c.
    """
    names = ["aln_id", "row_id", "col", *"acgt", "bases", "step"]

    def rows_of(aln: list, row: list, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(aln), 10_000):
            part = [pa.array(x[k : k + 10_000], pa.string()) for x in (aln, row)]
            yield pa.RecordBatch.from_arrays([*part, *(pa.array(x[k : k + 10_000], pa.int32() if i == 0 else pa.int64()) for i, x in enumerate(columns))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, np.ndarray] = {}
        number: Counter = Counter()
        width: Counter = Counter()
        for part in (batch.slice(k, 256) for batch in batches for k in range(0, batch.num_rows, 256)):
            ends: list[tuple] = []
            for aln, name, seq in zip(*(part.column(c).to_pylist() for c in ("aln_id", "row_id", "seq")), strict=True):
                number[aln] += 1
                letters = _letters(seq or "")
                n, filled = len(letters), letters != ord("-")
                width[aln] = max(width[aln], n)
                own = held.get(aln)
                if own is None or own.shape[1] <= n:
                    wider = np.zeros((6, n + n // 4 + 2), np.int32)
                    if own is not None:
                        wider[:, : own.shape[1]] = own
                    own = held[aln] = wider
                for i, base in enumerate("ACGT"):
                    own[i, :n] += letters == ord(base)
                own[4, :n] += filled
                at = np.flatnonzero(filled)
                if len(at) and spans:
                    ends.append((aln, name, at[0], at[-1]))
                elif len(at):
                    own[5, at[0]] += 1
                    own[5, at[-1] + 1] -= 1
            if ends:
                alns, rows, low, high = zip(*ends, strict=True)
                none = np.zeros(len(ends), np.int64)
                yield from rows_of(list(alns), list(rows), [none - 2, np.array(low), np.array(high), none, none, none, none])
        for aln, own in held.items():
            at = np.flatnonzero(own.any(axis=0))
            more = {0: width[aln], 4: number[aln]}
            yield from rows_of([aln] * (len(at) + 1), [None] * (len(at) + 1), [np.append(at, -1), *(np.append(x[at], more.get(i, 0)) for i, x in enumerate(own))])

    return run


def _parts(rows: DataFrame, spans: bool) -> DataFrame:
    named = rows.select(*[F.col(c).cast("string").alias(c) for c in ("aln_id", "row_id")], "seq")
    return named.mapInArrow(_tally(spans), "aln_id string, row_id string, col int, a long, c long, g long, t long, bases long, step long")


def _tallied(clean: DataFrame) -> DataFrame:
    """aln_id, col, a, c, g, t, bases, step over all rows; column -1 has the number of rows as bases."""
    return _parts(clean, False).groupBy("aln_id", "col").agg(*[F.sum(x).alias(x) for x in (*"acgt", "bases", "step")])


def row_occupancy(rows: DataFrame) -> DataFrame:
    """``occupancy`` of ``alignment_cells(rows)``, counted by whole rows, each read once; no cell becomes a row of its own."""
    kind = rows.schema["aln_id"].dataType
    parts = cut(_parts(rows, True))
    none = [F.lit(0).cast("bigint").alias(x) for x in (*"acgt", "bases")]
    counts = parts.filter("col >= 0").select("aln_id", "col", *"acgt", "bases", F.lit(0).alias("d"), F.lit(False).alias("own"))
    spans = parts.filter("col = -2").groupBy("aln_id", "row_id").agg(F.min("a").cast("int").alias("lo"), F.max("c").cast("int").alias("hi"))
    ends = spans.select("aln_id", F.explode(F.array(F.struct(F.col("lo").alias("col"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("col"), F.lit(-1).alias("d")))).alias("x"))
    steps = ends.groupBy("aln_id", "x.col").agg(F.sum("x.d").cast("int").alias("d")).select("aln_id", "col", *none, "d", F.lit(False).alias("own"))
    # columns of gaps alone have counts of 0
    width = parts.filter("col = -1").groupBy("aln_id").agg(F.max("a").cast("int").alias("width")).filter("width > 0")
    every = width.select("aln_id", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("col"), *none, F.lit(0).alias("d"), F.lit(True).alias("own"))
    both = counts.unionByName(steps).unionByName(every).groupBy("aln_id", "col").agg(*[F.sum(x).alias(x) for x in (*"acgt", "bases", "d")], F.max("own").alias("own")).filter("own").drop("own")
    cover = F.sum("d").over(Window.partitionBy("aln_id").orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("cover", cover).drop("d").withColumn("occ", F.coalesce(F.try_divide("bases", "cover"), F.lit(0.0)))
    return out.withColumn("aln_id", F.col("aln_id").cast(kind))


def called(columns: DataFrame, n_rows: DataFrame, min_occ: float = 0.5, min_rows: int = 3) -> DataFrame:
    """Columns with match and call: the most frequent base, the code of tied ones, N where there is none."""
    joined = columns.join(n_rows, "aln_id")
    top = F.greatest("a", "c", "g", "t")
    tied = F.concat(*[F.when(F.col(x.lower()) == top, x).otherwise("") for x in "ACGT"])
    code = F.create_map(*[F.lit(x) for kv in TIED.items() for x in kv])
    match = (F.col("occ") >= min_occ) & (F.col("cover") >= F.least(F.lit(min_rows), F.col("n_rows")))
    return joined.withColumn("match", match).withColumn("call", F.when(top == 0, "N").otherwise(code[tied]))


def consensus(calls: DataFrame) -> DataFrame:
    """aln_id, consensus of match columns, rf (the call at a match, a dot elsewhere), first and last match."""
    place = F.array_sort(F.collect_list(F.struct("col", "match", "call")))
    text = lambda f: F.array_join(F.transform("cells", f), "")
    rows = calls.groupBy("aln_id").agg(place.alias("cells"), F.min(F.when(F.col("match"), F.col("col"))).alias("first_match"), F.max(F.when(F.col("match"), F.col("col"))).alias("last_match"))
    return rows.select("aln_id", text(lambda x: F.when(x["match"], x["call"]).otherwise("")).alias("consensus"), text(lambda x: F.when(x["match"], x["call"]).otherwise(".")).alias("rf"), "first_match", "last_match")


def _inside(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """rows with their alignment's bounds, and inside: the bases they have there."""
    own = bounds.withColumnRenamed("aln_id", "__aln")
    joined = rows.join(own, F.col("aln_id").eqNullSafe(F.col("__aln"))).drop("__aln")
    return joined.withColumn("inside", _bases(F.substring("seq", F.col("low") + 1, F.col("high") - F.col("low"))))


def _bases(seq: Column) -> Column:
    return F.char_length(F.replace(seq, F.lit("-"), F.lit("")))


def _trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows cut to their bounds, without the columns in ``gone``; few at a time, as rows become as wide as the alignment."""
    names = ["aln_id", "row_id", "seq", "start", "end", "strand"]
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            out, made, first = [], 0, at
            while at < batch.num_rows and made < 4_000_000:
                seq, low, high, gone = (batch.column(c)[at].as_py() for c in ("seq", "low", "high", "gone"))
                cells = np.frombuffer(seq[low:high].ljust(high - low, "-").encode("utf-32-le"), np.uint32)
                out.append(np.delete(cells, gone).tobytes().decode("utf-32-le"))
                made, at = made + len(out[-1]), at + 1
            part = batch.slice(first, at - first)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "seq" else part.column(c) for c in names], names=names)


def finalize(rows: DataFrame, min_occ: float = 0.5, min_rows: int = 3, min_bases: int = 30, rounds: int = 4) -> DataFrame:
    """rows(aln_id, row_id, seq, start, end, strand) trimmed to well-covered columns, short rows dropped, coordinates moved along.

    A round counts the columns of the kept rows, takes the first and last well-covered one as
    bounds and keeps the rows with ``min_bases`` inside (with any base, where fewer than two have
    so many). Between rounds only the bounds of each alignment are held. Rows end up as wide as
    their alignment.
    """
    rows = cut(_clean(rows.select(F.col("aln_id").cast("string").alias("aln_id"), F.col("row_id").cast("string").alias("row_id"), "seq", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "strand")))
    sizes = cut(rows.groupBy("aln_id").agg(F.max(F.char_length("seq")).alias("width")))
    bounds = sizes.select("aln_id", F.lit(0).alias("low"), F.col("width").alias("high"), F.lit(0).alias("least"))
    by = Window.partitionBy("aln_id")
    for _ in range(rounds):
        columns = _tallied(_inside(rows, bounds).filter("inside >= least"))
        cover = F.sum("step").over(by.orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
        columns = columns.withColumn("cover", cover).withColumn("n_kept", F.max(F.when(F.col("col") < 0, F.col("bases"))).over(by))
        well = (F.col("col") >= 0) & (F.col("bases") >= min_occ * F.greatest("cover", F.lit(1))) & (F.col("cover") >= F.least(F.lit(min_rows), F.col("n_kept"))) & (F.col("cover") > 0)
        found = columns.filter(well).groupBy(F.col("aln_id").alias("own")).agg(F.min("col").alias("first"), (F.max("col") + 1).alias("last"))
        bounds = sizes.join(found, F.col("aln_id").eqNullSafe(F.col("own")), "left").select("aln_id", F.coalesce("first", F.lit(0)).alias("low"), F.coalesce("last", "width").alias("high"))
        enough = _inside(rows, bounds).groupBy("aln_id", "low", "high").agg(F.count_if(F.col("inside") >= min_bases).alias("n"))
        bounds = cut(enough.select("aln_id", "low", "high", F.when(F.col("n") < 2, 1).otherwise(min_bases).alias("least")))
    kept = _inside(rows, bounds).filter("inside >= least")
    used = _tallied(kept).filter("col >= 0 AND bases > 0").groupBy(F.col("aln_id").alias("own")).agg(F.collect_set("col").alias("used"))
    every = F.when(F.col("high") > F.col("low"), F.sequence(F.col("low"), F.col("high") - 1)).otherwise(F.array().cast("array<int>"))
    gone = F.transform(F.array_except(every, F.coalesce("used", F.array().cast("array<int>"))), lambda x: x - F.col("low"))
    bounds = cut(bounds.join(used, F.col("aln_id").eqNullSafe(F.col("own")), "left").select("aln_id", "low", "high", "least", gone.alias("gone")))
    kept = _inside(rows, bounds).filter("inside >= least")
    left, right = _bases(F.expr("substring(seq, 1, low)")), _bases(F.expr("substring(seq, high + 1)"))
    plus = F.coalesce(F.col("strand") != "-", F.lit(True))
    moved = kept.withColumn("start", F.col("start") + F.when(plus, left).otherwise(right)).withColumn("end", F.col("end") - F.when(plus, right).otherwise(left))
    return moved.select("aln_id", "row_id", "seq", "start", "end", "strand", "low", "high", "gone").mapInArrow(_trim, "aln_id string, row_id string, seq string, start long, end long, strand string")
