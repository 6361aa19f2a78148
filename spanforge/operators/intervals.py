"""Interval operators over half-open [s, e) rows. No per-base rows: everything works on segments.

A range join is an equi-join on (keys, bin): both sides are dealt to the bins they touch, and a
pair is kept only in the later of its two first bins, so it comes once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 1024
#: Bases of the tiles that are painted and united on their own.
TILE = 16_384


def binned(df: DataFrame, s: str = "s", e: str = "e", width: int = BIN) -> DataFrame:
    """df with a row for each bin it touches: bin, and first_bin of the row."""
    first = F.expr(f"{s} div {width}")
    return df.withColumn("first_bin", first).withColumn("bin", F.explode(F.sequence(first, F.greatest(first, F.expr(f"({e} - 1) div {width}")))))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = BIN) -> DataFrame:
    """Pairs of left(keys, s, e) and right(keys, s2, e2) that overlap; right's other columns must differ in name."""
    a = binned(left, "s", "e", width)
    b = binned(right, "s2", "e2", width).withColumnRenamed("first_bin", "first_bin2")
    joined = a.join(b, [*keys, "bin"]).filter("s < e2 AND s2 < e AND bin = greatest(first_bin, first_bin2)")
    return joined.drop("bin", "first_bin", "first_bin2")


def point_join(points: DataFrame, segments: DataFrame, keys: list[str], at: str, width: int = BIN) -> DataFrame:
    """Points with the segments(keys, s2, e2) they fall in."""
    a = points.withColumn("bin", F.expr(f"{at} div {width}"))
    return a.join(binned(segments, "s2", "e2", width).drop("first_bin"), [*keys, "bin"]).filter(f"s2 <= {at} AND {at} < e2").drop("bin")


def clipped(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of known chromosomes with s and e inside sizes(chrom, size); what lies outside as a whole goes."""
    inside = df.join(sizes.select("chrom", "size"), "chrom").withColumn("s", F.greatest("s", F.lit(0))).withColumn("e", F.least("e", "size"))
    return inside.filter("e > s").drop("size")


def tiled(df: DataFrame, tile: int) -> DataFrame:
    """df with a row for each tile it touches, cut at the tile's ends."""
    rows = df.withColumn("tile", F.explode(F.sequence(F.expr(f"s div {tile}"), F.greatest(F.expr(f"s div {tile}"), F.expr(f"(e - 1) div {tile}")))))
    return rows.withColumn("s", F.greatest("s", F.col("tile") * tile)).withColumn("e", F.least("e", (F.col("tile") + 1) * tile))


def _stitched(pieces: DataFrame, keys: list[str], tile: int, value: str | None = None) -> DataFrame:
    """Pieces with touching ones across a tile's edge as one, of one value if given. Only pieces at edges are ordered by keys alone."""
    at_edge = (F.col("s") % tile == 0) | (F.col("e") % tile == 0)
    by = Window.partitionBy(*keys).orderBy("s")
    touches = F.lag("e").over(by) == F.col("s")
    if value is not None:
        touches &= F.lag(value).over(by).eqNullSafe(F.col(value))
    edges = pieces.filter(at_edge).withColumn("new", F.when(touches, 0).otherwise(1))
    edges = edges.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    kept = [] if value is None else [F.first(value).alias(value)]
    joined = edges.groupBy(*keys, "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), *kept).drop("run")
    return pieces.filter(~at_edge).select(joined.columns).unionByName(joined)


def sweep(rows: pa.Table, keys: list[str], value: str) -> pa.Table:
    """The painted pieces of rows(keys, tile, s, e, value) in the order of painting, tile after tile.

    All tiles lie on one line, a tile's ends apart from the next one's. A row takes the pieces
    between its ends, so what it costs is bounded by the tile's bases and not by its neighbours.
    """
    group = tile_changes(rows, [*keys, "tile"]).cumsum()
    s, e = rows.column("s").to_numpy(), rows.column("e").to_numpy()
    low = np.minimum.reduceat(s, np.flatnonzero(np.diff(group, prepend=-1)))[group]
    width = np.maximum.reduceat(e - low, np.flatnonzero(np.diff(group, prepend=-1))) + 1
    base = np.concatenate([[0], np.cumsum(width)[:-1]])[group] - low
    points, place = np.unique(np.concatenate([s + base, e + base]), return_inverse=True)
    owner = np.full(len(points), -1, np.int64)
    for row, (i, j) in enumerate(zip(place[: len(s)].tolist(), place[len(s) :].tolist(), strict=True)):
        owner[i:j] = row
    at = np.flatnonzero(owner >= 0)
    owner = owner[at]
    code = pc.fill_null(rows.column(value).combine_chunks().dictionary_encode().indices, -1).to_numpy()[owner]
    # neighbours of one value are one piece
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (code[1:] != code[:-1]) | (group[owner[1:]] != group[owner[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    picked = rows.select([*keys, value]).take(owner[first])
    ends = [pa.array(points[at[first]] - base[owner[first]]), pa.array(points[at[last] + 1] - base[owner[first]])]
    return pa.table([*(picked.column(k) for k in keys), *ends, picked.column(value)], names=[*keys, "s", "e", value])


def in_tiles(rows: DataFrame, near: list[str], order: list[str], columns: list[str], work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on rows in the order of near (the tile's keys) and order, some whole tiles at a time: no task holds more than a batch and one tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            part = pa.Table.from_batches([batch])
            joined = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), part]) if held else part
            ends = np.flatnonzero(tile_changes(joined, near)) - (1 if held else 0)
            if len(ends):
                # the last tile of a batch may go on in the next one
                yield from work(pa.concat_tables([*held, part.slice(0, int(ends[-1]))])).to_batches()
                held = [part.slice(int(ends[-1]))]
            elif batch.num_rows:
                held.append(part)
        if held:
            yield from work(pa.concat_tables(held)).to_batches()

    return rows.repartition(*near).sortWithinPartitions(*near, *order).select(columns).mapInArrow(run, schema)


def _dealt(rows: DataFrame, tile: int) -> DataFrame:
    return rows.withColumn("tile", F.explode(F.sequence(F.expr(f"s div {tile}"), F.greatest(F.expr(f"s div {tile}"), F.expr(f"(e - 1) div {tile}")))))


def _roots(part: pa.Table, key: str, share: float, tile: int) -> np.ndarray:
    """For each row of whole tiles one of its group: those that overlap by ``share`` of the shorter, directly or through others.

    Intervals go to every tile that they touch, and any two that overlap meet in the one where the
    later begins. A tile's are swept from left to right, each that begins there against those still open.
    """
    group = tile_changes(part, [key, "tile"]).cumsum()
    s, e = part.column("s").to_numpy(), part.column("e").to_numpy()
    begins = s // tile == part.column("tile").to_numpy()
    root = np.arange(len(s))
    bounds = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(s))
    for low, up in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        open_ = np.zeros(0, np.int64)
        for i in range(low, up) if up - low > 1 else ():
            open_ = open_[e[open_] > s[i]]
            meets = open_[np.minimum(e[open_], e[i]) - s[i] >= share * np.minimum(e[open_] - s[open_], e[i] - s[i])] if begins[i] else open_[:0]
            if len(meets):
                joined = np.unique(root[meets])
                root[i] = joined[0]
                if len(joined) > 1:
                    own = root[low:i]
                    own[np.isin(own, joined)] = joined[0]
            open_ = np.append(open_, i)
    return root


def overlap_links(rows: DataFrame, key: str, row: str, share: float, tile: int = TILE) -> DataFrame:
    """a, b of rows(key, s, e, row): links between intervals of one key that overlap by ``share`` of the shorter, as few as give the same components.

    Each group of a tile gives one link for each of its members but one, however many pairs it has.
    """
    dealt = _dealt(rows.select(key, "s", "e", row), tile)
    kind = rows.schema[row].dataType.simpleString()

    def work(part: pa.Table) -> pa.Table:
        root = _roots(part, key, share, tile)
        linked = np.flatnonzero(root != np.arange(len(root)))
        name = part.column(row)
        return pa.table([name.take(pa.array(root[linked])), name.take(pa.array(linked))], names=["a", "b"])

    return in_tiles(dealt, [key, "tile"], ["s", "e", row], [key, "tile", "s", "e", row], work, f"a {kind}, b {kind}")


def overlap_groups(rows: DataFrame, key: str, row: str, share: float, tile: int = TILE) -> DataFrame:
    """rows(key, s, e, row, ...) with __group: the least row of those of its tile that overlap by ``share`` of the shorter, directly or through others.

    row names one row, which comes once for each of its tiles with all its columns. __begins: this
    is the first of them; __crosses: there are several; __open: a row of the group crosses, so that
    there may be more of it in another tile. Groups that share a row that crosses are one.
    """
    columns, kinds = rows.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def work(part: pa.Table) -> pa.Table:
        root, n = _roots(part, key, share, tile), part.num_rows
        name = part.column(row).combine_chunks()
        rising = pc.array_sort_indices(name).to_numpy()
        place, least = np.empty(n, np.int64), np.full(n, n)
        place[rising] = np.arange(n)
        np.minimum.at(least, root, place)
        s, e, at = (part.column(c).to_numpy() for c in ("s", "e", "tile"))
        crosses, reaches = (e - 1) // tile > s // tile, np.zeros(n, bool)
        reaches[root[crosses]] = True
        marks = {"__group": name.take(pa.array(rising[least[root]])), "__begins": pa.array(s // tile == at), "__crosses": pa.array(crosses), "__open": pa.array(reaches[root])}
        return pa.table([*(part.column(c) for c in columns), *marks.values()], names=[*columns, *marks])

    marks = f"__group {rows.schema[row].dataType.simpleString()}, __begins boolean, __crosses boolean, __open boolean"
    return in_tiles(_dealt(rows, tile), [key, "tile"], ["s", "e", row], [*columns, "tile"], work, f"{kinds}, {marks}")


def tile_changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a row's keys differ from those of the row before; the first row's don't count."""
    new = np.zeros(rows.num_rows, bool)
    for k in keys:
        code = pc.fill_null(rows.column(k).combine_chunks().dictionary_encode().indices, -1).to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return new


def paint(df: DataFrame, keys: list[str], value: str, order: Column, tile: int = TILE) -> DataFrame:
    """Last-writer-wins paint: keys, s, e, value; of overlapping rows the one with the largest order owns a base.

    Chromosomes are cut into tiles, which are dealt by (keys, tile) and ordered by Spark in the
    order of painting; a task sweeps the tiles that it gets. Of equal orders the larger value wins.
    """
    rows = tiled(df.select(*keys, "s", "e", order.alias("__order"), F.col(value).alias(value)).filter("e > s"), tile)
    near = [*keys, "tile"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*keys, "s", "e", value))
    columns = [*near, "s", "e", value]

    pieces = in_tiles(rows, near, ["__order", value], columns, lambda part: sweep(part, keys, value), kinds)
    return _stitched(pieces, keys, tile, value)


def _united(df: DataFrame, keys: list[str]) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy("s", "e")
    reach = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(*keys, "s", "e").withColumn("new", F.when(reach >= F.col("s"), 0).otherwise(1))
    run = F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("run", run).groupBy(*keys, "run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("run")


def islands(df: DataFrame, keys: list[str], tile: int | None = TILE) -> DataFrame:
    """The union of intervals by keys as disjoint segments: s, e. Touching ones are one. Without a tile the keys' groups are small."""
    if tile is None:
        return _united(df, keys)
    return _stitched(_united(tiled(df.select(*keys, "s", "e").filter("e > s"), tile), [*keys, "tile"]).drop("tile"), keys, tile)


def coverage_fraction(gaps: DataFrame, covers: DataFrame, keys: list[str], row: str) -> DataFrame:
    """gaps(row, keys, s, e) with covered: the share of its bases in the union of covers(keys, s, e); an empty gap has 0."""
    union = islands(covers, keys).select(*keys, F.col("s").alias("s2"), F.col("e").alias("e2"))
    inside = overlap_join(gaps.select(row, *keys, "s", "e").filter("e > s"), union, keys)
    part = inside.groupBy(row).agg(F.sum(F.least("e", "e2") - F.greatest("s", "s2")).alias("bp"))
    return gaps.join(part, row, "left").withColumn("covered", F.coalesce(F.try_divide(F.col("bp"), F.col("e") - F.col("s")), F.lit(0.0))).drop("bp")


def modal_over_span(rows: DataFrame, segments: DataFrame, keys: list[str], row: str, value: str) -> DataFrame:
    """rows with the value that owns most of their bases in segments(keys, s, e, value), the smallest on ties; none is null."""
    other = segments.select(*keys, F.col("s").alias("s2"), F.col("e").alias("e2"), value)
    inside = overlap_join(rows.select(row, *keys, "s", "e"), other, keys).groupBy(row, value).agg(F.sum(F.least("e", "e2") - F.greatest("s", "s2")).alias("bp"))
    best = F.row_number().over(Window.partitionBy(row).orderBy(F.col("bp").desc(), value))
    return rows.join(inside.withColumn("best", best).filter("best = 1").select(row, value), row, "left")
