"""Near copies among vectors by sorted projection passes.

Each pass draws 64 random directions; the signs of a vector's products, concatenated, are its key.
Vectors are put in order of (label, key), dealt to tasks as ranges of that order, and each is
compared by cosine with the ``window`` vectors that follow; the ends of neighbouring ranges are
compared in a second step. Pairs that reach the threshold are united across passes. How many passes
are made follows from the rows of the largest label: vectors at the threshold must share the
leading signs that bring them within a window, and passes go on until those that never do are
expected to be under ``missed`` of all.

Equal vectors under one label are one node with a count, so their copies make no pairs. A vector
all of whose window is linked may have more links than windows show: such vectors are compared with
all of their component, in tiles of TILE vectors dealt over tasks, which give counts and no pairs.

Edge cases: vectors that are null, zero, of another length than most or hold null or non-finite
parts, and rows with a null label or vec_id, link with nothing; every row is returned, repeated rows
of one vec_id too, each of which counts as a vector; a null vec_id has a null component and is kept;
an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.functions.graph import connected_components
from spanforge.llm.ann import _matrix
from spanforge.session import cut

#: Vectors of one side of a tile, rows of a range of the order, and passes that are dealt at a time.
TILE = 2048
RANGE = 50_000
ROUND = 8
BITS = 64


def passes_for(n: int, window: int, cosine: float, missed: float) -> int:
    """Passes until pairs at the threshold among n vectors of a label have met but for ``missed``."""
    agree = 1 - math.acos(min(1.0, cosine)) / math.pi
    meet = 0.75 * agree ** max(0.0, math.log2(max(n, 1) / window) + 1)
    return max(4, math.ceil(math.log(missed) / math.log(1 - meet)))


def keys(x: np.ndarray, number: int) -> np.ndarray:
    """The signs along pass ``number``'s directions as one number, whose order is that of the signs."""
    directions = np.random.default_rng((number, 12)).standard_normal((x.shape[1], BITS))
    bits = (x @ directions >= 0).astype(np.uint8)
    return (np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    # by the largest part first, as squares of very small or large ones leave the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def band(x: np.ndarray, group: np.ndarray, window: int, cosine: float, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places i < j <= i + window, j >= first, of one group whose vectors reach the threshold."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(64, window)
    for low in range(0, len(x), step):
        up = min(low + step, len(x))
        far = min(up + window, len(x))
        if far <= first:
            continue
        i, j = np.nonzero(x[low:up] @ x[low:far].T >= cosine)
        i, j = i + low, j + low
        good = (j > i) & (j - i <= window) & (j >= first)
        i, j = i[good], j[good]
        good = group[i] == group[j]
        left.append(i[good])
        right.append(j[good])
    return np.concatenate(left), np.concatenate(right)


def _saturated(i: np.ndarray, size: int, window: int) -> np.ndarray:
    return np.flatnonzero(np.bincount(i, minlength=size) >= window)


def _pairs(nodes: DataFrame, numbers: range, rows: int, window: int, cosine: float) -> DataFrame:
    """a, b (a < b) linked in these passes; a = b where a whole window was."""
    kind = nodes.schema["embedding"].dataType.simpleString()
    schema = f"a long, b long, edge int, place int, number int, label long, node long, embedding {kind}"
    names = ["a", "b", "edge", "place", "number", "label", "node", "embedding"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("embedding"))
            for number in numbers if batch.num_rows else ():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), number, np.int32)), batch.column("label"), pa.array(keys(x, number)), batch.column("node"), batch.column("embedding")], names=["number", "label", "key", "node", "embedding"])

    def linked(node: np.ndarray, i: np.ndarray, j: np.ndarray, full: np.ndarray, vectors: pa.DataType) -> pa.RecordBatch:
        a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        a, b = np.concatenate([a, node[full]]), np.concatenate([b, node[full]])
        none = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), vectors)]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *none], names=names)

    def edge(rows: pa.Table, number: int) -> pa.RecordBatch:
        none = pa.nulls(rows.num_rows, pa.int64())
        columns = [rows.column(c).combine_chunks() for c in ("number", "label", "node", "embedding")]
        return pa.RecordBatch.from_arrays([none, none, pa.array(np.full(rows.num_rows, number, np.int32)), pa.array(np.arange(rows.num_rows, dtype=np.int32)), *columns], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carry, fresh = TaskContext.get().partitionId(), None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
            if fresh:
                # the head of this range meets the tail of the one before
                yield edge(rows.slice(0, window), 2 * part)
                fresh = False
            node, group = rows.column("node").to_numpy(), _groups(rows)
            i, j = band(_unit(_matrix(rows.column("embedding").combine_chunks())), group, window, cosine, carry.num_rows if carry is not None else 0)
            yield linked(node, i, j, _saturated(i, len(node), window), batch.column("embedding").type)
            carry = rows.slice(max(0, rows.num_rows - window))
        if carry is not None:
            yield edge(carry, 2 * part + 1)

    def _groups(rows: pa.Table) -> np.ndarray:
        number, label = rows.column("number").to_numpy(), rows.column("label").to_numpy()
        new = np.ones(len(number), bool)
        new[1:] = (number[1:] != number[:-1]) | (label[1:] != label[:-1])
        return np.cumsum(new)

    def seam(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("edge", "ascending"), ("place", "ascending")])
        tail = int((rows.column("edge").to_numpy() % 2 == 1).sum())
        i, j = band(_unit(_matrix(rows.column("embedding").combine_chunks())), _groups(rows), window, cosine, tail)
        good = i < tail
        node, i, j = rows.column("node").to_numpy(), i[good], j[good]
        return pa.table([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], names=["a", "b"])

    spark = nodes.sparkSession
    parts = max(-(-rows * len(numbers) // RANGE), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["number", "label", "key", "node"]
    dealt = nodes.mapInArrow(deal, f"number int, label long, key long, node long, embedding {kind}").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    made = cut(dealt.mapInArrow(compare, schema))
    # edge 2p + 1 is the tail of range p and 2p + 2 the head of the next
    edges = made.filter("edge IS NOT NULL").withColumn("seam", F.expr("edge DIV 2 + edge % 2"))
    seams = edges.groupBy("seam").applyInArrow(seam, "a long, b long")
    return made.filter("a IS NOT NULL").select("a", "b").unionByName(seams).distinct()


def _tiles(full: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """Of full(component, node), compared with all of nodes(component, node, embedding, copies, dense): node, dense, n by tiles.

    A node has its rows linked with dense nodes counted; a dense one those with the others too.
    """
    sizes = nodes.join(full.select("component").distinct(), "component", "left_semi").groupBy("component").agg(F.count("*").alias("n"), F.sum(F.col("dense").cast("long")).alias("d"))
    sizes = cut(sizes.select("component", F.ceil(F.col("n") / TILE).cast("int").alias("blocks"), F.ceil(F.col("d") / TILE).cast("int").alias("parts")))
    known = nodes.join(sizes, "component")
    left = known.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = known.filter("dense").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64())])

    def compare(key, rows: pa.Table, dense: pa.Table) -> pa.Table:
        if not rows.num_rows or not dense.num_rows:
            return schema.empty_table()
        x, y = (_unit(_matrix(t.column("embedding").combine_chunks())) for t in (rows, dense))
        a, b = rows.column("node").to_numpy(), dense.column("node").to_numpy()
        linked = x @ y.T >= cosine
        linked &= a[:, None] != b[None, :]
        own = rows.column("dense").to_numpy()
        out = linked.astype(np.int64)
        # what is dense itself is counted from the other side's view, over all rows
        from_dense = (~own).nonzero()[0]
        counts = [(a[from_dense], out[from_dense] @ dense.column("copies").to_numpy()), (b, rows.column("copies").to_numpy() @ out)]
        return pa.table([np.concatenate([c[i] for c in counts]) for i in (0, 1)], schema=schema)

    by = ["component", "block", "part"]
    columns = [*by, "node", "embedding", "copies", "dense"]
    made = left.select(columns).groupBy(*by).cogroup(right.select(columns).toDF(*columns).groupBy(*by)).applyInArrow(compare, "node long, n long")
    return made.groupBy("node").agg(F.sum("n").alias("n"))


def near_copies(vectors: DataFrame, cosine: float = 0.93, window: int = 48, missed: float = 0.01) -> DataFrame:
    """vectors(vec_id, embedding, label): vec_id, n_links, component_id, kept of every row."""
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(parts, lambda x: x != 0)
    own = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    valid = own.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").filter(finite)
    dims = valid.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.col("count").desc(), "dim").limit(1).collect()
    valid = valid.filter(F.size("embedding") == (dims[0]["dim"] if dims else 0))
    # a vector once a label, by its bytes
    name = F.xxhash64("label", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)))
    named = valid.select("vec_id", F.xxhash64("label").alias("label"), name.alias("node"), "embedding")
    nodes = cut(named.groupBy("label", "node").agg(F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("low")))
    largest = nodes.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    total = largest[1] or 0
    passes = passes_for(largest[0], window, cosine, missed) if total > 1 else 0
    pairs = None
    for at in range(0, passes, ROUND):
        made = _pairs(nodes.select("label", "node", "embedding"), range(at, min(at + ROUND, passes)), total, window, cosine)
        pairs = made if pairs is None else pairs.unionByName(made)
    if pairs is None:
        pairs = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    pairs = cut(pairs.distinct())
    full = pairs.filter("a = b").select(F.col("a").alias("node"))
    links = pairs.filter("a <> b")
    component = connected_components(links)

    placed = nodes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    marked = placed.join(full.withColumn("dense", F.lit(True)), "node", "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
    marked = cut(marked.select("component", "node", "embedding", "copies", "dense"))
    flags = marked.select("node", "copies", "dense")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # links of dense nodes are counted in tiles
    sparse = both.join(flags.filter("NOT dense").select(F.col("node").alias("a")), "a", "left_semi").join(flags.filter("NOT dense").select(F.col("node").alias("b"), "copies"), "b")
    counted = sparse.groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("n"))
    if not full.isEmpty():
        counted = counted.unionByName(_tiles(marked.filter("dense"), marked, cosine)).groupBy("node").agg(F.sum("n").alias("n"))
    result = placed.select("node", "component", "copies").join(lows, "component").join(counted, "node", "left")
    result = result.select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))

    # rows that take part by their node, the others as they are
    usable = valid.select("vec_id", name.alias("node")).join(result, "node").select("vec_id", "n_links", "component_id")
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") == (dims[0]["dim"] if dims else 0)) & finite
    rest = own.filter(~F.coalesce(takes_part, F.lit(False))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
