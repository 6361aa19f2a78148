"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` tables cuts space by k Gaussian projections into cells of width w, and a
query visits its own cell and the neighbours most likely to hold what is near: single steps are
ranked by the query's distance to the cell's walls, and sets of steps come in the order of their
expected scores, worked out once. A table's cells are dealt to slices by hash, large slices to blocks by
vector and by query, so that no task holds more than about BLOCK vectors and ASKED queries; a query
goes to the slices of its visited cells. What the tables find is merged and ranked by exact distance.

k, width and number of probes are fitted together: of those that find ``recall`` of the true
neighbours of TESTS sampled vectors, told by one scan over all rows, the cheapest by candidates
and probes, whose share is measured on ``sample`` vectors (2048 by default, the smallest hashes
of the vector). Every vector is indexed. Equal vectors are indexed once, with their 11 smallest
ids, which is all that 10 neighbours can take. How few candidates are enough depends on the data:
vectors that lie about as far from their nearest as from any other leave no hashing much to save.

Edge cases: vectors that are null, zero, of another length than most, or that hold null or
non-finite parts take no part; a query for which all tables hold fewer than k rows is compared
with all rows, in blocks of queries; repeated rows of one vec_id with one vector count once, and of
different vectors under one vec_id the nearest counts; an empty table gives an empty result;
further columns are left alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm.words import mix64
from spanforge.session import cut

#: Vectors and queries that a task holds at a time.
BLOCK = 16384
ASKED = 2048
#: Vectors whose true neighbours the fit is held against, and what it tries.
TESTS = 64
PROBES = 256
DEPTHS = (2, 4, 6, 8, 10, 13, 16, 20)
WIDTHS = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0)
#: What a probe costs beside the comparison with a candidate.
PROBE_COST = 0.5


def probe_sets(k: int, most: int) -> np.ndarray:
    """Sets of the 2k ranked steps in the order of expected score, as rows of 0 and 1; the first is empty."""
    rank = np.arange(1, 2 * k + 1, dtype=float)
    far = 2 * k + 1 - rank
    score = np.where(rank <= k, rank * (rank + 1) / (4 * (k + 1) * (k + 2)), 1 - far / (k + 1) + far * (far + 1) / (4 * (k + 1) * (k + 2)))
    out = [()]
    heap = [(score[0], (0,))]
    while heap and len(out) < most:
        total, steps = heapq.heappop(heap)
        # a step and its opposite don't go together: their ranks add up
        if all((2 * k - 1 - s) not in steps for s in steps):
            out.append(steps)
        last = steps[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (total - score[last] + score[last + 1], (*steps[:-1], last + 1)))
            heapq.heappush(heap, (total + score[last + 1], (*steps, last + 1)))
    made = np.zeros((len(out), 2 * k), np.int64)
    for i, steps in enumerate(out):
        made[i, list(steps)] = 1
    return made


class Hashing:
    """Projections of all tables, a width, and the order of probes."""

    def __init__(self, dim: int, tables: int, k: int, width: float, probes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables, self.k, self.width = tables, k, width
        self.a = rng.standard_normal((tables, k, dim))
        self.b = rng.random((tables, k)) * width
        self.sets = probe_sets(k, probes)

    def _cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = (np.einsum("tkd,nd->ntk", self.a, x) + self.b) / self.width
        floor = np.floor(value)
        return floor.astype(np.int64), value - floor

    @staticmethod
    def _name(cells: np.ndarray) -> np.ndarray:
        h = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(cells.shape[-1]):
            h = mix64(h + cells[..., j].astype(np.uint64) + np.uint64(j + 1))
        return h.view(np.int64)

    def own(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector in each table."""
        return self._name(self._cells(x)[0])

    def visited(self, x: np.ndarray, tables: range | None = None) -> np.ndarray:
        """The cells that each vector visits as a query: vectors x tables x probes."""
        cell, inside = self._cells(x)
        chosen = slice(None) if tables is None else slice(tables.start, tables.stop)
        cell, inside = cell[:, chosen], inside[:, chosen]
        order = np.argsort(np.concatenate([inside**2, (1 - inside) ** 2], axis=-1), axis=-1)
        # the step at each rank: down in the first k places, up in the others
        move = np.zeros((*order.shape, self.k), np.float32)
        np.put_along_axis(move, (order % self.k)[..., None], np.where(order < self.k, -1, 1)[..., None].astype(np.float32), axis=-1)
        steps = np.matmul(self.sets.astype(np.float32), move)
        return self._name(cell[:, :, None, :] + np.rint(steps).astype(np.int64))


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from differences and not from products."""
    out = np.empty((len(queries), len(rows)))
    for i, q in enumerate(queries):
        d = rows - q
        out[i] = np.sqrt(np.einsum("nd,nd->n", d, d))
    return out


def fit(sample: np.ndarray, tests: np.ndarray, near: np.ndarray, owner: np.ndarray, n: int, tables: int, recall: float = 0.975, seed: int = 7) -> Hashing:
    """The cheapest hashing that finds ``recall`` of the tests' true neighbours: near, each with the number of its test."""
    dim = sample.shape[1]
    far = np.sqrt(((tests[owner] - near) ** 2).sum(1)) if len(near) else np.ones(1)
    unit = float(np.median(far)) or float(far.max()) or 1.0
    best = None
    for k in DEPTHS:
        for width in WIDTHS:
            hashing = Hashing(dim, tables, k, width * unit, PROBES, seed)
            visited = hashing.visited(tests)
            most = visited.shape[2]
            first = np.full(len(near), most)
            own = hashing.own(near) if len(near) else np.zeros((0, tables), np.int64)
            for t in range(tables):
                hit = own[:, t][:, None] == visited[owner, t]
                first = np.minimum(first, np.where(hit.any(1), hit.argmax(1), most))
            probes = int(np.quantile(first, recall, method="higher")) + 1 if len(near) else 1
            if probes > most:
                continue
            cells = hashing.own(sample)
            share = np.mean([np.any([np.isin(cells[:, t], v[t, :probes]) for t in range(tables)], axis=0).mean() for v in visited])
            cost = share * n + PROBE_COST * tables * probes
            if best is None or cost < best[0]:
                best = cost, k, width, probes
    _, k, width, probes = best or (0, DEPTHS[0], 4 * WIDTHS[-1], PROBES)
    return Hashing(dim, tables, k, width * unit, probes, seed)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def nearest_of(d: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest distances, with all ties of the last."""
    return np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])


def exact(index: DataFrame, name: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
    """query, node, score of index(node, embedding): for each asked vector the k nearest of every batch, the true ones among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, node = _matrix(batch.column("embedding")), batch.column("node").to_numpy()
            for i, d in enumerate(distances(asked, x) if len(x) * len(asked) < 1 << 22 else (distances(a[None], x)[0] for a in asked)):
                at = nearest_of(d, k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), name[i])), pa.array(node[at]), pa.array(d[at])], names=["query", "node", "score"])

    return index.mapInArrow(run, "query long, node long, score double")


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part, all of the length most have."""
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(parts, lambda x: x != 0)
    valid = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), parts.alias("embedding")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").filter(finite)
    dims = valid.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.col("count").desc(), "dim").limit(1).collect()
    return valid.filter(F.size("embedding") == (dims[0]["dim"] if dims else 0))


def fitted(index: DataFrame, n: int, k: int, tables: int, sample: int) -> Hashing:
    """The hashing for index(node, embedding); what comes to the driver is the sample and the tests' neighbours."""
    rows = index.orderBy(F.xxhash64("node"), "node").limit(sample).toArrow()
    node, x = rows.column("node").to_numpy(), _matrix(rows.column("embedding").combine_chunks())
    tests = node[:TESTS]
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "node"))
    found = exact(index, tests, x[:TESTS], k + 1).filter("query <> node").withColumn("place", place).filter(F.col("place") <= k)
    near = found.select("query", "node").join(index, "node").toArrow()
    if not near.num_rows:
        return fit(x, x[:TESTS], x[:0], np.zeros(0, np.int64), n, tables)
    order = np.argsort(tests)
    owner = order[np.searchsorted(tests, near.column("query").to_numpy(), sorter=order)]
    return fit(x, x[:TESTS], _matrix(near.column("embedding").combine_chunks()), owner, n, tables)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, tables: int = 8, sample: int = 2048) -> DataFrame:
    """vectors(vec_id, embedding): the k nearest others of each row whose vec_id is divisible by every.

    query_id, rank, vec_id, score; ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    valid = usable(vectors)

    # a vector once, by its bytes; of its ids the smallest k + 1
    name = F.xxhash64(F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)))
    place = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    once = valid.withColumn("node", name).dropDuplicates(["vec_id", "node"])
    members = cut(once.withColumn("nth", place).filter(F.col("nth") <= k + 1))
    index = members.filter("nth = 1").select("node", "embedding")
    n = index.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(fitted(index, n, k, tables, sample))
    queries = once.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "node", "embedding")
    asked = cut(queries.select("node", "embedding").dropDuplicates(["node"]))
    found = cut(candidates(index, asked, shared, n, k))

    # the exact way for queries that all tables leave short
    enough = found.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") >= min(k + 1, n)).select("query")
    short = cut(asked.join(enough, F.col("node") == F.col("query"), "left_anti").select("node", "embedding"))
    blocks = -(-short.count() // ASKED)
    for i in range(blocks):
        some = short.filter(F.pmod(F.xxhash64("node"), F.lit(blocks)) == i).toArrow()
        found = found.unionByName(exact(index, some.column("node").to_numpy(), _matrix(some.column("embedding").combine_chunks()), k + 1))

    # ties at the bound may be many: the nodes' ids decide
    named = found.distinct().join(members.select("node", "vec_id"), "node").groupBy("query", "vec_id").agg(F.min("score").alias("score"))
    top = Window.partitionBy("query").orderBy("score", "vec_id")
    best = named.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k + 1).select(F.col("query").alias("node"), "vec_id", "score")
    own = queries.select(F.col("vec_id").alias("query_id"), "node").join(best, "node").filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return own.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def candidates(index: DataFrame, asked: DataFrame, shared: Broadcast, n: int, k: int) -> DataFrame:
    """query, node, score of index(node, embedding) and asked(node, embedding): the k + 1 nearest, with ties, that each table's visited cells hold."""
    kind = index.schema["embedding"].dataType.simpleString()
    slices = -(-n // BLOCK)

    def slice_of(cell: np.ndarray) -> np.ndarray:
        return (mix64(cell.view(np.uint64)) % np.uint64(slices)).astype(np.int32)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value.own(_matrix(batch.column("embedding")))
            for t in range(own.shape[1]):
                cell = np.ascontiguousarray(own[:, t])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), t, np.int32)), pa.array(slice_of(cell)), pa.array(cell), batch.column("node"), batch.column("embedding")], names=["t", "slice", "cell", "node", "embedding"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                seen = shared.value.visited(_matrix(one.column("embedding")))[0]
                to = [np.unique(slice_of(np.ascontiguousarray(c))) for c in seen]
                t = np.repeat(np.arange(len(to), dtype=np.int32), [len(x) for x in to])
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(np.concatenate(to)), one.column("node").take(pa.array(np.zeros(len(t), np.int64))), one.column("embedding").take(pa.array(np.zeros(len(t), np.int64)))], names=["t", "slice", "query", "q"])

    indexed = index.mapInArrow(cells, f"t int, slice int, cell long, node long, embedding {kind}")
    visiting = cut(asked.mapInArrow(visits, f"t int, slice int, query long, q {kind}"))
    blocks = lambda df, most, name: df.groupBy("t", "slice").agg(F.ceil(F.count("*") / (2 * most)).cast("int").alias(name))
    sizes = cut(blocks(indexed, BLOCK, "blocks").join(blocks(visiting, ASKED, "parts"), ["t", "slice"]))
    left = indexed.join(sizes, ["t", "slice"]).withColumn("block", F.pmod("node", F.col("blocks")).cast("int"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("t", "slice", "block", "part", "cell", "node", "embedding")
    right = visiting.join(sizes, ["t", "slice"]).withColumn("part", F.pmod("query", F.col("parts")).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("t", "slice", "block", "part", "query", "q")
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def compare(key, rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not rows.num_rows or not wanted.num_rows:
            return schema.empty_table()
        cell = rows.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, node = cell[order], rows.column("node").to_numpy()[order]
        x = _matrix(rows.column("embedding").combine_chunks())[order]
        q, name = _matrix(wanted.column("q").combine_chunks()), wanted.column("query").to_numpy()
        t = key[0].as_py()
        out = [(node[:0], node[:0], np.zeros(0))]
        for i in range(len(q)):
            seen = np.unique(shared.value.visited(q[i : i + 1], range(t, t + 1))[0, 0])
            low, up = np.searchsorted(cell, seen), np.searchsorted(cell, seen, side="right")
            size = up - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            if not len(at):
                continue
            d = distances(q[i : i + 1], x[at])[0]
            # k + 1, as one may be the query's own vector
            best = nearest_of(d, k + 1)
            out.append((np.full(len(best), name[i]), node[at[best]], d[best]))
        return pa.table([np.concatenate([o[j] for o in out]) for j in range(3)], schema=schema)

    by = ["t", "slice", "block", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, "query long, node long, score double").distinct()
