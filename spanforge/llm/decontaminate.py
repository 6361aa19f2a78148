"""Benchmark decontamination with suffix arrays of the training texts.

A shard is a part of an Arrow batch. Its words become numbers of the benchmark's vocabulary, 0
for every other word and between documents. The suffixes of a shard are sorted by doubling:
after k rounds they are in order of their first 2^k words, and only those not yet apart are
ranked on. Every suffix of every benchmark item whose window has no word that the shard lacks is
looked up by binary search on both ends, which gives all places where its window stands. From
each such place the longest verbatim match with any item is told by its neighbours in the
suffix array of the benchmark. Shards need no shuffle; a benchmark beyond ``block_bytes`` passes
over the texts in blocks, one after the other, and the matches that a block finds travel with
their row to the next.

Edge cases: a null text or item has no words and is never hit; an item without words has no
window; rows that share a doc_id stay apart, in ``remove`` too; items that share an id count once;
null ids of items count as ``null``; a benchmark without rows leaves all documents clean; further
columns are kept by ``remove`` and left alone by ``scan``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanforge.llm.words import ALNUM, Texts, Words, mix64, pieces, powers
from spanforge.session import cut

RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest int, items array<string>, "
    "spans array<struct<start:int,end:int>>, matches array<struct<start:int,length:int,item_id:string,item_start:int>>"
)
#: What one block finds in a row: covered words, items, and longest matches.
FOUND = "struct<spans:array<struct<start:int,end:int>>,items:array<string>,matches:array<struct<start:int,length:int,item_id:string,item_start:int>>>"
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
MATCH = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32())])
#: Bytes of text in a shard, and blocks that one stage of tasks holds.
SHARD = 2_000_000
BLOCKS = 4


def prefix_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of numbered words; ``common`` compares ranges by them."""
    up, _ = powers(len(text) + 1)
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(mix64(text.astype(np.uint64)) * up[:-1], out=out[1:])
    return out


def common(a: np.ndarray, at_a: np.ndarray, left_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, left_b: np.ndarray) -> np.ndarray:
    """How many words ranges of two texts share from their starts, by prefix hashes; left: words to their ends."""
    _, down = powers(max(len(a), len(b)) + 1)
    low, up = np.zeros(len(at_a), np.int64), np.minimum(left_a, left_b)
    while (live := low < up).any():
        n = (low + up + 1) // 2
        same = (a[at_a + n] - a[at_a]) * down[at_a] == (b[at_b + n] - b[at_b]) * down[at_b]
        low, up = np.where(live & same, n, low), np.where(live & ~same, n - 1, up)
    return low


class Benchmark:
    """Items as windows over numbered words, the numbers in order of the words' hashes, and their suffix array."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        words = Words(Texts(pa.array(texts, pa.string())), ALNUM)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        counts = words.counts
        self.window = window
        self.ids = np.array(ids, dtype=object)
        # a 0 behind each item
        self.begin = words.bounds[:-1] + np.arange(len(counts))
        self.text = np.zeros(len(hashes) + len(counts) + 1, np.int64)
        self.text[np.arange(len(hashes)) + words.rows()] = np.searchsorted(self.vocabulary, hashes) + 1
        item = np.repeat(np.arange(len(ids)), counts + 1) if len(counts) else np.zeros(0, np.int64)
        self.item = np.append(item, max(len(ids) - 1, 0))
        self.left = np.zeros(len(self.text), np.int64)
        self.left[np.arange(len(hashes)) + words.rows()] = np.repeat(words.bounds[1:], counts) - np.arange(len(hashes))
        self.hash = prefix_hashes(self.text)
        self.order = suffix_array(self.text, int(counts.max(initial=1)))
        # suffixes that hold a whole window
        need = np.zeros(len(self.text), np.int64)
        need[np.arange(len(hashes)) + words.rows()] = np.minimum(window, np.repeat(counts, counts))
        self.first = np.flatnonzero((need > 0) & (self.left >= need))
        self.need = need[self.first]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of words other than 0 in the order of their next words, to ``depth`` words at least.

    text ends in ``depth`` zeros; a 0 ends a suffix. Ranks are doubled; groups of one are done.
    """
    rank = text.astype(np.int64)
    order = np.flatnonzero(text)
    step = 1
    todo = order
    if not len(order):
        return order
    # groups by the first word
    order = order[np.argsort(rank[order], kind="stable")]
    while True:
        key = rank[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.flatnonzero(new)
        size = np.diff(np.concatenate([group, [len(order)]]))
        if step == 1:  # a rank is the place of its group's first suffix, from 1
            rank[order] = np.repeat(group, size) + 1
        open_ = np.repeat(size > 1, size)
        if step >= depth or not open_.any():
            return order
        at = np.flatnonzero(open_)
        todo = order[at]
        mine = rank[todo]
        follow = rank[np.minimum(todo + step, len(rank) - 1)]
        follow[rank[todo] == 0] = 0
        resort = np.lexsort((follow, mine))
        todo, mine, follow = todo[resort], mine[resort], follow[resort]
        order[at] = todo
        fresh = np.concatenate([[True], (mine[1:] != mine[:-1]) | (follow[1:] != follow[:-1])])
        begin = np.flatnonzero(fresh)
        rank[todo] = np.repeat(at[begin], np.diff(np.concatenate([begin, [len(todo)]]))) + 1
        step *= 2


def _search(text: np.ndarray, order: np.ndarray, bench: Benchmark, first: np.ndarray, need: np.ndarray, high: bool) -> np.ndarray:
    """For each window, how many suffixes of the text come before it (high: or begin like it)."""
    low, up = np.zeros(len(first), np.int64), np.full(len(first), len(order), np.int64)
    for _ in range(int(len(order)).bit_length()):
        live = low < up
        middle = np.minimum((low + up) // 2, len(order) - 1)
        at = order[middle]
        less = np.zeros(len(low), bool)
        same = np.ones(len(low), bool)
        for j in range(bench.window):
            on = same & (j < need)
            if not on.any():
                break
            a, b = text[at + j], bench.text[np.minimum(first + j, len(bench.text) - 1)]
            less |= on & (a < b)
            same &= ~on | (a == b)
        before = less | (same if high else False)
        low = np.where(live & before, middle + 1, low)
        up = np.where(live & ~before, middle, up)
    return low


def windows_found(text: np.ndarray, order: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of ``order`` that begin like windows, each once: low, up, need; and which of them each found window has, with its item."""
    present = np.zeros(len(bench.vocabulary) + 2, bool)
    present[text] = True
    present[0] = False
    lacking = np.concatenate([[0], np.cumsum(~present[bench.text])])
    live = lacking[bench.first + bench.need] == lacking[bench.first]
    first, need = bench.first[live], bench.need[live]
    low, up = _search(text, order, bench, first, need, False), _search(text, order, bench, first, need, True)
    found = up > low
    ranges, place = np.unique(np.stack([low[found], need[found], up[found]], axis=1), axis=0, return_inverse=True)
    return ranges[:, 0], ranges[:, 2], ranges[:, 1], place.reshape(-1), bench.item[first[found]]


def longest_matches(text: np.ndarray, left: np.ndarray, place: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """From each place the length of the longest verbatim match with any item, and where in the benchmark it stands."""
    hashes, last = prefix_hashes(text), len(bench.order) - 1

    def against(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spot = bench.order[np.clip(rank, 0, last)]
        return common(hashes, place, left, bench.hash, spot, bench.left[spot]), spot

    low, up = np.zeros(len(place), np.int64), np.full(len(place), last + 1, np.int64)
    while (live := low < up).any():
        middle = (low + up) // 2
        n, spot = against(middle)
        less = bench.text[spot + n] < text[place + n]
        low, up = np.where(live & less, middle + 1, low), np.where(live & ~less, middle, up)
    (n, spot), (other, beside) = against(low - 1), against(low)
    return np.maximum(n, other), np.where(n >= other, spot, beside)


def _lists(kind: pa.DataType, row: np.ndarray, n: int, *columns: pa.Array) -> pa.Array:
    """Lists of structs by row; ``row`` rises."""
    values = pa.StructArray.from_arrays(list(columns), fields=list(kind)) if pa.types.is_struct(kind) else columns[0]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def _find(bench: Benchmark, batch: pa.RecordBatch) -> tuple[np.ndarray, pa.StructArray]:
    """Words of each row, and what the benchmark has in common with it (FOUND)."""
    words = Words(Texts(batch.column("text")), ALNUM)
    hashes = words.hashes()
    spot = np.minimum(np.searchsorted(bench.vocabulary, hashes), max(len(bench.vocabulary) - 1, 0))
    number = np.where(bench.vocabulary[spot] == hashes, spot + 1, 0) if len(bench.vocabulary) else np.zeros(len(hashes), np.int64)
    # a 0 behind each document, and as many at the end as a suffix is compared
    counts, rows = words.counts, words.rows()
    n = len(counts)
    begin = words.bounds[:-1] + np.arange(n)
    text = np.zeros(len(number) + n + 2 * bench.window + 2, np.int64)
    text[np.arange(len(number)) + rows] = number
    # most suffixes end at once: a word that isn't in the benchmark ends them
    order = suffix_array(text, bench.window) if len(bench.first) else np.zeros(0, np.int64)
    cover = np.zeros(len(text) + 1, np.int64)
    items, where = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    if len(order):
        low, up, need, of, item = windows_found(text, order, bench)
        size = up - low
        pick = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        place = order[pick]
        np.add.at(cover, place, 1)
        np.add.at(cover, place + np.repeat(need, size), -1)
        doc = np.searchsorted(begin, place, side="right") - 1
        # a document has an item if it has one of the item's ranges
        pairs = np.unique(np.stack([np.repeat(np.arange(len(low)), size), doc], axis=1), axis=0)
        held = np.unique(np.stack([of, item], axis=1), axis=0)
        begins, ends = np.searchsorted(held[:, 0], pairs[:, 0]), np.searchsorted(held[:, 0], pairs[:, 0], side="right")
        many = ends - begins
        at = np.repeat(begins - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        items = np.unique(np.stack([np.repeat(pairs[:, 1], many), held[at, 1]], axis=1), axis=0)
        where = np.unique(place)
    covered = cover.cumsum() > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered[:-1] & (text > 0), [False]]).astype(np.int8))).reshape(-1, 2)
    doc = np.searchsorted(begin, edge[:, 0], side="right") - 1
    spans = _lists(SPAN, doc, n, *(pa.array(edge[:, i] - begin[doc], pa.int32()) for i in range(2)))
    texts = _lists(pa.string(), items[:, 0], n, pa.array(list(bench.ids[items[:, 1]]), pa.string()))
    # matches that aren't the end of a longer one
    left = np.zeros(len(text), np.int64)
    zero = np.flatnonzero(text == 0)
    left[where] = zero[np.searchsorted(zero, where)] - where
    size, spot = longest_matches(text, left[where], where, bench) if len(where) else (where, where)
    new = np.ones(len(where), bool)
    new[1:] = (where[1:] != where[:-1] + 1) | (size[1:] >= size[:-1])
    where, size, spot = where[new], size[new], spot[new]
    doc, item = np.searchsorted(begin, where, side="right") - 1, bench.item[spot]
    matches = _lists(MATCH, doc, n, pa.array(where - begin[doc], pa.int32()), pa.array(size, pa.int32()), pa.array(list(bench.ids[item]), pa.string()), pa.array(spot - bench.begin[item] if len(item) else item, pa.int32()))
    return counts, pa.StructArray.from_arrays([spans, texts, matches], names=["spans", "items", "matches"])


def _joined(found: list[dict]) -> dict:
    """One row's findings of several blocks as one."""
    spans: list[dict] = []
    for s in sorted((s for f in found for s in f["spans"]), key=lambda s: s["start"]):
        if spans and s["start"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], s["end"])
        else:
            spans.append(dict(s))
    matches = sorted((m for f in found for m in f["matches"]), key=lambda m: (m["start"], -m["length"], m["item_id"], m["item_start"]))
    return {"spans": spans, "items": sorted({i for f in found for i in f["items"]}), "matches": matches}


def _verdict(counts: np.ndarray, found: pa.StructArray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Words inside a match, and whether a row is contaminated."""
    spans = found.field("spans")
    flat = spans.flatten()
    size = np.concatenate([[0], np.cumsum(flat.field("end").to_numpy() - flat.field("start").to_numpy())])
    offsets = spans.offsets.to_numpy() - spans.offsets.to_numpy()[0]
    hits = size[offsets[1:]] - size[offsets[:-1]]
    return hits, (hits > 0) & (share * hits >= counts)


def _scanned(piece: pa.RecordBatch, counts: np.ndarray, found: pa.StructArray, share: int) -> pa.RecordBatch:
    hits, bad = _verdict(counts, found, share)
    items = [sorted(set(x)) for x in found.field("items").to_pylist()]
    matches = found.field("matches")
    longest = [max((m["length"] for m in x), default=0) for x in matches.to_pylist()]
    digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
    columns = [piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string()), pa.array(bad), pa.array(longest, pa.int32()), pa.array(items, pa.list_(pa.string())), found.field("spans"), matches]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "items", "spans", "matches"])


def _kept(piece: pa.RecordBatch, counts: np.ndarray, found: pa.StructArray, share: int) -> pa.RecordBatch:
    return piece.filter(pa.array(~_verdict(counts, found, share)[1]))


def _passed(docs: DataFrame, benchmark: DataFrame, window: int, share: int, block_bytes: int, finish: Callable, schema: str | StructType) -> DataFrame:
    """``finish`` on the rows of docs and what all blocks of the benchmark find in them; earlier blocks' findings travel in a column."""
    spark = docs.sparkSession
    own = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").filter("text IS NOT NULL")
    size = own.agg(F.sum(F.octet_length("text") + 16)).head()[0] or 0
    n = int(size // block_bytes) + 1
    carried = "__found"
    while carried in docs.columns:
        carried += "_"
    for i in range(n):
        rows = (own if n == 1 else own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)).collect()
        bench = spark.sparkContext.broadcast(Benchmark([r[0] for r in rows], [r[1] for r in rows], window))
        del rows

        def run(batches: Iterator[pa.RecordBatch], bench=bench, first=i == 0, last=i == n - 1) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, most=SHARD):
                counts, found = _find(bench.value, piece)
                if not first:
                    both = zip(piece.column(carried).to_pylist(), found.to_pylist(), strict=True)
                    found = pa.array([_joined([a, b]) for a, b in both], found.type)
                    piece = piece.drop_columns([carried])
                yield finish(piece, counts, found, share) if last else piece.append_column(carried, found)

        if i == n - 1:
            return docs.mapInArrow(run, schema)
        wider = docs if i else docs.withColumn(carried, F.lit(None).cast(FOUND))
        docs = docs.mapInArrow(run, wider.schema)
        # so many blocks are held by a task at a time
        docs = cut(docs) if i % BLOCKS == BLOCKS - 1 else docs
    raise AssertionError


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, block_bytes: int = 16_000_000) -> DataFrame:
    """docs(doc_id, text) against benchmark(item_id, text): one row for each document.

    n_words, n_hit (words inside a match), n_items, items_sha256, contaminated (n_hit > 0 and
    share * n_hit >= n_words), longest (words of the longest verbatim match), items, spans (of
    covered words), matches (longest verbatim ones that hold a window: where in the document and
    in which item).
    """
    light = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _passed(light, benchmark, window, share, block_bytes, _scanned, RESULT)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, block_bytes: int = 16_000_000) -> DataFrame:
    """docs without the contaminated ones, whole rows as they are. The verdict is reached in the same scan that passes the rows on."""
    return _passed(docs, benchmark, window, share, block_bytes, _kept, docs.schema)
