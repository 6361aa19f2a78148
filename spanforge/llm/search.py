"""Ranked lexical search by MaxScore, a shard of documents at a time.

Terms are maximal runs of letters, digits and everything beyond ASCII, A-Z lower-cased. One pass
over all texts counts documents, terms and, for the items' terms, the documents holding them; a
second builds the posting lists of each shard (up to SHARD documents of a task) and ranks them.
Within a shard an item's lists are ordered by the most that each can add. Those at the bottom that
even together can't reach the score of the k-th document so far are non-essential: documents are
taken from the essential lists only, and a non-essential list is probed, from the largest down,
for those that can still reach it. A task keeps k documents an item over its shards, so the bar
rises; tasks' documents are merged by groups of tasks, then by item.

Items go in blocks of about ``block_terms`` terms, whose vocabulary and weights are sent to tasks
and bound what the driver holds; each block is two passes over the texts. A text is never held
whole as words: long ones are counted in segments that end between terms. Terms are told by
64-bit hashes.

Edge cases: null and empty texts have no terms and are not counted; each row of docs is a document
of its own, also with a repeated or null doc_id (null comes last among equal scores); repeated rows
of one item and text are one item, and different texts of one item_id are one item with the terms
of all; an item without terms, or whose terms stand nowhere, has no rows; empty tables give an
empty result; further columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm.words import ALNUM, Texts, Words, pieces
from spanforge.session import cut

#: Documents whose posting lists a task holds at a time, and those that it scores at a time.
SHARD = 32768
RANGE = 4096
#: Tasks whose documents are merged first.
FAN = 256
#: Bytes of one text that are counted at a time.
SEGMENT = 1 << 20


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of documents with n terms each: 75 and the share of the mean length."""
    if not len(n) or int(n.max()) <= (1 << 62) // (25 * max(docs, 1)):
        return 75 + 25 * n * docs // max(terms, 1)
    return np.array([75 + 25 * int(x) * docs // max(terms, 1) for x in n], dtype=np.int64)


def _segments(texts: Texts) -> Iterator[Texts]:
    """One long text in parts that end between terms."""
    at, end = 0, len(texts.data)
    while at < end:
        to = min(at + SEGMENT, end)
        # a term longer than a segment is read to its end
        while to < end and ALNUM[texts.data[to]] and ALNUM[texts.data[to - 1]]:
            gaps = np.flatnonzero(~ALNUM[texts.data[at:to]])
            if len(gaps) and gaps[-1] > 0:
                to = at + int(gaps[-1])
            else:
                ahead = np.flatnonzero(~ALNUM[texts.data[to : to + SEGMENT]])
                to = to + int(ahead[0]) if len(ahead) else min(to + SEGMENT, end)
        part = Texts.__new__(Texts)
        part.data, part.offsets = texts.data[at:to], np.array([0, to - at], dtype=np.int64)
        yield part
        at = to


def count_terms(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the number of terms; and row, term's place in the sorted vocabulary, occurrences."""
    texts = Texts(column)
    parts = _segments(texts) if len(texts) == 1 and len(texts.data) > SEGMENT else [texts]
    n, keys = np.zeros(len(texts), np.int64), []
    for part in parts:
        words = Words(part, ALNUM)
        n += words.counts
        if len(words) and len(vocabulary):
            h = words.hashes()
            place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            known = vocabulary[place] == h
            keys.append(np.unique(words.rows()[known] * len(vocabulary) + place[known], return_counts=True))
    if not keys:
        none = np.zeros(0, np.int64)
        return n, none, none, none
    key, slot = np.unique(np.concatenate([k for k, _ in keys]), return_inverse=True)
    tf = np.zeros(len(key), np.int64)
    np.add.at(tf, slot, np.concatenate([c for _, c in keys]))
    return n, key // len(vocabulary), key % len(vocabulary), tf


class Shard:
    """Posting lists by term: documents' places in rising order, and what an occurrence adds before weights."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, vocabulary: int):
        order = np.lexsort((doc, term))
        self.doc, term, tf = doc[order], term[order], tf[order]
        self.impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.doc])
        self.bounds = np.searchsorted(term, np.arange(vocabulary + 1))
        self.best = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.best, term, self.impact)
        self.size = len(m)

    def search(self, terms: np.ndarray, weights: np.ndarray, top: Top) -> None:
        """Put the documents that can be among the k best for these terms into top."""
        most = weights * self.best[terms]
        order = np.argsort(most, kind="stable")
        order = order[most[order] > 0]
        if not len(order):
            return
        terms, weights, reach = terms[order], weights[order], np.cumsum(most[order])
        for low in range(0, self.size, RANGE):
            lists = []
            for t, w in zip(terms, weights, strict=True):
                a, b = self.bounds[t], self.bounds[t + 1]
                i, j = a + np.searchsorted(self.doc[a:b], (low, low + RANGE)) if self.size > RANGE else (a, b)
                lists.append((self.doc[i:j] - low, w, self.impact[i:j]))
            essential = int(np.searchsorted(reach, top.bar))
            score = np.zeros(RANGE, np.int64)
            for at, w, impact in lists[essential:]:
                score[at] += w * impact
            can = np.flatnonzero(score)
            for j in range(essential - 1, -1, -1):
                can = can[score[can] + reach[j] >= top.bar]
                if not len(can):
                    break
                at, w, impact = lists[j]
                if len(at):
                    spot = np.minimum(np.searchsorted(at, can), len(at) - 1)
                    hit = at[spot] == can
                    score[can[hit]] += w * impact[spot[hit]]
            can = can[score[can] >= top.bar]
            if len(can):
                top.add(score[can], can + low)


class Top:
    """The k best documents of an item so far: scores, ids and whether an id is null."""

    def __init__(self, k: int):
        self.k, self.bar = k, 1
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = self.nulls = self.null

    def among(self, ids: np.ndarray, nulls: np.ndarray) -> Top:
        self.ids, self.nulls = ids, nulls
        return self

    def add(self, score: np.ndarray, place: np.ndarray) -> None:
        score, ids, null = np.concatenate([self.score, score]), np.concatenate([self.id, self.ids[place]]), np.concatenate([self.null, self.nulls[place]])
        best = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.id, self.null = score[best], ids[best], null[best]
        if len(best) == self.k:
            self.bar = max(1, int(self.score[-1]))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (its hash), qtf of items(item_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = Words(Texts(batch.column("text")), ALNUM)
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(words.rows())), pa.array(words.hashes().view(np.int64))], names=["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", "text").distinct().mapInArrow(run, f"item_id {kind}, term long")
    return rows.groupBy("item_id", "term").agg(F.count("*").alias("qtf"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_terms: int = 1_000_000) -> DataFrame:
    """docs(doc_id, text), items(item_id, text): item_id, rank, doc_id, score of the k best documents of each item."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    wanted = cut(item_terms(items))
    blocks = max(1, -(-wanted.count() // block_terms))
    out = None
    for b in range(blocks):
        rows = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        part = _block(texts, rows, wanted.schema["item_id"].dataType.simpleString(), k)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _block(texts: DataFrame, rows: list, kind: str, k: int) -> DataFrame:
    """The k best documents of a block's items: two passes over the texts, and a table of k rows an item."""
    spark, sc = texts.sparkSession, texts.sparkSession.sparkContext
    names = sorted({r["item_id"] for r in rows}, key=lambda x: (x is None, x))
    vocabulary = np.unique(np.array([r["term"] for r in rows], np.int64).view(np.uint64))
    shared = sc.broadcast(vocabulary)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen, total = np.zeros(len(shared.value), np.int64), 0, 0
        for batch in pieces(batches):
            n, _, term, _ = count_terms(batch.column("text"), shared.value)
            seen, total = seen + int((n > 0).sum()), total + int(n.sum())
            df += np.bincount(term, minlength=len(df))
        at = np.flatnonzero(df)
        fill = np.zeros(len(at), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int64()), pa.array([*df[at], 0], pa.int64()), pa.array([*fill, seen], pa.int64()), pa.array([*fill, total], pa.int64())], names=["term", "df", "docs", "terms"])

    sums = texts.select("text").mapInArrow(tally, "term long, df long, docs long, terms long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect()
    docs, terms = next(((r["docs"], r["terms"]) for r in sums if r["term"] == -1), (0, 0))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in sums:
        if r["term"] >= 0:
            weights[r["term"]] = weight(r["df"], docs)
    number = {name: i for i, name in enumerate(names)}
    asked: list[tuple[list[int], list[int]]] = [([], []) for _ in names]
    for r, t in zip(rows, np.searchsorted(vocabulary, np.array([r["term"] for r in rows], np.int64).view(np.uint64)), strict=True):
        own = asked[number[r["item_id"]]]
        own[0].append(int(t))
        own[1].append(int(r["qtf"] * weights[t]))
    queries = sc.broadcast([(np.array(t, np.int64), np.array(w, np.int64)) for t, w in asked])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in queries.value]
        held: list[tuple] = []
        size = 0

        def score() -> None:
            base = np.cumsum([0, *(len(h[0]) for h in held)])
            n, ids, nulls = (np.concatenate([h[i] for h in held]) for i in (0, 4, 5))
            row, term, tf = (np.concatenate([h[i] + (at if i == 1 else 0) for h, at in zip(held, base, strict=False)]) for i in (1, 2, 3))
            shard = Shard(row, term, tf, lengths(n, docs, terms), len(shared.value))
            for (t, w), top in zip(queries.value, tops, strict=True):
                shard.search(t, w, top.among(ids, nulls))
            held.clear()

        for batch in pieces(batches):
            ids = batch.column("doc_id")
            held.append((*count_terms(batch.column("text"), shared.value), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
            size += batch.num_rows
            if size >= SHARD:
                score()
                size = 0
        if held:
            score()
        part = TaskContext.get().partitionId() // FAN
        count = [len(t.score) for t in tops]
        ids = pa.array(np.concatenate([t.id for t in tops]), mask=np.concatenate([t.null for t in tops])) if tops else pa.array([], pa.int64())
        scores = np.concatenate([t.score for t in tops]) if tops else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(tops), dtype=np.int32), count)), pa.array(np.full(len(scores), part, np.int32)), ids, pa.array(scores)], names=["item", "part", "doc_id", "score"])

    found = texts.mapInArrow(rank, "item int, part int, doc_id long, score long")
    for by in (["item", "part"], ["item"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    named = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {kind}")
    best = cut(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    shared.destroy()
    queries.destroy()
    return best
