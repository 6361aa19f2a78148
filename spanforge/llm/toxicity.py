"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Each word, between a start and an end mark, is a sequence of bytes. For the toxic and for the
ordinary class a model of order ``ORDER`` is counted from labelled rows: its highest order by how
often a gram stands there, each lower one by continuation counts, that is by how many bytes come
before a gram (a gram at a word's start has nothing before it and counts as often as it stands).
A context that a class has seldom or never seen backs off to shorter ones, and the shortest to the
continuation counts of all documents, which both classes share, so a rare expression tells nothing
unless a class has seen its parts. A word's score is the difference of its log-likelihoods under
the two models; a text's features are the mean over all its words, and the largest mean over a
window of words and over a pair of them, all per word. A logistic curve fitted on labelled rows
kept back from the models turns these into a score.

Labels are learned from the ``most_rows`` rows of each class with the smallest hashes of doc_id,
a documented bound; shared counts come from every document, and every text is scored whole.

Edge cases: a null or empty text has no words and gets the score of a text all of whose features
are 0; rows that share a doc_id are scored one by one; of labels that share a doc_id the largest
counts; null labels aren't learned from; where a class has no labelled row every score is the
share of toxic labels; an empty table gives an empty result; further columns are kept by
``remove`` and left alone by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm.words import ALNUM, LOWER, Texts, Words, pieces
from spanforge.session import cut

ORDER = 8
#: The orders that both classes share: continuation counts over all documents.
SHARED = 3
WINDOW = 8
DISCOUNT = 0.75
#: Counts that a context owes to its backoff beside what is discounted.
OWED = 20.0
#: What a word's difference must exceed to count in the sum of notable ones.
NOTABLE = 1.5
FEATURES = 4
START, END = 1, 2


def distinct_words(part: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a batch, the first word of each kind, and each word's kind."""
    words = Words(Texts(part.column("text")), ALNUM)
    _, first, kind = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return words, first, kind


def letters(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen words' bytes between marks, one after the other, and the place of each start.

    Words are whole, as scripts without spaces have words of any length; ``pieces`` bounds their sum.
    """
    start = words.start[chosen]
    size = words.end[chosen] - start
    at = np.concatenate([[0], np.cumsum(size + 2)])
    out = np.full(at[-1], END, np.uint64)
    out[at[:-1]] = START
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at[:-1] + 1, size) + within] = LOWER[words.texts.data[np.repeat(start, size) + within]]
    return out, at


def grams(text: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ``order`` bytes that end at each place, and which places have so many since their start.

    A key holds the bytes themselves, so no two grams share one. Marks let a gram end, never begin, a word.
    """
    key = text.copy()
    for j in range(1, order):
        key[j:] |= text[:-j] << np.uint64(8 * j)
    since = np.arange(len(text)) - np.repeat(at[:-1], np.diff(at))
    return key, since >= order - 1


#: Grams of each order that a task holds before it passes them on.
HELD = 1_000_000
COUNTED = "n int, key long, toxic long, ordinary long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, key, toxic, ordinary: the classes' grams of ORDER and shorter ones at a word's start, and all grams of SHARED + 1."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def merge(n: int, key: np.ndarray, counts: np.ndarray) -> None:
        if n in held:
            key, counts = np.concatenate([held[n][0], key]), np.concatenate([held[n][1], counts])
        unique, inverse = np.unique(key, return_inverse=True)
        held[n] = unique, np.stack([np.bincount(inverse, counts[:, c], len(unique)) for c in range(2)], axis=1)

    def passed(most: int) -> Iterator[pa.RecordBatch]:
        for n in [n for n, (key, _) in held.items() if len(key) > most]:
            key, counts = held.pop(n)
            columns = [np.full(len(key), n, np.int32), key.view(np.int64), counts[:, 0].astype(np.int64), counts[:, 1].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["n", "key", "toxic", "ordinary"])

    for part in pieces(batches):
        words, first, kind = distinct_words(part)
        if not len(first):
            continue
        text, at = letters(words, first)
        label = part.column("toxic").fill_null(2).to_numpy()[words.rows()]
        by = np.stack([np.bincount(kind[label == c], minlength=len(first)) for c in (1, 0)], axis=1).astype(float)
        learned = by.any(axis=1)
        key, whole = grams(text, at, SHARED + 1)
        merge(SHARED + 1, key[whole], np.zeros((whole.sum(), 2)))
        for n in range(SHARED + 1, ORDER):
            some = np.flatnonzero(learned & (np.diff(at) >= n))
            key, _ = grams(text, at, n)
            if len(some):
                merge(n, key[at[some] + n - 1], by[some])
        if learned.any():
            key, whole = grams(text, at, ORDER)
            whole &= np.repeat(learned, np.diff(at))
            merge(ORDER, key[whole], np.repeat(by, np.diff(at), axis=0)[whole])
        yield from passed(HELD)
    yield from passed(0)


def shared_base(counted: DataFrame) -> DataFrame:
    """key, p: P(byte | the bytes before it) by continuation counts over all documents, of the grams that a class has seen."""
    tail = F.col("key").bitwiseAND(F.lit((1 << 8 * SHARED) - 1))
    kinds = counted.filter(f"n = {SHARED + 1}").groupBy(tail.alias("key")).agg(F.count("*").alias("before"))
    context = Window.partitionBy(F.shiftright("key", 8))  # at most a row for each byte
    total, follow = F.sum("before").over(context), F.count("*").over(context)
    p = F.greatest(F.col("before") - DISCOUNT, F.lit(0.0)) / total + DISCOUNT * follow / total / 256
    seen = counted.filter("toxic + ordinary > 0").select(tail.alias("key")).distinct()
    return kinds.withColumn("p", p).join(seen, "key", "left_semi").select("key", "p")


class Model:
    """Log-likelihood differences by gram, and differences of backoff weights by context."""

    def __init__(self, seen: dict[int, tuple[np.ndarray, np.ndarray]], base: tuple[np.ndarray, np.ndarray]):
        """seen: by order the sorted keys and their toxic and ordinary counts, of ORDER all and of lower ones those at a word's start.

        base: sorted keys of SHARED bytes and their probabilities.
        """
        none = np.zeros(0, np.uint64), np.zeros((0, 2))
        counts = {ORDER: seen.get(ORDER, none)}
        for n in range(ORDER - 1, SHARED, -1):
            key, c = counts[n + 1]
            tail, place = np.unique(key & np.uint64((1 << 8 * n) - 1), return_inverse=True)
            before = np.stack([np.bincount(place, c[:, i] > 0, len(tail)) for i in range(2)], axis=1)
            first, often = seen.get(n, none)
            key, c = np.concatenate([tail, first]), np.concatenate([before, often])
            order = np.argsort(key)
            counts[n] = key[order], c[order]

        self.gram: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.back: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lower: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(SHARED + 1, ORDER + 1):
            key, c = counts.pop(n)
            if not len(key):
                continue
            context, place = np.unique(key >> np.uint64(8), return_inverse=True)
            total = np.stack([np.bincount(place, c[:, i], len(context)) for i in range(2)], axis=1)
            kinds = np.stack([np.bincount(place, c[:, i] > 0, len(context)) for i in range(2)], axis=1)
            weight = (DISCOUNT * kinds + OWED) / (total + OWED)
            p = np.maximum(c - DISCOUNT, 0) / (total[place] + OWED) + weight[place] * self._below(key & np.uint64((1 << 8 * (n - 1)) - 1), n - 1, lower, base)
            lower = {n: (key, p), -n: (context, weight)}
            self.gram[n] = key, (np.log(p[:, 0]) - np.log(p[:, 1])).astype(np.float32)
            self.back[n] = context, (np.log(weight[:, 0]) - np.log(weight[:, 1])).astype(np.float32)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def _below(self, key: np.ndarray, n: int, lower: dict, base: tuple) -> np.ndarray:
        """Both classes' probabilities of grams of order n, each of which some class has seen."""
        keys, p = lower.get(n, base)
        at, _ = self._find(keys, key)
        return p[at] if n in lower else np.stack([p[at], p[at]], axis=1)

    def words(self, words: Words, first: np.ndarray) -> np.ndarray:
        """The difference of log-likelihoods of each chosen word."""
        text, at = letters(words, first)
        value = np.zeros(len(text))
        open_ = np.ones(len(text), bool)
        open_[at[:-1]] = False
        for n in range(ORDER, SHARED, -1):
            if n not in self.gram:
                continue
            key, whole = grams(text, at, n)
            todo = np.flatnonzero(open_ & whole)
            keys, ratio = self.gram[n]
            place, known = self._find(keys, key[todo])
            value[todo[known]] += ratio[place[known]]
            open_[todo[known]] = False
            rest = todo[~known]
            contexts, back = self.back[n]
            place, known = self._find(contexts, key[rest] >> np.uint64(8))
            value[rest[known]] += back[place[known]]
        return np.add.reduceat(value, at[:-1]) if len(first) else np.zeros(0)

    def features(self, part: pa.RecordBatch) -> np.ndarray:
        """Of each row: the mean over its words, the largest mean of a window, and of a pair of words, and what words have beyond NOTABLE over the root of their number."""
        words, first, kind = distinct_words(part)
        counts = words.counts
        out = np.zeros((len(counts), FEATURES))
        if not len(first):
            return out
        value = self.words(words, first)[kind]
        total = np.concatenate([[0], np.cumsum(value)])
        some = np.flatnonzero(counts)
        begin, end = words.bounds[:-1], words.bounds[1:]
        out[some, 0] = (total[end] - total[begin])[some] / counts[some]
        last = np.repeat(end, counts)
        for f, width in ((1, WINDOW), (2, 2)):
            right = np.minimum(np.arange(len(value)) + width, last)
            mean = (total[right] - total[:-1]) / width
            out[some, f] = np.maximum.reduceat(mean, begin[some])
        over = np.concatenate([[0], np.cumsum(np.maximum(value - NOTABLE, 0))])
        out[some, 3] = (over[end] - over[begin])[some] / np.sqrt(counts[some])
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression, the intercept first, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _shape(x: np.ndarray) -> np.ndarray:
    """Features for the logistic curve: large values of a window count by their logarithm."""
    return np.column_stack([np.clip(x[:, 0], -2, 2), np.log1p(np.maximum(x[:, 1], 0)), np.log1p(np.maximum(x[:, 2], 0)), np.log1p(10 * x[:, 3])])


class Scorer:
    """Scores of Arrow batches; holds the models as a broadcast, which is sent once."""

    def __init__(self, model: Broadcast | None, weights: np.ndarray | None, prior: float):
        self.model, self.weights, self.prior = model, weights, prior

    def score(self, part: pa.RecordBatch) -> np.ndarray:
        if self.model is None or self.weights is None:
            return np.full(part.num_rows, self.prior)
        x = _shape(self.model.value.features(part))
        return 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(x)), x]) @ self.weights, -30, 30)))


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit_models(texts: DataFrame, sampled: DataFrame) -> Model:
    """The models of texts(own_id, text) by sampled(own_id, toxic, part), those of part 0 aside.

    What comes to the driver is bounded by the sample: grams of its rows, and the shared
    probabilities of their endings. The grams of all documents stay where they are.
    """
    joined = texts.join(F.broadcast(sampled), "own_id", "left").select("text", F.when(F.col("part") > 0, F.col("toxic")).alias("toxic"))
    counted = cut(joined.mapInArrow(_count, COUNTED).groupBy("n", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    base = shared_base(counted).toArrow()
    key, p = base.column("key").to_numpy().view(np.uint64), base.column("p").to_numpy()
    order = np.argsort(key)
    ends = key[order], p[order]
    seen = {}
    for n in range(SHARED + 1, ORDER + 1):
        rows = counted.filter(F.col("n") == n).filter("toxic + ordinary > 0").select("key", "toxic", "ordinary").toArrow()
        key = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        seen[n] = key[order], np.stack([rows.column(c).to_numpy()[order] for c in ("toxic", "ordinary")], axis=1).astype(float)
    return Model(seen, ends)


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 4_000, keep_back: int = 5) -> Scorer:
    """A scorer from docs(doc_id, text) and labels(doc_id, toxic), held-out rows aside.

    most_rows: labelled rows of each class that are learned from at most. keep_back: one of so
    many of them fits the logistic curve instead of the models.
    """
    spark = docs.sparkSession
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).withColumn("hash", F.xxhash64("doc_id"))
    sample = None
    for c in (0, 1):
        some = known.filter(F.col("toxic") == c).orderBy("hash", "doc_id").limit(most_rows)
        sample = some if sample is None else sample.unionByName(some)
    chosen = sample.select("doc_id", "toxic", F.pmod("hash", F.lit(keep_back)).alias("part")).toPandas()
    prior = float(chosen.toxic.mean()) if len(chosen) else 0.0
    if chosen[chosen.part > 0].toxic.nunique() < 2:
        return Scorer(None, None, prior)
    # by way of Arrow; plain rows would start Python workers of another kind, which stay on the executors
    sampled = spark.createDataFrame(pa.table({"own_id": chosen.doc_id.to_numpy(), "toxic": chosen.toxic.to_numpy(), "part": chosen.part.to_numpy()}), "own_id long, toxic int, part long")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("own_id"), "text")
    shared = spark.sparkContext.broadcast(fit_models(texts, sampled))
    names = [f"f{i}" for i in range(FEATURES)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            x = shared.value.features(part)
            yield pa.RecordBatch.from_arrays([part.column("toxic"), *(pa.array(x[:, i]) for i in range(FEATURES))], names=["toxic", *names])

    # both parts are measured alike by rows the models haven't seen
    back = texts.join(F.broadcast(sampled.filter("part = 0")), "own_id").select("text", "toxic")
    rows = back.mapInArrow(measure, "toxic int, " + ", ".join(f"{x} double" for x in names)).toPandas().sort_values(["toxic", *names])
    pa.default_memory_pool().release_unused()
    if rows.toxic.nunique() < 2:
        return Scorer(None, None, prior)
    return Scorer(shared, logistic(_shape(rows[names].to_numpy()), rows.toxic.to_numpy(float)), prior)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """docs as doc_id, held_out, score, predicted; one row for each row."""
    scorer = train(docs, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            s = scorer.score(part)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def remove(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """docs without those that score the threshold or more."""
    scorer = train(docs, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            yield part.filter(pa.array(scorer.score(part) < threshold))

    return docs.mapInArrow(run, docs.schema)
