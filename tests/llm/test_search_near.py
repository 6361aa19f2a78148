"""Ranked lexical search and near copies among vectors, against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spanforge.llm import near_vectors, search
from spanforge.llm.words import ALNUM, Texts, Words

DOC = "doc_id long, text string, item_id string, term int, score string, part int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_search(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total, df = len(bags), sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    asked, out = {}, set()
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(terms(text))
    for item, query in asked.items():
        scored = []
        for doc, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, q in query.items() if t in bag)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out |= {(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out


@pytest.fixture(scope="module")
def library():
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(60)] + ["ÀB", "Été", "x9", "日本"])
    share = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(1, 40), p=share / share.sum())) for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, "w1 W2"), (None, "w3 w3"), (None, "w3 w3"), (400, None), (401, ""), (402, "-- !"), *((500 + i, "w40 w41") for i in range(30))]
    items = [(1, "w1 w2 w3 w1"), (2, "w40, w41"), (3, None), (4, "absent words"), (5, "ÀB été X9 日本 w50"), (6, "w5"), (6, "w5"), (6, "w9 w5"), (None, "w3")]
    return docs, items


@pytest.mark.parametrize("k", [1, 20])
def test_search_is_brute_force(spark, library, k, monkeypatch):
    docs, items = library
    frame = spark.createDataFrame([(i, t, "x", 1, "s", 0) for i, t in docs], DOC).repartition(3)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    want = plain_search(docs, items, k)
    assert {tuple(r) for r in search.search(frame, bench, k).collect()} == want
    # more than one block of items
    assert {tuple(r) for r in search.search(frame, bench, k, block_terms=5).collect()} == want
    assert search.search(frame.limit(0), bench, k).count() == 0
    assert search.search(frame, bench.limit(0), k).count() == 0


def test_shards_and_ranges_give_the_same(library, monkeypatch):
    """Non-essential lists are probed over many small ranges, with the bar carried from shard to shard."""
    docs, items = library
    monkeypatch.setattr(search, "RANGE", 8)
    docs = [d for d in docs if d[0] is not None]
    vocabulary = np.unique(Words(Texts(pa.array([t for _, t in items])), ALNUM).hashes())
    n, row, term, tf = search.count_terms(pa.array([t for _, t in docs]), vocabulary)
    m = search.lengths(n, int((n > 0).sum()), int(n.sum()))
    df = np.bincount(term, minlength=len(vocabulary))
    weights = np.array([search.weight(int(x), int((n > 0).sum())) if x else 0 for x in df])
    query = np.searchsorted(vocabulary, np.unique(Words(Texts(pa.array([items[0][1] + " w40 w50"])), ALNUM).hashes()))
    top, whole = search.Top(5), search.Top(5)
    ids, nulls = np.array([d for d, _ in docs]), np.zeros(len(docs), bool)
    for low in range(0, len(docs), 50):
        own = (row >= low) & (row < low + 50)
        search.Shard(row[own] - low, term[own], tf[own], m[low : low + 50], len(vocabulary)).search(query, weights[query], top.among(ids[low : low + 50], nulls[low : low + 50]))
    full = search.Shard(row, term, tf, m, len(vocabulary))
    score = np.zeros(len(docs), np.int64)
    for t in query:
        a, b = full.bounds[t], full.bounds[t + 1]
        score[full.doc[a:b]] += weights[t] * full.impact[a:b]
    whole.among(ids, nulls).add(score, np.arange(len(docs)))
    assert top.score.tolist() == whole.score.tolist() and top.id.tolist() == whole.id.tolist()


def test_long_texts_are_counted_in_segments(monkeypatch):
    text = "aa bb " * 500 + "c" * 700 + " é" * 300 + " " + "日" * 400 + " aa"
    vocabulary = np.unique(Words(Texts(pa.array(["aa bb é " + "c" * 700 + " " + "日" * 400])), ALNUM).hashes())
    whole = search.count_terms(pa.array([text]), vocabulary)
    for size in (7, 64, 1000):
        monkeypatch.setattr(search, "SEGMENT", size)
        got = search.count_terms(pa.array([text]), vocabulary)
        assert all(np.array_equal(a, b) for a, b in zip(got, whole, strict=True))
    assert whole[0].tolist() == [1303] and len(whole[1]) == 5


VEC = "vec_id long, embedding array<float>, label int, node long, key string"


def plain_links(rows, cosine):
    """Links and components of rows (vec_id, vector, label) by comparing all of a label."""
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    low = np.array(ids)
    while True:
        new = np.minimum(low, np.where(linked, low[None, :], low.max()).min(1))
        if (new == low).all():
            return linked.sum(1), low
        low = new


def test_near_copies_are_brute_force(spark):
    """Lone pairs at the threshold, a dense group beyond the window, exact and scaled copies."""
    rng = np.random.default_rng(5)
    rows = [(i, v, int(i % 3)) for i, v in enumerate(rng.standard_normal((1500, 24)))]
    for i in range(150):
        v = rows[i][1] / np.linalg.norm(rows[i][1])
        u = rng.standard_normal(24)
        u -= v * (u @ v)
        c = rng.uniform(0.932, 0.96)
        rows.append((2000 + i, c * v + math.sqrt(1 - c * c) * u / np.linalg.norm(u), rows[i][2]))
    centre = rng.standard_normal(24)
    rows += [(3000 + i, centre + 0.1 * rng.standard_normal(24), 1) for i in range(400)]
    rows += [(4000 + i, rows[9][1] * (1 + i % 3), 0) for i in range(60)]
    frame = spark.createDataFrame([(i, [float(x) for x in v], k, 0, "x") for i, v, k in rows], VEC).repartition(5)
    n, low = plain_links(rows, 0.93)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_copies(frame).collect()}
    assert len(got) == len(rows)
    want = {r[0]: (int(a), int(b), r[0] == int(b)) for r, a, b in zip(rows, n, low, strict=True)}
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(g[0] for g in got.values()) >= 0.98 * int(n.sum())
    # dense groups are whole
    assert all(got[i] == want[i] for i in range(3000, 3400)) and all(got[i] == want[i] for i in range(4000, 4060))
    lone = [i for i in range(2000, 2150) if want[i][0]]
    assert sum(got[i][1] == want[i][1] for i in lone) >= 0.95 * len(lone)


def test_near_copies_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, [0.0, 0.0], 1), (7, None, 1), (8, [1.0, None], 1),
            (9, [float("nan"), 1.0], 1), (10, [float("inf"), 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [], 1), (13, [-0.0, 1.0], 1), (14, [0.0, 1.0], 1), (15, [1e-30, 0.0], 1)]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], VEC)
    got = sorted((tuple(r) for r in near_vectors.near_copies(frame).collect()), key=str)
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)]
    linked = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 4, 1, False), (15, 4, 1, False), (13, 1, 13, True), (14, 1, 13, False), (None, 0, None, True)]
    assert got == sorted([*alone, *linked], key=str)
    assert near_vectors.near_copies(frame.limit(0)).count() == 0


def test_a_seam_between_ranges_is_compared(spark, monkeypatch):
    """Ranges of a few rows each, so that nearly all pairs lie across one of their ends."""
    monkeypatch.setattr(near_vectors, "RANGE", 20)
    rng = np.random.default_rng(9)
    base = rng.standard_normal((60, 16))
    rows = [(i, base[i % 60] + 0.01 * rng.standard_normal(16), 0) for i in range(120)]
    frame = spark.createDataFrame([(i, [float(x) for x in v], k, 0, "x") for i, v, k in rows], VEC)
    n, low = plain_links(rows, 0.93)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_copies(frame, window=8).collect()}
    assert got == {r[0]: (int(a), int(b)) for r, a, b in zip(rows, n, low, strict=True)}
