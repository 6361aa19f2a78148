"""What the n-gram join's plans do once, and by which way small rows come in."""

import numpy as np
import pytest

from spanforge.llm import ngram_join, spread, toxicity


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_made_and_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, "x y z")], "doc_id long, text string")
    tokens = docs.mapInArrow(ngram_join._low_tokens(2, 50, 1.0), "node long, token long")
    sizes = tokens.groupBy("node").count().selectExpr("node", "count AS n", "count AS posted").localCheckpoint()
    posts = ngram_join._prefixes(tokens, sizes, 50, 1.0)
    assert plan(posts).count("MapInArrow") == 1
    # of five pairs of words, the first two texts share four, of which two are in a prefix of three beside the one of its own
    rows = posts.collect()
    assert len({r.node for r in rows}) == 2 and {r.room for r in rows} == {2} and len({r.token for r in rows}) == 2


def test_one_row_a_set_whatever_copies_there_are(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (1, "a b c d"), (None, "e f g h"), (3, "p q r s")], "doc_id long, text string")
    rows = docs.mapInArrow(ngram_join._low_tokens(2, 50, 1.0), "node long, token long").join(docs.limit(0).selectExpr("doc_id AS token"), "token", "left_anti")
    nodes = rows.select("node").distinct()
    own = docs.selectExpr("doc_id", "text", "xxhash64(text) AS text_hash").mapInArrow(ngram_join._sizes(2, 50, 1.0), "doc_id long, text_hash long, n long, posted long, node long, " + ", ".join(f"{x} long" for x in ngram_join.BITS))
    sizes = own.groupBy("node").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "doc_id")
    sets, path = ngram_join._sets(docs, sizes, nodes, 2, 50)
    assert sorted(len(r.tokens) for r in sets.collect()) == [24, 24, 24]
    exists = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert exists.getFileSystem(spark._jsc.hadoopConfiguration()).exists(exists)


def test_hot_keys_need_no_python_worker(spark):
    rows = spark.range(20).selectExpr("id % 2 AS k", "id AS v")
    values = spark.range(2).selectExpr("id AS k", "id * 10 AS w")
    joined = spread.spread_join(rows, values, "k", {1: 3})
    assert "ExistingRDD" not in plan(joined)
    assert sorted((r.k, r.v, r.w) for r in joined.collect()) == [(k, v, 10 * k) for k in (0, 1) for v in range(k, 20, 2)]


def test_training_sample_needs_no_python_worker(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("rows by way of Python workers")

    docs = spark.range(60).selectExpr("id AS doc_id", "concat(IF(id % 2 = 0, 'vile awful ', 'kind gentle '), 'word ', id) AS text")
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 2 = 0 AS INT) AS toxic")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 60


def test_sets_with_tokens_of_their_own_are_not_posted_whole(spark, monkeypatch):
    rng = np.random.default_rng(5)
    draw = lambda n: [str(x) for x in rng.integers(0, 10**9, n)]
    common = draw(30)
    texts = [draw(75) + common for _ in range(150)]
    texts += [[*texts[0][:40], "other", *texts[0][41:]], [*texts[1], "more"], [*common, *draw(3)], [*common, *draw(3)]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    made, real = [], ngram_join._prefixes

    def counted(tokens, *more):
        made.append(tokens.count())
        return real(tokens, *more)

    monkeypatch.setattr(ngram_join, "_prefixes", counted)
    rows = ngram_join.jaccard_components(docs).collect()
    assert {r.doc_id: r.component_id for r in rows if r.component_id != r.doc_id} == {150: 0, 151: 1}
    # one long list of the common words: its sets once made all of their tokens again
    assert len(made) > 1 and sum(made[1:]) < 0.4 * sum(r.n_shingles for r in rows)


@pytest.mark.parametrize(("k", "percent", "region"), [(1, 80, None), (2, 60, None), (3, 85, 0.02), (1, 50, 1.5), (2, 100, None), (2, 80, 0.9)])
def test_no_link_is_lost_by_slices(spark, monkeypatch, k, percent, region):
    monkeypatch.setattr(ngram_join, "SHORT", 2)
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    rng = np.random.default_rng(percent)
    texts = []
    for i in range(150):
        w = [f"c{x}" for x in range(rng.integers(1, 14))] + [f"o{x}" for x in rng.integers(0, 400, rng.integers(0, 25))]
        if i % 3 == 0 and texts:
            w = list(texts[rng.integers(0, len(texts))])
            for j in rng.integers(0, len(w), rng.integers(0, 3)):
                w[j] = f"e{rng.integers(0, 60)}"
        texts.append(w)
    sets = [{tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} for w in texts]
    part = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = [low if x == high else x for x in part]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, k, percent, region).collect()}
    assert got == {i: (len(s), part[i]) for i, s in enumerate(sets)}
