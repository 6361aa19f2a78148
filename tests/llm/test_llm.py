"""Operators of the training-data package on small rows, against plain versions."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanforge.llm import ann, chat, decontaminate, licenses, mixing, ngram_join, queries, spread, substrings, tokens, toxicity, warc

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "en", None, 0), (2, "", "en", "b", 0), (3, "one", "en", "a", 3), (3, "one", "en", "a", 3), (3, "other", "en", "a", 5), (None, "lost words", None, "c", 10), (4, "w " * 40_000, "en", "b", 80_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, i, "x") for i, r in enumerate(ODD)], DOC + ", size long, node string")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rel = con.sql(queries.ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_odd_rows_and_empty_tables(spark, odd):
    bench = spark.createDataFrame([(1, "one"), (2, None), (None, "lost words")], "item_id long, text string")
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        assert mixing.mix(docs).count() == n
        assert tokens.count_tokens(docs).count() == n
        assert licenses.scan(docs).count() == n
        assert decontaminate.scan(docs, bench).count() == n
        assert toxicity.score(docs, labels).count() == n
        assert ngram_join.jaccard_components(docs).count() == n
        assert substrings.find_repeats(docs).count() <= n
        assert substrings.remove(docs, substrings.find_repeats(docs)).columns == docs.columns
        assert set(docs.columns) <= set(mixing.repetitions(docs, mixing.mix(docs)).columns)
    assert decontaminate.scan(odd, bench.limit(0)).filter("contaminated").count() == 0


def test_mix_meets_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 40 + 1), "en", "abc"[i % 3], 0) for i in range(300)], DOC)
    rows = mixing.mix(docs).withColumn("source", F.expr("substr('abc', CAST(doc_id % 3 AS INT) + 1, 1)"))
    got = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.expr("taken - 2 * size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= 1 and r.over <= 0 for r in got)
    made = mixing.repetitions(docs, mixing.mix(docs))
    assert made.select(F.sum(mixing.count_words(F.col("text")))).head()[0] == sum(r.taken for r in got)


def test_repetitions_sum_to_the_mix_with_shared_ids(spark):
    """Rows of one doc_id and size, alike or not, with and without an id, under names the operator uses itself."""
    rows = [(5, f"w{i % 7}", "en", "a", 0) for i in range(101)] + [(6, "one two three", "en", "a", 0), (None, "lost", "en", "a", 0), (None, "lost", "en", "a", 0), (7, None, "en", "b", 0), (7, "", "en", "b", 0), (8, "x y", "en", "b", 0)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], DOC + ", copy int, __key string").repartition(3)
    mixed = mixing.mix(docs)
    source = F.when(F.col("doc_id").isin(7, 8), "b").otherwise("a").alias("source")
    want = {r.source: r.taken for r in mixed.groupBy(source).agg(F.sum("taken").alias("taken")).collect()}
    made = mixing.repetitions(docs, mixed)
    assert made.columns == [*docs.columns, "__copy"]
    got = {r.source: r.taken for r in made.groupBy("source").agg(F.sum(mixing.count_words(F.col("text"))).alias("taken")).collect()}
    assert got == {k: v for k, v in want.items() if v} and sum(got.values()) > 100
    # no text more than twice its rows
    many = {r.text: r.n for r in made.groupBy("text").agg(F.count("*").alias("n")).collect()}
    assert all(many[f"w{i}"] <= 2 * sum(r[1] == f"w{i}" for r in rows) for i in range(7) if f"w{i}" in many)


def test_texts_of_one_id_lose_their_own_spans(spark):
    """Sixty texts of one doc_id with a passage each that an earlier document holds at another place."""
    word = lambda i: "w" + hashlib.md5(str(i).encode()).hexdigest()[:6]
    passage = lambda i: " ".join(word(f"{i}p{j}") for j in range(60))
    rows = [(1, " ".join(passage(i) for i in range(60)))] + [(2, " ".join(word(f"{i}x{j}") for j in range(10 + i)) + " " + passage(i)) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, __doc string, __cut int")
    found = substrings.find_repeats(docs)
    assert found.count() == 60 and found.select("tag").distinct().count() == 60
    left = substrings.remove(docs, found)
    assert left.columns == docs.columns
    texts = sorted(r.text.strip() for r in left.filter("doc_id = 2").collect())
    kept = sorted(" ".join(word(f"{i}x{j}") for j in range(10 + i)) for i in range(60))
    # a chunk across the edge may leave a few words of a passage
    assert sum(len(a.split()) for a in texts) <= sum(len(b.split()) for b in kept) + 60 * 16
    assert all(any(t.startswith(k) for t in texts) for k in kept)


def test_decontaminate_blocks_agree(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, "x " + " ".join(words[:20]) + " y"), (2, " ".join(words[5:16])), (3, "Short ITEM here"), (4, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words)), (8, "short item"), (9, " ".join(words[3:30]))], "item_id long, text string")
    for size in (10_000, 200):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in decontaminate.scan(docs, bench, block_bytes=size).collect()}
        assert got == {1: (22, 20, 2, ["7", "9"], True), 2: (11, 0, 0, [], False), 3: (3, 2, 1, ["8"], True), 4: (1, 0, 0, [], False)}
        assert sorted(r.doc_id for r in decontaminate.remove(docs, bench, block_bytes=size).collect()) == [2, 4]


def plain_scan(text, items, window=13):
    """covered places, items, and the length of the longest match that holds a window, by comparing everything."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t or "")
    words, hit, found, longest = cut(text), set(), set(), 0
    for name, item in items:
        own = cut(item)
        need = min(window, len(own))
        for i in range(len(words)):
            for j in range(len(own)):
                n = 0
                while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                    n += 1
                if need and n >= need:
                    hit |= set(range(i, i + n))
                    found.add(str(name))
                    longest = max(longest, n)
    return len(words), len(hit), sorted(found), longest


@pytest.mark.parametrize("block_bytes", [100_000, 400, 60])
def test_decontaminate_against_brute_force(spark, block_bytes):
    rng = np.random.default_rng(8)
    draw = lambda n, kinds: [str(x) for x in rng.choice([f"w{i}" for i in range(kinds)], n)]
    side = [draw(13, 500), draw(13, 500)]
    items = [(0, " ".join(side[0])), (1, " ".join(side[1])), (2, "same " * 40), (3, " ".join(draw(30, 3))), (4, "one two"), (5, ""), (6, None), (7, " ".join(draw(20, 60))), (7, "two"), (8, "same " * 14)]
    texts = [" ".join(side[0] + side[1]), "same " * 60, "", None, "one two three", items[7][1] + " tail"]
    for _ in range(30):
        own = draw(25, 3)
        for _, t in (items[i] for i in rng.integers(0, len(items), 2)):
            words = (t or "").split()
            a = int(rng.integers(0, max(1, len(words))))
            own[5:5] = words[a : a + int(rng.integers(1, 30))]
        texts.append(" ".join(own))
    docs = spark.createDataFrame([(i // 2 if i % 5 else None, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, __found string, row int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.scan(docs, bench, block_bytes=block_bytes).select("n_words", "n_hit", "items", "longest").collect()
    want = [plain_scan(t, items) for t in texts]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    kept = decontaminate.remove(docs, bench, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    # rows, not ids, are kept or dropped
    assert sorted(r.row for r in kept.collect()) == [i for i, (n, hit, *_) in enumerate(want) if not (hit and 20 * hit >= n)]


def test_decontaminate_gives_places(spark):
    docs = spark.createDataFrame([(1, "a b c d e f x c d e f g")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "z c d e f g"), (6, "b c d")], "item_id long, text string")
    row = decontaminate.scan(docs, bench, window=3).head()
    assert [tuple(m) for m in row.matches] == [(1, 3, "6", 0), (2, 4, "5", 1), (7, 5, "5", 1)] and row.longest == 5


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(0, 3, 300), np.zeros(40, np.int64)])
    order = decontaminate.suffix_array(text, 16)
    keys = [tuple(np.where(np.cumsum(text[i : i + 16] == 0) > 0, 0, text[i : i + 16])) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(np.flatnonzero(text))


def brute_components(texts, k, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    part = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if a < b and part[a] != part[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[a]:
                    low = min(part[a], part[b])
                    part = {i: low if p in (part[a], part[b]) else p for i, p in part.items()}
                    changed = True
    return {i: (len(sets[i]), part[i]) for i in texts}


@pytest.mark.parametrize(("short", "bits", "k", "percent"), [(2, 27, 4, 85), (48, 6, 4, 85), (2, 9, 5, 80)])
def test_jaccard_components(spark, monkeypatch, short, bits, k, percent):
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "FILTER_BITS", bits)
    monkeypatch.setattr(ngram_join, "TASK_PAIRS", short)
    monkeypatch.setattr(spread, "FEW", short)
    rng = np.random.default_rng(3)
    base = [f"v{i}" for i in rng.integers(0, 500, 120)]
    texts = {0: None, 1: "", 2: "a b", 3: "A  B"}
    for i in range(4, 40):
        w = list(base) if i % 2 else [f"u{x}" for x in rng.integers(0, 900, 90)]
        for j in rng.integers(0, len(w), rng.integers(0, 6)):
            w[j] = f"e{i}_{j}"
        texts[i] = " ".join(w)
    texts[40] = texts[5]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, k, percent).collect()} == brute_components(texts, k, percent)


def test_keep_one_decides_by_row(spark):
    same, other = "one two three four five six seven", "quite another text that links with nothing else here"
    rows = [(1, same, "a"), (1, same, "b"), (2, same, "c"), (2, other, "d"), (None, same, "e"), (None, "null ids alone in a group", "f"), (None, "null ids alone in a group", "g"), (5, "", "h"), (5, None, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = ngram_join.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    got = sorted(r.node for r in kept.collect())
    assert got[0] in "ab" and got[1] == "d" and got[2] in "fg" and got[3:] == ["h", "i"]


def test_substrings_found_after_insertions(spark):
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 10**6, 55))
    rows = [(i, " ".join(f"d{x}" for x in rng.integers(0, 10**6, 40 + i)) + " " + passage + " " + " ".join(f"d{x}" for x in rng.integers(0, 10**6, 30))) for i in range(8)]
    rows += [(100 + i, " ".join(f"d{x}" for x in rng.integers(0, 10**6, 200))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substrings.find_repeats(docs).collect()}
    assert set(found) == set(range(1, 8)) and all(r.kept_doc_ids == [0] and 20 <= r.removed_words <= 55 for r in found.values())
    cut = {r.doc_id: r.text for r in substrings.remove(docs, substrings.find_repeats(docs)).collect()}
    assert all(cut[i] == t for i, t in rows if i not in found)
    assert all(passage not in cut[i] for i in found)


def plain_repeats(rows, rate=1 / 3, min_words=20, min_support=15):
    """find_repeats by the letter, on ASCII texts without periodic passages: spans and keepers of each (doc_id, text)."""

    def chunked(text):
        data, words = text.encode(), list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        gear = [int(substrings.BYTE[b]) >> 13 & 0xFFFF for b in data]
        hit = []
        for w in words:
            end = max(w.start() - 1, 0)
            value = sum(gear[end - j] << j for j in range(substrings.WINDOW) if end >= j) & 0xFFFF
            hit.append(value < int(rate * 65536) and w.start() >= substrings.WINDOW)
        first = [i for i in range(len(words)) if i == 0 or (hit[i] and not hit[i - 1] and not (i > 1 and hit[i - 2]))]
        out = []
        for s, e in zip(first, [*first[1:], len(words)]):
            out += [(i, tuple(w.group() for w in words[i : min(i + substrings.LONGEST, e)])) for i in range(s, e, substrings.LONGEST)]
        return out

    every = [(doc, text, chunked(text or "")) for doc, text in rows if doc is not None]
    kept = {}
    for doc, _, parts in every:
        for _, words in parts:
            kept[words] = min(doc, kept.get(words, doc))
    out = []
    for doc, _, parts in every:
        seen, runs = set(), []
        for at, words in parts:
            if kept[words] < doc or words in seen:
                if runs and runs[-1][-1][0] + len(runs[-1][-1][1]) == at:
                    runs[-1].append((at, words))
                else:
                    runs.append([(at, words)])
            seen.add(words)
        spans, keepers = [], set()
        for run in runs:
            by = {}
            for _, words in run:
                by[kept[words]] = by.get(kept[words], 0) + len(words)
            if sum(by.values()) >= min_words and max(by.values()) >= min_support:
                spans.append((run[0][0], run[-1][0] + len(run[-1][1])))
                keepers.add(max(by, key=by.get))
        if spans:
            out.append((doc, sum(e - s for s, e in spans), spans, sorted(keepers)))
    return sorted(out)


def test_substrings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spread, "FEW", 3)
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passages = [word(n) for n in (8, 25, 55, 90, 300)]
    rows = [(0, None), (1, ""), (2, "one"), (None, " ".join(passages[2]))]
    for i in range(3, 60):
        parts = [word(rng.integers(0, 60))]
        for j in rng.integers(0, len(passages), rng.integers(0, 4)):
            parts += [passages[j], word(rng.integers(0, 30))]
        rows.append((i, ("  " if i % 3 else "\n").join(w for part in parts for w in part)))
    rows += [(70, "the " + " ".join(passages[4])), (71, rows[10][1])]
    got = substrings.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    plain = plain_repeats(rows)
    assert len(plain) > 20
    assert sorted((r.doc_id, r.removed_words, [(s.start, s.end) for s in r.spans], r.kept_doc_ids) for r in got) == plain


def test_substrings_found_in_periodic_passages(spark):
    rng = np.random.default_rng(6)
    other = lambda n: " ".join(f"d{x}" for x in rng.integers(0, 10**6, n))
    rows = []
    for i in range(60):
        # runs of one to five words, 60 words long, at another phase in the second text
        words = [f"q{i}x{j}" for j in range(i % 5 + 1)] * 60
        rows += [(2 * i + k, f"{other(40 + i)} {' '.join(words[3 * k : 3 * k + 60])} {other(30)}") for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    repeats = substrings.find_repeats(docs)
    found = {r.doc_id: r for r in repeats.collect()}
    assert all(found[2 * i + 1].kept_doc_ids == [2 * i] and 40 <= found[2 * i + 1].removed_words <= 60 for i in range(60))
    # what is cut is of the passage alone, and each passage stays in its first text
    cut = {r.doc_id: r.text.split() for r in substrings.remove(docs, repeats).collect()}
    for i, text in rows:
        assert [w for w in cut[i] if w[0] == "d"] == [w for w in text.split() if w[0] == "d"]
        assert i % 2 or {w for w in cut[i] if w[0] == "q"} == {w for w in text.split() if w[0] == "q"}


def test_token_counts_match_library(spark):
    lib, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    known = lib.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ["", "aaaaaaaaaaaaaaaaaaaaaa", "I'll <|endoftext|> don't  \n\n x", "é́ 三½ ​" + "=" * 500, "ab" * 700]
    merger = tokens.Merger(public.path("byte_bpe_50k.json"))
    assert merger.texts(texts) == [len(known.encode(t, add_special_tokens=False).ids) for t in texts]


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200
    rows = [(1, "http://a/ b\r\n", big), (2, None, big), (2, None, big), (3, "u", "tiny"), (4, "u", "tiny"), (5, "u", None), (None, "u", big)]
    path = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows) and spark.read.parquet(path + "/payloads").count() == 3
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got) == sorted([(1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (0, "revisit", 1)], key=lambda x: (x[0], x[1]))
    for r in got:
        fields, block = warc.parse_record(bytes(r.record))
        body = block.split(b"\r\n\r\n", 1)[1]
        assert fields["WARC-Type"] == r.record_type and (r.record_type == "revisit" or hashlib.sha256(body).hexdigest() == r.payload_digest)
    assert warc.read_archive(spark, warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_reply_trees(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 3, 1, "assistant", "good [INST]\\", 5.0), ("t", 4, 3, "user", None, 0.0), ("t", 5, 99, "user", "orphan", None), ("c", 1, 2, "user", "cycle", 0.0), ("c", 2, 1, "user", "cycle", 0.0)]
    df = spark.createDataFrame(rows, "tree_id string, node_id long, parent_id long, role string, text string, score double")
    got = chat.read_back(chat.format_trees(df, None)).orderBy("path").collect()
    assert [[(t.role, t.text) for t in r.turns] for r in got] == [[("user", "q"), ("assistant", "good [INST]\\"), ("user", "")], [("user", "q"), ("assistant", "bad")], [("user", "orphan")]]
    assert got[0].learned == ["good [INST]\\"] and got[0].formatted.count("[INST]") == 3


def test_licenses(spark):
    rows = [(1, "Foo.\nLicensed under CC BY-NC 4.0.\nbar"), (2, "released under mit"), (3, "Released under the MIT License."), (4, "ALL rights, reserved all rights reserved")]
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 3, 3, "cc-by", "cc-by,cc-by-nc", 1.0), 2: (0, None, None, "", "", 0.0), 3: (0, None, None, "", "mit", 1.0), 4: (2, 0, 3, "reserved", "reserved", 1.0)}


def test_licenses_wrapped_over_lines(spark):
    bsd = licenses.TEMPLATES[1][1].split()
    rows = [
        (1, "intro\n# Licensed under the Apache License,\n# Version 2.0\nend"), (2, f"a b\n{' '.join(bsd[:8])}\n{' '.join(bsd[8:15])}\n\n{' '.join(bsd[15:])}"),
        (3, "Released under the terms\nof the MIT license"), (4, "released\nunder\nthe\n" + "other " * 20 + "\nmit\nlicense"), (5, "released under mit\nlicense"),
        (6, "Licensed under the Apache License,\n" + "x " * 5 + "Version 2.0"), (7, "the " * 5000 + "\nlicensed under the gnu lesser\ngeneral public license"),
        # one line, the words scattered, and a long line with a notice in it
        (8, f"released {'x ' * 3000} under {'x ' * 3000} the mit {'x ' * 3000} license"), (9, f"{'x ' * 3000} released under the MIT license {'x ' * 3000}"),
        (10, "released a b c under the d e MIT license"), (11, "released a b c under the d e f MIT license"),
    ]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("apache", 1.0), 2: ("bsd", 1.0), 3: ("mit", 1.0), 4: ("", 0.0), 5: ("", 0.0), 6: ("apache", 1.0), 7: ("gpl,lgpl", 1.0), 8: ("", 0.0), 9: ("mit", 1.0), 10: ("mit", 1.0), 11: ("", 0.0)}


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[700:720] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [1.0])]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 100))
    found = 0
    for q, rows_ in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        best = [int(i) for i in np.lexsort((np.arange(1500), d)) if i != q][:10]
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 11)) and all(math.isclose(d[v], s, abs_tol=1e-12) for _, v, s in rows_)
        found += len({v for _, v, _ in rows_} & set(best))
    assert found >= 0.9 * 10 * len(got)
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id) for r in ann.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_neighbours_of_clustered_vectors_need_few_candidates(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 32))[rng.integers(0, 400, 20_000)] + 0.15 * rng.standard_normal((20_000, 32))
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(len(x))), "embedding": pa.array(list(x), pa.list_(pa.float64()))}))
    got = {}
    for r in ann.nearest(df, every=400).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = np.arange(0, len(x), 400)
    d = np.sqrt(((x[asked][:, None] - x[None]) ** 2).sum(2))
    best = np.argsort(np.where(np.arange(len(x))[None] == asked[:, None], np.inf, d), axis=1)[:, :10]
    assert np.mean([len(got[q] & set(b)) / 10 for q, b in zip(asked, best, strict=True)]) >= 0.9
    index = df.select(F.col("vec_id").alias("node"), "embedding")
    hashing = ann.fitted(index, len(x), 10, 8, 2048)
    own, seen = hashing.own(x), hashing.visited(x[asked])
    assert np.mean([np.any([np.isin(own[:, t], v[t]) for t in range(8)], axis=0).mean() for v in seen]) < 0.05


def test_neighbours_in_blocks_of_queries_and_the_exact_way(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal((300, 8)), 50 + 30 * rng.standard_normal((12, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    monkeypatch.setattr(ann, "ASKED", 16)
    monkeypatch.setattr(ann, "BLOCK", 40)
    # cells so narrow that they hold the queries alone
    monkeypatch.setattr(ann, "fitted", lambda index, n, k, tables, sample: ann.Hashing(8, tables, 8, 1e-3, 1))
    got = {}
    for r in ann.nearest(df, every=1).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = {i: [int(j) for j in np.lexsort((np.arange(len(x)), row)) if j != i][:10] for i, row in enumerate(d)}
    assert {q: [v for _, v in sorted(rows)] for q, rows in got.items()} == want


def plain_kneser_ney(words, order, shared, discount, owed, rows):
    """Log-likelihood difference of each word in ``words`` by dictionaries of counts; rows: (words, label or None)."""
    from collections import defaultdict

    mark = lambda w: bytes([1]) + w.encode() + bytes([2])
    every = {mark(w) for ws, _ in rows for w in ws}
    raw = [defaultdict(int), defaultdict(int)]
    for ws, label in rows:
        for w in ws:
            if label in (0, 1):
                t = mark(w)
                for n in range(shared + 1, order + 1):
                    for i in range(len(t) - n + 1):
                        raw[1 - label][t[i : i + n]] += 1

    def count(c, g):
        if len(g) == order or g[0] == 1:
            return raw[c][g]
        return sum(raw[c][bytes([b]) + g] > 0 for b in range(1, 256))

    fours = {t[i : i + shared + 1] for t in every for i in range(len(t) - shared)}
    before = defaultdict(int)
    for g in fours:
        before[g[1:]] += 1

    def base(g):
        follow = [v for k, v in before.items() if k[:-1] == g[:-1]]
        return max(before[g] - discount, 0) / sum(follow) + discount * len(follow) / sum(follow) / 256

    seen = lambda g: any(count(c, g) for c in (0, 1))

    def p(c, g):
        if len(g) == shared:
            return base(g)
        follow = [count(c, g[:-1] + bytes([b])) for b in range(1, 256)]
        total, kinds = sum(follow), sum(f > 0 for f in follow)
        return max(count(c, g) - discount, 0) / (total + owed) + (discount * kinds + owed) / (total + owed) * p(c, g[1:])

    def ratio(g):
        """The difference at the longest seen gram, and of backoff weights above it."""
        if len(g) == shared:
            return 0.0
        if seen(g):
            return math.log(p(0, g)) - math.log(p(1, g))
        weight = []
        for c in (0, 1):
            follow = [count(c, g[:-1] + bytes([b])) for b in range(1, 256)]
            weight.append((discount * sum(f > 0 for f in follow) + owed) / (sum(follow) + owed))
        return math.log(weight[0]) - math.log(weight[1]) + ratio(g[1:])

    out = []
    for w in words:
        t = mark(w)
        out.append(sum(ratio(t[max(0, i + 1 - order) : i + 1]) for i in range(shared, len(t))))
    return out


def test_toxicity_models_against_dictionaries(spark):
    rng = np.random.default_rng(4)
    kinds = ["ab", "abc", "banana", "bandana", "cabana", "abracadabra", "cab", "bac", "q", "nabab"]
    rows = [([str(w) for w in rng.choice(kinds, 6)], (1, 0, None)[i % 3]) for i in range(24)]
    texts = spark.createDataFrame([(i, " ".join(ws)) for i, (ws, _) in enumerate(rows)], "own_id long, text string")
    sampled = spark.createDataFrame([(i, label, 1) for i, (_, label) in enumerate(rows) if label is not None], "own_id long, toxic int, part long")
    model = toxicity.fit_models(texts, sampled)
    asked = [*kinds, "banabra", "xyzzy", "bananabandana"]
    words, first, kind = toxicity.distinct_words(pa.RecordBatch.from_arrays([pa.array([" ".join(asked)])], names=["text"]))
    got = model.words(words, first)[kind]
    want = plain_kneser_ney(asked, toxicity.ORDER, toxicity.SHARED, toxicity.DISCOUNT, toxicity.OWED, rows)
    assert np.allclose(got, want, atol=1e-4)


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(2)
    plain, bad = [f"{a}{b}" for a in ("ka", "lo", "mi", "re", "su") for b in ("ta", "ne", "li", "po")], ["grobnik", "grobnax", "vlurth"]
    rows, labels = [], []
    for i in range(900):
        w = list(rng.choice(plain, 60))
        if toxic := i % 4 == 0:
            for j in rng.integers(0, 60, 3):
                w[j] = str(rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95


def test_toxicity_scores_long_words_whole(spark):
    rng = np.random.default_rng(7)
    plain, bad = [f"{a}{b}" for a in "山川日月火" for b in "水木金土"], ["毒虫獣", "毒獣悪", "悪虫毒"]
    rows, labels = [], []
    for i in range(900):
        # one word of over 300 bytes; what tells is beyond its first 100
        w = list(rng.choice(plain, 60))
        if toxic := i % 4 == 0:
            for j in rng.integers(20, 60, 3):
                w[j] = str(rng.choice(bad))
        rows.append((i, "".join(w)))
        labels.append((i, int(toxic)))
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in got if r.held_out]) > 0.95


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns and 0 < after.count() <= before.count(), name
        before = after
    assert before.count() == before.select("doc_id").distinct().count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert mixed.count() > 0 and "copy" in mixed.columns


def plain_pipeline(rows, toxic, bench):
    """(doc_id, source, text) after each of the first four stages, by comparing everything; toxic: ids that the models reject."""
    kept = [r for r in rows if r[0] not in toxic]
    stages = [kept]
    linked = brute_components({i: t for i, _, t in kept}, 5, 80)
    kept = [r for r in kept if linked[r[0]][0] == 0 or linked[r[0]][1] == r[0]]
    stages.append(kept)
    spans = {doc: found for doc, _, found, _ in plain_repeats([(i, t) for i, _, t in kept])}
    cut = []
    for i, source, text in kept:
        at = [w.start() for w in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
        left, out = 0, ""
        for a, b in spans.get(i, []):
            out, left = out + text[left : at[a]], at[b]
        cut.append((i, source, out + text[left:]))
    stages.append(cut)
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    scans = {i: plain_scan(lower(t), [(n, lower(b)) for n, b in bench]) for i, _, t in cut}
    stages.append([r for r in cut if not (scans[r[0]][1] > 0 and 20 * scans[r[0]][1] >= scans[r[0]][0])])
    return stages


def test_pipeline_is_the_plain_one(spark, tmp_path):
    """300 documents with toxic ones, near copies, passages that repeat and benchmark items, stage by stage and as a whole."""
    rng = np.random.default_rng(17)
    words = [f"w{hashlib.md5(str(i).encode()).hexdigest()[:5]}" for i in range(3000)]
    make = lambda n: list(rng.choice(words, n))
    passages, bench = [make(70) for _ in range(4)], [(n, " ".join(make(30))) for n in range(5)]
    texts = {}
    for i in range(300):
        text = make(int(rng.integers(30, 90)))
        if i % 5 == 1:
            text = list(texts[i - 1])
            text[int(rng.integers(0, len(text)))] = "changed"
        elif i % 5 == 2:
            text += passages[i % 4] + make(25)
        elif i % 10 == 3:
            text += bench[i % 5][1].split()
        elif i % 10 == 9:
            text = [w if rng.random() < 0.4 else "vile" + str(rng.integers(0, 9)) for w in text]
        texts[i] = text
    rows = [(i, "abc"[i % 3], " ".join(t)) for i, t in texts.items()] + [(300, "a", ""), (301, "b", "few words")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, s, t in rows], DOC)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 9)) for i in range(300)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, labels).filter("predicted = 1").collect()}
    assert sum(i % 10 == 9 for i in toxic) >= 25 and sum(i % 10 != 9 for i in toxic) <= 5
    want, before = plain_pipeline(rows, toxic, bench), docs
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        before = stage(spark, before, str(tmp_path)).cache()
        assert sorted((r.doc_id, r.source, r.text) for r in before.collect()) == sorted(plain), name
        assert before.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    assert len({len(x) for x in want}) >= 3
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", want[-1])
    taken = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, taken FROM ({queries.OP3_SQL})").fetchall()}
    mixed = []
    for i, _, text in want[-1]:
        own = [m.group() for m in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)]
        for copy in range(1, -(-taken[i] // max(len(own), 1)) + 1):
            left = taken[i] - (copy - 1) * len(own)
            mixed.append((i, copy, text if left >= len(own) else "".join(own[:left])))
    assert sorted((r.doc_id, r["copy"], r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(mixed)


@pytest.mark.parametrize("counted", [False, True])
def test_spread_join_keeps_all_rows(spark, monkeypatch, counted):
    monkeypatch.setattr(spread, "FEW", 3)
    monkeypatch.setattr(spread, "HOT", 8)
    rows = [(7, i % 50) for i in range(200)] + [(i, i) for i in range(20)] + [(None, i) for i in range(60)] + [(99, 1)]
    values = [(i, f"v{i}") for i in range(20)] + [(None, "none")]
    left, right = spark.createDataFrame(rows, "k long, x long"), spark.createDataFrame(values, "k long, v string")
    lengths = right.join(left.groupBy("k").agg(F.count("*").alias("length")), "k")
    hot = spread.hot_keys(left, "k") if counted else spread.hot_keys(lengths, "k", "length")
    assert hot == {7: math.ceil(201 / (281 if counted else 220) * 8)}
    got = spread.spread_join(left, right, "k", hot)
    assert sorted(got.select("k", "x", "v").collect()) == sorted((k, x, f"v{k}") for k, x in rows if k is not None and k < 20)
    assert "__part" not in got.columns
