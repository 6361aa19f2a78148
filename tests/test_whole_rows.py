"""Queries that read whole texts and all rows, against plain versions."""

import numpy as np
import pytest

from spanforge.operators import analysis, sequences
from spanforge.plans import registry, registry_more, registry_rules  # noqa: F401

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ALN = str.maketrans("abcdefghijklmnopqrstuvwxyz ", "acgtacgtaacgtacgtacgtacgan.")


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    made = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé A.\n"), n)) for n in (700, 650, 91, 500, 40, 640)]
    return [(i, t, ("en", "de", "fr", "es")[i % 4], "st"[i // 4], len(t)) for i, t in enumerate(made)]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(texts, DOC).write.parquet(f"{path}/documents.parquet")
    return path


def letters(text):
    """All letters in lower case, those beyond ASCII as z; spaces and what else there is as they are."""
    return "".join(c.lower() if c.isascii() else "z" for c in text)


def aligned(texts):
    rows = {}
    for i, text, _, source, _ in texts:
        rows.setdefault(source, []).append((i, "-" * (i % 4) + "".join(c for c in letters(text) if c == " " or "a" <= c <= "z").translate(ALN).upper().replace(".", "-")))
    return rows


def test_alignment_queries_read_whole_texts(spark, texts, folder):
    want, trims, lines = {}, {}, {}
    for source, rows in aligned(texts).items():
        match = []
        for col in range(max(len(s) for _, s in rows)):
            here = [s[col] for _, s in rows if col < len(s)]
            cover = sum(s.find(s.strip("-")[0]) <= col < len(s.rstrip("-")) for _, s in rows)
            bases = sum(c != "-" for c in here)
            want[source, col] = (*(here.count(x) for x in "ACGT"), bases, cover, round(bases / cover if cover else 0.0, 6))
            match.append(bool(cover) and bases / cover >= 0.5 and cover >= min(3, len(rows)))
        at = np.flatnonzero(match)
        trims[source], lines[source] = (int(at[0]), int(at[-1])), (len(at), len(match))
    got = {(r.aln_id, r.col): (r.a, r.c, r.g, r.t, r.bases, r.cover, r.occ) for r in registry.QUERIES["msa_occupancy"](spark, folder).collect()}
    assert got == want
    assert {r.aln_id: (r.first_match, r.last_match) for r in registry.QUERIES["msa_trim"](spark, folder).collect()} == trims
    assert {r.aln_id: (len(r.consensus), len(r.rf)) for r in registry.QUERIES["msa_consensus"](spark, folder).collect()} == lines


def test_row_occupancy_equals_that_of_cells(spark):
    rows = spark.createDataFrame([("a", "1", "-ac.~"), ("a", "1", "gg-------"), ("a", "2", "--"), ("b", "3", ""), ("b", "4", None), ("c", "5", "..-")], "aln_id string, row_id string, seq string")
    old, new = sequences.occupancy(sequences.alignment_cells(rows)), sequences.row_occupancy(rows)
    assert sorted(map(tuple, new.select(old.columns).collect())) == sorted(map(tuple, old.collect()))


def plain_finalize(rows):
    """rows of one alignment (row_id, seq, start, end, strand) as a dense table of letters."""
    width = max(len(r[1]) for r in rows)
    cells = np.array([list(r[1].ljust(width, "-")) for r in rows])
    filled, keep = cells != "-", np.ones(len(rows), bool)
    for _ in range(4):
        f = filled[keep]
        cover = np.zeros(width, int)
        for r in f:
            if r.any():
                cover[np.flatnonzero(r)[0] : np.flatnonzero(r)[-1] + 1] += 1
        at = np.flatnonzero((f.sum(0) >= 0.5 * np.maximum(cover, 1)) & (cover >= min(3, len(f))) & (cover > 0))
        low, high = (at[0], at[-1] + 1) if len(at) else (0, width)
        inside = filled[:, low:high].sum(1)
        keep = inside >= 30 if (inside >= 30).sum() >= 2 else inside > 0
    used = filled[keep][:, low:high].any(0)
    out = set()
    for (name, _, start, end, strand), c, f, k in zip(rows, cells, filled, keep, strict=True):
        left, right = int(f[:low].sum()), int(f[high:].sum())
        left, right = (right, left) if strand == "-" else (left, right)
        if k:
            out.add((name, "".join(c[low:high][used]), start + left, end - right, strand))
    return out


def test_finalize_reads_whole_texts(spark, texts, folder):
    want = set()
    for source, rows in aligned(texts).items():
        full = [(str(i), s, i * 1000, i * 1000 + len(s.replace("-", "")), "-" if i % 2 == 0 else "+") for i, s in rows]
        want |= {(source, *r) for r in plain_finalize(full)}
    assert {tuple(r) for r in registry.QUERIES["msa_finalize"](spark, folder).collect()} == want


SEQ = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTRACGTAACGTACGTACGTACGN")
AGAINST = str.maketrans("ACGTRN", "TGCAYN")


def test_sequence_queries_read_whole_texts(spark, texts, folder):
    repeats, pieces = {}, {}
    for i, text, *_ in texts:
        seq = "".join(c for c in letters(text) if "a" <= c <= "z").translate(SEQ)
        rc = seq.translate(AGAINST)[::-1]
        n = min(120, len(seq) // 2)
        missed = np.cumsum([a != b for a, b in zip(seq[:n], rc[:n], strict=True)])
        repeats[i] = tuple(int((missed <= t).sum()) for t in range(4))
        piece = seq[max(i % 50 - 5, 0) : i % 50 + 60]
        pieces[i] = piece.translate(AGAINST)[::-1] if i % 2 == 0 else piece
    assert {r.id: (r.tir_0, r.tir_1, r.tir_2, r.tir_3) for r in registry.QUERIES["tir_scan"](spark, folder).collect()} == repeats
    assert {r.id: r.seq for r in registry.QUERIES["revcomp_extract"](spark, folder).collect()} == pieces


def test_tier_queries_read_all_orders_and_lines(spark, tmp_path):
    orders = [(k, k, 250000.0) for k in (2, 1999, 2002, 50002)]
    lines = [(2, 17, 1, 50.0), (2, 18, 2, 25.0), (2002, 36, 2, 10.0), (50002, 34, 3, 40.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.seq: (r.n_dom, r.domains, r.best_cov) for r in registry.QUERIES["domain_summary"](spark, str(tmp_path)).collect()}
    assert got == {2: (2, "RVT_1;rve", 1.0), 2002: (1, "DDE_Tnp_4", 0.2), 50002: (1, "RVT_1", 0.8)}
    got = {(r.order_name, r.tier): (r.n, r.bp) for r in registry.QUERIES["tier_assign"](spark, str(tmp_path)).collect()}
    thin, large, whole = (analysis.TIERS[x] for x in ("B thin", "D", "A"))
    # that SINE's only domain covers a fifth of its profile
    assert got == {("LTR", thin): (1, 5000), ("DIRS", large): (1, 5000), ("SINE", large): (1, 5000), ("PLE", whole): (1, 5000)}
    assert [(r.place, r.seq, r.n_core) for r in registry.QUERIES["tier_rank"](spark, str(tmp_path)).orderBy("place").collect()] == [(1, 50002, 1)]
