"""Operators on small hand-made rows."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.functions import graph
from spanforge.functions.graph import connected_components
from spanforge.operators import analysis, copies, intervals, linkage, overassembly, readback, reports, selection, sequences
from spanforge.sources import drops, formats
from spanforge.sources.hits import read_annotations

HIT = "tool string, family string, chrom string, s long, e long, strand string, div double, ord long, cons_start long, cons_end long, cons_len long, hit_id string"


def hits(spark, rows, length=None, tool="t", family="f"):
    return spark.createDataFrame([(tool, family, c, s, e, d, 2.0, i, None, None, length, None) for i, (c, s, e, d) in enumerate(rows)], HIT)


def test_overlap_join_has_no_nested_loop(spark):
    a = spark.createDataFrame([("c", 0, 5000), ("c", 10, 20)], "chrom string, s long, e long")
    b = spark.createDataFrame([("c", 15, 3000), ("c", 20, 21), ("d", 0, 9)], "chrom string, s2 long, e2 long")
    joined = intervals.overlap_join(a, b, ["chrom"])
    assert sorted((r.s, r.s2) for r in joined.collect()) == [(0, 15), (0, 20), (10, 15)]
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_paint_last_writer_wins(spark):
    rows = spark.createDataFrame([("t", "c", 0, 100, "x", 1), ("t", "c", 50, 60, "y", 2), ("t", "c", 0, 10, "x", 3)], "tool string, chrom string, s long, e long, family string, ord long")
    got = intervals.paint(rows, ["tool", "chrom"], "family", F.col("ord")).orderBy("s").collect()
    assert [(r.s, r.e, r.family) for r in got] == [(0, 50, "x"), (50, 60, "y"), (60, 100, "x")]


@pytest.mark.parametrize("tile", [7, 64, 16_384])
def test_tiles_make_no_difference(spark, tile):
    rng = np.random.default_rng(2)
    rows = [("t", "c" + str(i % 2), int(s), int(s + n), "fgh"[i % 3], i) for i, (s, n) in enumerate(zip(rng.integers(0, 300, 60), rng.integers(1, 90, 60), strict=True))]
    df = spark.createDataFrame(rows, "tool string, chrom string, s long, e long, family string, ord long")
    owner = {}
    for _, c, s, e, f, _ in rows:
        owner.update({(c, x): f for x in range(s, e)})
    got = intervals.paint(df, ["tool", "chrom"], "family", F.col("ord"), tile).collect()
    assert {(r.chrom, x): r.family for r in got for x in range(r.s, r.e)} == owner and sum(r.e - r.s for r in got) == len(owner)
    # runs are whole
    assert not {(r.chrom, r.e, r.family) for r in got} & {(r.chrom, r.s, r.family) for r in got}
    made = intervals.islands(df, ["chrom"], tile).collect()
    assert {(r.chrom, x) for r in made for x in range(r.s, r.e)} == set(owner) and sum(r.e - r.s for r in made) == len(owner)
    assert not {(r.chrom, r.e) for r in made} & {(r.chrom, r.s) for r in made}


def test_paint_shuffles_rows_and_ends_once(spark):
    df = spark.range(100).selectExpr("'t' AS tool", "'c' AS chrom", "id AS s", "id + 5 AS e", "'f' AS family", "id AS ord")
    plan = intervals.paint(df, ["tool", "chrom"], "family", F.col("ord"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 6 and "CartesianProduct" not in plan


def test_coverage_fraction(spark):
    gaps = spark.createDataFrame([(1, "c", 100, 200), (2, "c", 5, 5), (3, "z", 0, 10)], "row long, chrom string, s long, e long")
    covers = spark.createDataFrame([("c", 90, 120), ("c", 110, 150), ("c", 190, 300)], "chrom string, s long, e long")
    assert {r.row: r.covered for r in intervals.coverage_fraction(gaps, covers, ["chrom"], "row").collect()} == {1: 0.6, 2: 0.0, 3: 0.0}


def test_components(spark):
    edges = spark.createDataFrame([(9, 5), (5, 3), (3, 8), (20, 21), (7, 7), (None, 1)], "a long, b long")
    assert {r.node: r.component for r in connected_components(edges).collect()} == {9: 3, 5: 3, 3: 3, 8: 3, 20: 20, 21: 20, 7: 7}
    chain = spark.range(100).selectExpr("(id * 7) % 101 AS a", "((id + 1) * 7) % 101 AS b")
    assert {r.component for r in connected_components(chain).collect()} == {0}
    assert connected_components(edges.filter("a > 99")).count() == 0


def test_merge_breaks_on_chromosome_and_strand(spark):
    got = copies.merge_copies(hits(spark, [("c1", 100, 200, "+"), ("c1", 210, 300, "+"), ("c1", 310, 400, "-"), ("c2", 100, 200, "+")]))
    rows = sorted((r.chrom, r.start, r.n_fragments, r.div) for r in got.collect())
    assert rows == [("c1", 100, 2, 2.0), ("c1", 310, 1, 2.0), ("c2", 100, 1, 2.0)]


def test_merge_gap_limit_and_overlap(spark):
    assert copies.merge_copies(hits(spark, [("c", 0, 100, "+"), ("c", 21000, 21100, "+")])).count() == 2
    assert copies.merge_copies(hits(spark, [("c", 0, 500, "+"), ("c", 10, 20, "+")])).count() == 2


@pytest.mark.parametrize("gap_aware", [False, True])
def test_merge_orders_ties_by_end_and_strand(spark, gap_aware):
    rows = [("t", "f", "c", 100, 150, "+", 1.0, 7, None, None, None, None), ("t", "f", "c", 100, 300, "-", 1.0, 7, None, None, None, None), ("t", "f", "c", 310, 400, "-", 1.0, 8, None, None, None, None)]
    for given in (rows, rows[::-1], [rows[1], rows[0], rows[2]]):
        got = copies.merge_copies(spark.createDataFrame(given, HIT), gap_aware).collect()
        assert sorted((r.start, r.end, r.strand, r.n_fragments) for r in got) == [(100, 150, "+", 1), (100, 400, "-", 2)]


def test_gap_veto(spark):
    own = hits(spark, [("c", 0, 100, "+"), ("c", 150, 250, "+"), ("c", 250, 350, "+")])
    other = spark.createDataFrame([("u", "g", "c", 103, 149, "+", 1.0, 99, None, None, None, None)], HIT)
    got = copies.merge_copies(own.unionByName(other), gap_aware=True).filter("tool = 't'")
    assert sorted(r.n_fragments for r in got.collect()) == [1, 2]


def test_widest_gap_split(spark):
    assert copies.split_widest([0, 150, 300], [100, 250, 400], 150) == [(0, 1), (1, 2), (2, 3)]
    assert copies.split_widest([0], [900], 100) == [(0, 1)]
    made = copies.merge_copies(hits(spark, [("c", 0, 100, "+"), ("c", 150, 250, "+"), ("c", 300, 400, "+")], 100))
    assert copies.cap_widest_gap(made).count() == 3


def plain_widest(starts, ends, cap):
    todo, done = [(0, len(starts))], []
    while todo:
        i, j = todo.pop()
        gaps = [starts[x] - ends[x - 1] for x in range(i + 1, j)]
        if not gaps or max(ends[i:j]) - starts[i] <= cap:
            done.append((i, j))
        else:
            at = i + 1 + gaps.index(max(gaps))
            todo += [(i, at), (at, j)]
    return sorted(done)


def test_widest_gap_tree_is_the_plain_split():
    rng = np.random.default_rng(6)
    for n in range(1, 60):
        starts = np.sort(rng.integers(0, 40 * n, n)).tolist()
        ends = [s + int(x) for s, x in zip(starts, rng.integers(1, 60, n), strict=True)]
        for cap in (0, 50, 300, 10**6):
            assert copies.split_widest(starts, ends, cap) == plain_widest(starts, ends, cap)


@pytest.mark.parametrize("gaps", ["rising", "equal", "random"])
def test_caps_are_linear(gaps):
    """200,000 fragments of one copy, also where each cut takes off one fragment only."""
    n = 200_000
    gap = {"rising": np.arange(n), "equal": np.full(n, 5), "random": np.random.default_rng(1).integers(1, 1000, n)}[gaps]
    starts = (np.cumsum(gap) + 10 * np.arange(n)).tolist()
    ends = [s + 10 for s in starts]
    began = time.process_time()
    assert len(copies.split_widest(starts, ends, 5)) == n
    assert len(copies.split_greedy(starts, ends, 5)) == n
    assert time.process_time() - began < 10


def test_greedy_cap(spark):
    made = copies.merge_copies(hits(spark, [("c", 0, 100, "+"), ("c", 110, 140, "+"), ("c", 160, 200, "+")], 100))
    assert sorted((r.start, r.end, r.n_fragments) for r in copies.cap_greedy(made, F.col("cons_len")).collect()) == [(0, 140, 2), (160, 200, 1)]


@pytest.mark.parametrize(("start", "end", "full", "span"), [(264, 529, False, True), (264, 300, False, False), (None, None, False, False), (1, 260, True, True)])
def test_near_full(spark, start, end, full, span):
    df = spark.createDataFrame([(start, end)], "cons_start long, cons_end long")
    r = df.select(copies.near_full(F.lit(265)).alias("a"), copies.near_full(F.lit(265), span_only=True).alias("b")).head()
    assert (r.a, r.b) == (full, span)


def test_deconvolution_table(spark):
    rows = [("k", f"m{i}", n, False) for i, n in enumerate([269, 264, 264, 764, 765])] + [("one", "a", 2533, False), ("one", "b", 1266, False)]
    rows += [("safe", f"m{i}", n, n > 1000) for i, n in enumerate([159, 516, 752, 1627, 1633])]
    got = {(r.cluster_key, r.member): r.verdict for r in copies.deconvolve(spark.createDataFrame(rows, "cluster_key string, member string, cons_len long, protected boolean")).collect()}
    assert [got[("k", f"m{i}")] for i in range(5)] == ["keep"] * 3 + ["deconvolve"] * 2
    assert got[("one", "a")] == "keep" and got[("safe", "m4")] == "abstain"


def test_loci(spark):
    def n(spans):
        rows = spark.createDataFrame([(i, "c", s, e) for i, (s, e) in enumerate(spans)], "copy_id long, chrom string, start long, end long")
        return copies.loci(rows).select("locus_id").distinct().count()

    assert n([(0, 100), (100, 200), (200, 300), (300, 400)]) == 4
    assert n([(0, 100), (3, 98), (5, 103)]) == 1
    assert n([(0, 100), (40, 140), (80, 180)]) == 1


def test_length_modes_and_nearest(spark):
    rows = [("k", f"m{i}", f"t{i}", x) for i, x in enumerate([423, 423, 414, 7400, 7367, 7359, 6523, 7400])] + [("k", "none", "t", None)]
    modes = copies.length_modes(spark.createDataFrame(rows, "key string, member string, tool string, cons_len long"), "key")
    assert sorted((r.centre, r.n_members, r.credible) for r in modes.collect()) == [(423.0, 3, True), (7367.0, 5, True)]
    spans = spark.createDataFrame([("k", x) for x in (420, 850, 1700, 1800, 7400, 12000)] + [("x", 5)], "key string, span long")
    got = {r.span: r.mode_index for r in copies.nearest_mode(spans, modes, "key", F.col("span")).collect()}
    assert got == {420: 0, 850: 0, 1700: 0, 1800: 1, 7400: 1, 12000: 1, 5: 0}


def test_density_split_brings_edges_back(spark):
    square = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.9), ("a", "c", 0.9), ("c", "d", 0.1), ("d", "e", 0.8), ("e", "f", 0.8), ("d", "f", 0.8)], "a string, b string, w_bp double")
    parts = lambda density: sorted("".join(sorted(r[1])) for r in linkage.lenient_clusters(square, density).groupBy("cluster_key").agg(F.collect_list("member")).collect())
    assert parts(0.9) == ["abc", "def"] and parts(0.1) == ["abcdef"]


def plain_lenient(edges, density, most_depth):
    """Edges deleted one by one until a part falls apart; all edges come back inside the halves."""
    every, out = sorted({(w, a, b) for a, b, w in edges}), []

    def parts(members, links):
        near = {m: {m} for m in members}
        for _, a, b in links:
            joined = near[a] | near[b]
            for m in joined:
                near[m] = joined
        return {frozenset(x) for x in near.values()}

    def split(members, depth):
        inside = [e for e in every if e[1] in members and e[2] in members]
        n = len(members)
        if n == 2 or depth > most_depth or len(inside) / (n * (n - 1) / 2) >= density:
            return out.append("".join(sorted(members)))
        for i in range(1, len(inside) + 1):
            found = parts(members, inside[i:])
            if len(found) > 1:
                for p in found:
                    if len(p) > 1:
                        split(p, depth + 1)
                return None

    for p in parts({x for e in every for x in e[1:]}, every):
        split(p, 0)
    return sorted(out)


@pytest.mark.parametrize(("seed", "density", "depth"), [(1, 0.5, 12), (2, 0.8, 12), (3, 0.9, 1)])
def test_lenient_clusters_are_those_of_deleting_edges(spark, seed, density, depth):
    rng = np.random.default_rng(seed)
    # few weights, so that ties are many
    edges = [(chr(97 + i), chr(97 + j), float(rng.integers(1, 6)) / 10) for i in range(14) for j in range(i + 1, 14) if rng.random() < 0.25]
    df = spark.createDataFrame([*edges, edges[0]], "a string, b string, w_bp double")
    got = linkage.lenient_clusters(df, density, depth).groupBy("cluster_key").agg(F.collect_list("member").alias("m"), F.first("n_members").alias("n")).collect()
    assert all(len(r.m) == r.n for r in got)
    assert sorted("".join(sorted(r.m)) for r in got) == plain_lenient(edges, density, depth)
    assert linkage.lenient_clusters(df.limit(0), density).count() == 0


def test_spanning_forest_is_kruskals(spark):
    rng = np.random.default_rng(8)
    edges = [(int(i), int(j), float(rng.integers(0, 4))) for i, j in rng.integers(0, 40, (90, 2))]
    root = list(range(40))
    find = lambda x: x if root[x] == x else find(root[x])
    want = set()
    for w, a, b in sorted({(w, a, b) for a, b, w in edges}, reverse=True):
        if find(a) != find(b):
            root[find(a)] = find(b)
            want.add((a, b, w))
    assert {tuple(r) for r in graph.spanning_forest(spark.createDataFrame(edges, "a long, b long, w double")).collect()} == want


def test_cluster_key_ignores_order(spark):
    r = spark.range(1).select(linkage.cluster_key(F.array(F.lit("b:2"), F.lit("a:1"))).alias("x"), linkage.cluster_key(F.array(F.lit("a:1"), F.lit("b:2"))).alias("y")).head()
    assert r.x == r.y and len(r.x) == 10


def test_vote_ties_and_abstention(spark):
    rows = [("k", "b", "LTR", None), ("k", "a", "TIR", 0.0), ("k", "c", "repeat", 99.0), ("e", "z", None, 1.0)]
    got = {r.cluster_key: (r.winner, r.share) for r in linkage.weighted_vote(spark.createDataFrame(rows, "cluster_key string, member string, vote string, weight double"), ["repeat"]).collect()}
    assert got == {"k": ("TIR", 0.5), "e": (None, None)}


def test_consensus_and_rf(spark):
    rows = spark.createDataFrame([("a", "1", "ACGT.ACGT"), ("a", "2", "ACGT-ACGT"), ("a", "3", "acgtaACGT")], "aln_id string, row_id string, seq string")
    cells = sequences.alignment_cells(rows)
    calls = sequences.called(sequences.occupancy(cells), rows.groupBy("aln_id").agg(F.count("*").alias("n_rows")))
    got = sequences.consensus(calls).head()
    assert got.consensus == "ACGTACGT" and got.rf == "ACGT.ACGT"


def test_finalize_moves_coordinates_by_strand(spark):
    body = "ACGTACGTACGTACGTACGTACGTACGTACGTACGT"
    rows = [("a", str(i), "--" + body + "-", 0, 36, "+") for i in range(4)] + [("a", "p", "GG" + body + "T", 100, 139, "+"), ("a", "q", "GG" + body + "T", 200, 239, "-")]
    got = {r.row_id: (r.start, r.end, r.seq) for r in sequences.finalize(spark.createDataFrame(rows, "aln_id string, row_id string, seq string, start long, end long, strand string")).collect()}
    assert got["p"] == (102, 138, body) and got["q"] == (201, 237, body)


def test_names_and_complement(spark):
    df = spark.createDataFrame([("AACGTRn",)], "s string")
    assert df.select(sequences.reverse_complement(F.col("s"))).head()[0] == "nYACGTT"
    name = df.select(sequences.interval_id(F.lit("asm"), F.lit("chr:1"), F.lit(9), F.lit(20), F.lit(".")).alias("n"))
    assert name.head().n == "asm:chr:1:10-20_+"
    p = name.select(sequences.parse_interval_id(F.concat(F.lit("_R_"), "n")).alias("p")).head().p
    assert (p.chrom, p.start, p.end, p.strand) == ("chr:1", 9, 20, "-")


def test_tier_order(spark):
    rows = [("SINE", 900, 3, 3, 50, 9), ("SINE", 100, 0, 0, 50, 9), ("LTR", 5000, 1, 1, 50, 9), ("LTR", 5000, 1, 1, 5, 9), ("LTR", 10, 1, 1, 50, 9), ("LTR", 10, 1, 0, 50, 9), ("LTR", 5000, 0, 0, 50, 9), ("Unknown", 9000, 0, 0, 50, 9)]
    rows += [("LTR", 5000, 1, 1, None, 9), ("LTR", 5000, 1, 1, 50, None), ("Helitron", 3000, 0, 0, 9, 9)]
    df = spark.createDataFrame(rows, "o string, l int, d int, c int, r int, p int")
    got = [r[0] for r in df.select(analysis.tier(*map(F.col, "oldcrp"[0:1] + "ldcrp"))).collect()]
    assert got == [analysis.TIERS[x] for x in ("D", "E", "A", "B thin", "B short", "C", "D", "F", "B thin", "B thin", "D")]


@pytest.mark.parametrize(("path", "tp", "order"), [("repeat:TE:DNA/hAT", None, "TIR"), ("Helitron", None, "RC"), ("repeat:source", None, "Unknown"), ("x:RC", None, "RC"), ("Penelope", None, "PLE"), (None, "rolling", "RC"), ("LTR", "LINE", "LINE"), (None, None, "Unknown")])
def test_order_of_path(spark, path, tp, order):
    df = spark.createDataFrame([(path, tp)], "path string, tp string")
    assert df.select(analysis.order_of_path(F.col("path"), F.col("tp"))).head()[0] == order


@pytest.mark.parametrize(("name", "kind"), [("Transposase_22", None), ("Transposase_21", "transposase"), ("RVP_2", "RT"), ("HTH_Tnp_Tc3_1", "transposase"), ("Helitron_like_N", "transposase"), ("rve_3", "integrase"), ("Preve", None), ("RVT_1", "RT"), ("RVT_1x", None), ("gag_pre", None)])
def test_domain_kinds(spark, name, kind):
    assert spark.createDataFrame([(name,)], "p string").select(analysis.domain_kind(F.col("p"))).head()[0] == kind


def test_domain_table(spark):
    lines = [
        "# hit ID  target name         accession  query name           accession   hmm len  hmm from    hmm to   seq len  ali from    ali to    E-value  score  bias   PID  description of target",
        "       1 c00264_single        -          RVT_1                PF00078.33      200         1       199       7735      4303      4782   2.3e-43  143.8   0.0 30.50 -",
        "       6 c01141_single        -          RVT_1                PF00078.33      200       200         2       7065      3593      3111   6.7e-41  135.8   0.0 28.00 -",
        "       7 c01141_single        -          rve", "       8 a - b c x 1 2 3 4 5 1e-3 1 0 1 -", "",
    ]
    got = analysis.parse_domain_table(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.seq, r.profile, r.hmm_len, r.evalue, r.hmm_cov) for r in got] == [("c00264_single", "RVT_1", 200, 2.3e-43, 0.995), ("c01141_single", "RVT_1", 200, 6.7e-41, 0.995)]


def test_core_domains_need_coverage(spark):
    rows = [("a", "RVT_1", 0.4), ("a", "rve", 0.9), ("a", "gag", 1.0), ("b", "MULE", 0.49)]
    got = {r.seq: (r.n_dom, r.n_core, r.core_kinds, r.core_domains, r.best_cov) for r in analysis.domain_summary(spark.createDataFrame(rows, "seq string, profile string, hmm_cov double")).collect()}
    assert got == {"a": (3, 1, "integrase", "rve", 1.0), "b": (1, 0, "", "", 0.49)}


def test_tandem_share_counts_all_bases(spark):
    rows = [("k", "a", "t", 9.0, 100.0, 1.0, 1.0, 0.5), ("k", "b", "u", None, 900.0, None, 1.0, None), ("n", "c", "t", None, None, None, None, 0.1)]
    members = spark.createDataFrame(rows, "cluster_key string, member string, tool string, n_full_len double, genomic_bp double, cov double, div_median double, frac_tandem double")
    votes = spark.createDataFrame([("k", "LTR", 1.0), ("n", None, None)], "cluster_key string, winner string, share double")
    got = {r.cluster_key: (r.tandem, r.g4, r.candidate) for r in linkage.gates(members, votes).collect()}
    assert got == {"k": (0.05, True, True), "n": (None, False, False)}


def test_evidence_joins_once(spark):
    members = spark.createDataFrame([("k", "a"), ("k", "b")], "cluster_key string, member string")
    evidence = spark.createDataFrame([("a", 5.0), ("z", 1.0)], "member string, genomic_bp double")
    assert {r.member: r.genomic_bp for r in linkage.with_evidence(members, evidence).collect()} == {"a": 5.0, "b": None}
    with pytest.raises(Exception, match="twice"):
        linkage.with_evidence(members, evidence.unionByName(evidence)).collect()


def test_gap_veto_asks_for_the_cluster(spark):
    own = hits(spark, [("c", 0, 100, "+"), ("c", 150, 250, "+")])
    between = lambda tool, family: spark.createDataFrame([(tool, family, "c", 103, 149, "+", 1.0, 99, None, None, None, None)], HIT)
    mates = F.when(F.col("family").isin("f", "mate"), "k")
    for tool, family, merged in (("u", "mate", 2), ("u", "g", 1), ("t", "g", 1), ("t", "mate", 2)):
        made = copies.merge_copies(own.unionByName(between(tool, family)), gap_aware=True, cluster=mates)
        assert made.filter("family = 'f'").agg(F.max("n_fragments")).head()[0] == merged, (tool, family)
        plan = made._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("ords", [(1, 2, 1, 2, 2), (None,) * 5, (1, 2, 3, 4, 5)])
def test_gap_veto_with_shared_or_missing_ord(spark, ords):
    """A gap is told by its place: hits of other members that share an ord don't open it, and no hit comes twice."""
    rows = [("A", "F1", "c1", 0, 100), ("A", "F1", "c1", 200, 300), ("B", "G1", "c2", 0, 100), ("B", "G1", "c2", 200, 300), ("C", "H1", "c1", 100, 200)]
    df = spark.createDataFrame([(t, f, c, s, e, "+", 1.0, o, None, None, None, None) for (t, f, c, s, e), o in zip(rows, ords, strict=True)], HIT)
    got = sorted((r.tool, r.start, r.end, r.n_fragments) for r in copies.merge_copies(df, gap_aware=True).collect())
    assert got == [("A", 0, 100, 1), ("A", 200, 300, 1), ("B", 0, 300, 2), ("C", 100, 200, 1)]


@pytest.mark.parametrize("records", [1, 3, 1000])
def test_paint_sweeps_tiles_over_batches(spark, records):
    """Tiles that end within an Arrow batch, at its end, and take in several; null values, equal orders and a pile-up."""
    rng = np.random.default_rng(4)
    rows = [("tu"[i % 2], "c", int(s), int(s + n), [None, "f", "g", "h"][i % 4], i // 3) for i, (s, n) in enumerate(zip(rng.integers(0, 500, 200), rng.integers(0, 60, 200), strict=True))]
    owner = {}
    for t, _, s, e, f, _ in sorted(rows, key=lambda r: (r[5], r[4] is not None, r[4])):
        owner.update({(t, x): f for x in range(s, e)})
    df = spark.createDataFrame(rows, "tool string, chrom string, s long, e long, family string, ord long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = intervals.paint(df, ["tool", "chrom"], "family", F.col("ord"), 64).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.tool, x): r.family for r in got for x in range(r.s, r.e)} == owner
    assert sum(r.e - r.s for r in got) == len(owner)
    ends = {(r.tool, r.e): r.family for r in got}
    assert not any(ends.get((r.tool, r.s), "none") == r.family for r in got)


def test_paint_of_a_pile_up(spark):
    """Very many hits in one tile cost about as much each as few do: nothing is joined piece by row."""
    df = spark.range(32_000).selectExpr("'t' AS tool", "'c' AS chrom", "pmod(xxhash64(id), 16000) AS s", "pmod(xxhash64(id), 16000) + 200 + id % 51 AS e", "'f' || (id % 7) AS family", "id AS ord")
    painted = intervals.paint(df, ["tool", "chrom"], "family", F.col("ord"))
    plan = painted._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    covered = painted.agg(F.sum(F.col("e") - F.col("s"))).head()[0]
    assert covered == intervals.islands(df, ["tool", "chrom"]).agg(F.sum(F.col("e") - F.col("s"))).head()[0]


def test_hit_ids_over_chromosomes_and_members_without_any(spark):
    rows = [("t", "f", "c2", 5, 9, "+", 1.0, 1, None, None, None, "h"), ("t", "f", "c1", 2, 4, "-", 1.0, 2, None, None, None, "h"), ("t", "f", "c1", 7, 8, "+", 1.0, 3, None, None, None, None)]
    rows += [("u", "g", "c1", 0, 10, "+", 1.0, 4, None, None, None, None), ("u", "g", "c1", 20, 30, "+", 1.0, 5, None, None, None, None)]
    got = sorted((r.tool, r.chrom, r.start, r.end, r.strand, r.n_fragments) for r in copies.hit_id_copies(spark.createDataFrame(rows, HIT)).collect())
    assert got == [("t", "c1", 2, 9, "-", 2), ("u", "c1", 0, 30, "+", 2)]


def test_mates_with_more_hits_paint_last(spark):
    mate = lambda family, s, e, i: ("t", family, "c", s, e, "+", 1.0, i, None, None, None, None)
    rows = [mate("many", 0, 100, 1), mate("many", 500, 600, 2), mate("few", 0, 100, 3)]
    lengths = spark.createDataFrame([("t", "many", 264), ("t", "few", 764)], "tool string, family string, cons_len long")
    bare = spark.createDataFrame([(1, "c", 0, 90), (2, "c", 200, 300)], "row long, chrom string, s long, e long")
    assert {r.row: r.cons_len for r in copies.inherited_lengths(bare, spark.createDataFrame(rows, HIT), lengths, "row").collect()} == {1: 264, 2: None}


def test_clipped_to_known_chromosomes(spark):
    rows = spark.createDataFrame([("c", 5, 50), ("c", 40, 60), ("c", 60, 70), ("x", 0, 1)], "chrom string, s long, e long")
    sizes = spark.createDataFrame([("c", 55)], "chrom string, size long")
    assert sorted((r.s, r.e) for r in intervals.clipped(rows, sizes).collect()) == [(5, 50), (40, 55)]


PHASE = "tool string, family string, repeat_start double, repeat_end double, repeat_left double, hit_len double"


def test_overassembly_reasons_and_verdicts(spark):
    array = [("t", "array", 1.0 + 200 * (i % 3), 200.0 * (i % 3 + 1), 600 - 200.0 * (i % 3 + 1), 200.0) for i in range(120)]
    whole = [("t", "whole", 1.0 if i % 2 else 50.0 + i, 600.0 if i % 2 else 330.0 + i, 0.0 if i % 2 else 270.0 - i, 599.0) for i in range(160)]
    short = [("t", "short", 1.0, 50.0, 30.0, 49.0)] * 60
    few = [("t", "few", 1.0, 50.0, 300.0, 49.0)] * 49 + [("t", "few", None, 50.0, 300.0, 49.0)] * 20
    ends = [("t", "ends", 1.0, 600.0, 0.0, 599.0)] * 60
    loose = [("t", "loose", 1.0, 50.0, 300.0 + 9 * i, 49.0) for i in range(60)]
    records = overassembly.family_records(spark.createDataFrame(array + whole + short + few + ends + loose, PHASE))
    got = {r.family: r for r in records.collect()}
    assert {f: r.reason for f, r in got.items()} == {
        "array": "over_assembly", "whole": "consensus_length_is_realised", "short": "consensus_too_short", "few": "too_few_hits_with_cons_coords", "ends": "too_few_internal_endpoints", "loose": "consensus_length_inconsistent",
    }
    r = got["array"]
    assert (r.k, r.unit_len, r.rho, r.boundary_occ, r.boundary_support, r.flag) == (3.0, 200.0, 1.0, "0.5;0.5", 2, True)
    assert got["few"].n_hits == 69 and got["few"].cons_len is None

    def verdict(clusters, lengths):
        mates = records.filter("family = 'whole'").withColumn("cons_len", F.lit(lengths).cast("double"))
        rows = records.filter("family = 'array'").unionByName(mates)
        return {r.family: r.verdict for r in overassembly.verdicts(rows, spark.createDataFrame(clusters, "cluster_id int, tool string, family string")).collect()}["array"]

    both = [(4, "t", "array"), (4, "t", "whole")]
    assert verdict(both, 205.0) == "confirmed_over_assembly"
    assert verdict(both, 590.0) == "suspect_coordinate_only"
    assert verdict(both, None) == "suspect_no_mate_length"
    assert verdict([(4, "t", "whole")], 205.0) == "suspect_no_cluster"
    assert [r.family for r in overassembly.flag_order(records).limit(1).collect()] == ["array"]


def test_quotas_by_depth(spark):
    rows = [(i, "a:b:c" if i < 5 else "a:b:c:d" if i < 25 else "a", i % 3, "o") for i in range(60)]
    df = spark.createDataFrame(rows, "cluster_id long, majority_path string, n_tools long, majority_order string")
    got = selection.quota_select(df.withColumn("candidate", F.lit(True)).unionByName(df.withColumn("candidate", F.lit(False)).withColumn("cluster_id", -F.col("cluster_id"))), 30, F.col("cluster_id")).groupBy("path_depth").count().collect()
    assert {r.path_depth: r["count"] for r in got} == {3: 5, 4: 9, 1: 16}
    assert selection.quota_select(df.withColumn("candidate", F.lit(True)), 3, F.col("cluster_id")).count() == 3


def test_models_fall_back_and_need_loci(spark):
    modes = spark.createDataFrame([("k", 0, 100.0, 2, 2, "a", True), ("k", 1, 900.0, 3, 2, "a", True), ("one", 0, 50.0, 1, 1, "a", False), ("one", 1, 80.0, 4, 1, "a", False)], "key string, mode_index int, centre double, n_members long, n_tools long, tools string, credible boolean")
    made = selection.models(modes, "key")
    assert sorted((r.key, r["index"], r.centre, r.n_models) for r in made.collect()) == [("k", 0, 100.0, 2), ("k", 1, 900.0, 2), ("one", 0, 80.0, 1)]
    loci = spark.createDataFrame([("k", 90), ("k", 120), ("k", 1000), ("k", 1400), ("one", 500)], "key string, span long")
    got = {(r.key, r["index"]): (r.n_loci, r.n_over, r.error) for r in selection.fan_out(loci, made, "key").collect()}
    assert got == {("k", 0): (2, 0, None), ("k", 1): (2, 1, "only 1 loci in this mode"), ("one", 0): (1, 1, None)}
    df = spark.createDataFrame([("a", True), ("a", False), ("b", None)], "key string, known boolean")
    assert sorted((r.key, r.known) for r in selection.measured_or_all(df, "key", F.col("known")).collect()) == [("a", True), ("b", None)]


def test_rows_read_back(spark):
    known = spark.createDataFrame([("a:c:11-60_+", "c", 10, 60, "+"), ("a:c:101-150_-", "c", 100, 150, "-")], "seq_id string, chrom string, start long, end long, strand string")
    ids = ["a:c:11-60_+", "_R_a:c:11-60_+", "a:c:11-60_+:5-20_-", "a:c:101-150_-:5-20_+", "a:c:101-150_-:1-50_-", "nonsense", "other:5-20_+"]
    got = {r.row_id: (r.start, r.end, r.strand) for r in readback.read_back(spark.createDataFrame([(x,) for x in ids], "row_id string"), known).collect()}
    assert got == {
        ids[0]: (10, 60, "+"), ids[1]: (10, 60, "-"), ids[2]: (14, 30, "-"), ids[3]: (130, 146, "-"), ids[4]: (100, 150, "+"), "nonsense": (None, None, None), "other:5-20_+": (None, None, None),
    }


def test_trimmed_columns_move_coordinates(spark):
    rows = [("a", "p", "GG-ACGT-T", 100, 107, "+"), ("a", "m", "GGAAC-T-T", 200, 207, "-"), ("a", "e", "GG------T", 0, 3, "+")]
    got = {r.row_id: (r.seq, r.start, r.end) for r in readback.trim_columns(spark.createDataFrame(rows, "aln_id string, row_id string, seq string, start long, end long, strand string"), F.lit(2), F.lit(8)).collect()}
    assert got == {"p": ("-ACGT", 102, 106), "m": ("AAC-T", 201, 205)}


def test_factor_verdicts(spark):
    rows = [("s", 600, 301, 1, "plus", 200), ("w", 600, 301, 1, "plus", 100), ("n", 600, 301, 1, "minus", 300), ("n", 600, 599, 1, "plus", 300)]
    got = {r.seq: (r.best_bp, r.best_offset, r.verdict) for r in reports.factor_support(spark.createDataFrame(rows, "seq string, len int, q_start int, s_start int, strand string, length int"), [2]).collect()}
    assert got == {"s": (200, 300, "SUPPORTS k=2"), "w": (100, 300, "weak/partial support for k=2"), "n": (0, 0, "NO support for k=2")}


def test_report_files(spark, tmp_path):
    (tmp_path / "x.sizes").write_text("c1\t100\nc2\t50\n")
    assert formats.read_sizes(spark, str(tmp_path / "x.sizes")).agg(F.sum("size")).head()[0] == 150
    spark.createDataFrame([("t", "f", 5.0)], "tool string, family string, genomic_bp double").write.parquet(str(tmp_path / "e"))
    r = formats.read_evidence(spark, str(tmp_path / "e")).head()
    assert (r.member, r.genomic_bp, r.div_median) == ("t:f", 5.0, None)
    (tmp_path / "v.tsv").write_text("# vocabulary_version: 7\ncanonical_path\tnote\na:b\tx\n \ty\n")
    paths, version = formats.read_vocabulary(spark, str(tmp_path / "v.tsv"))
    assert version == "7" and [r.canonical_path for r in paths.collect()] == ["a:b"]
    lines = spark.createDataFrame([("# c",), ("rm_class\tdfam_lineage",), ("LINE/L1\troot;LINE",), ("alone",), ("",)], "value string")
    assert {r.name for r in reports.accepted_names(lines).collect()} == {"LINE/L1", "root;LINE", "alone"}
    assert [tuple(r) for r in reports.long_names(lines).collect()] == [("LINE/L1", "root;LINE")]
    mapping = spark.createDataFrame([("b", "tp2", "1", "u", "exact", None, None), ("a", "tp1", "1", "u", "exact", "long", "n")], "canonical_path string, tp string, scheme_version string, source_url string, status string, tp_long string, note string")
    formats.write_mapping(mapping, str(tmp_path / "map"), "3", ("made here",))
    assert [r.canonical_path for r in formats.read_mapping(spark, str(tmp_path / "map")).collect()] == ["a", "b"]
    text = next(p for p in (tmp_path / "map").iterdir() if p.name.startswith("part")).read_text()
    assert text.startswith("#tp_map_version: 3\n#generated: 20") and "# made here\n" in text
    for name, body in {"cluster_1/gap/packet.json": '{"cluster_id": 1, "mode": "gap", "canonical_path": "a:b", "engines": {"mafft": {"rebuilt_consensus_len": 90, "lint": {"genome": {"n_error": 2}}}, "refiner": {"error": "no"}}}', "cluster_1/gap/model0_90bp/packet.json": '{"cluster_id": 1, "model_index": 0, "n_models": 2, "engines": {"mafft": {}}}', "cluster_2/gap/packet.json": '{"cluster_id": 2, "error": "x"}', "cluster_3/gap/packet.json": "{broken"}.items():
        path = tmp_path / "packets" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    got = sorted((r.cluster_id, r.model_dir, r.engine, r.cons, r.lint_err, r.engine_error, r.path_depth) for r in formats.read_packets(spark, str(tmp_path / "packets")).collect())
    assert got == [(1, "", "mafft", 90.0, 2, None, 2), (1, "", "refiner", None, None, "no", 2), (1, "model0_90bp", "mafft", None, None, None, 0)]
    consensus = spark.createDataFrame([("# Avg Kimura = 12.5)",), (">c",), ("AC.G",), ("T-T",)], "value string").coalesce(1)
    assert tuple(formats.read_consensus(consensus).head()) == (12.5, "ACGTT")
    formats.write_json(mapping.limit(1), str(tmp_path / "j"))
    formats.write_edges(mapping, str(tmp_path / "edges"))
    formats.write_coverage(spark.createDataFrame([("s", "b", 1, "exact"), ("s", "a", 2, "UNMAPPED")], "scope string, canonical_path string, n long, status string"), str(tmp_path / "cov"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "cov")).count() == 2


def test_formats(spark, tmp_path):
    fasta = tmp_path / "x.fa"
    fasta.write_text(">one some words\nACGT\nAC\n>two\nGGG\n")
    seqs = formats.read_fasta(spark, str(fasta))
    assert {r.id: r.seq for r in seqs.collect()} == {"one": "ACGTAC", "two": "GGG"}
    formats.write_fasta(seqs, str(tmp_path / "out"), 4)
    assert {r.id: r.seq for r in formats.read_fasta(spark, str(tmp_path / "out")).collect()} == {"one": "ACGTAC", "two": "GGG"}
    rows = spark.createDataFrame([("a", "r1", "AC-"), ("a", "long", "ACG")], "aln_id string, row_id string, seq string")
    tags = spark.createDataFrame([("a", 1, "ID", "fam"), ("a", 2, "RF", "AC.")], "aln_id string, place int, tag string, value string")
    record = formats.stockholm(rows, tags).head().record
    assert record == "# STOCKHOLM 1.0\n#=GF ID   fam\nlong  ACG\nr1    AC-\n#=GC RF  AC.\n//\n"
    (tmp_path / "x.stk").write_text(record)
    assert {r.row_id: r.seq for r in formats.read_stockholm(spark, str(tmp_path / "x.stk")).collect()} == {"r1": "AC-", "long": "ACG"}


def test_stockholm_of_many_records(spark, tmp_path):
    """A hundred packets written and read back, rows of one alignment apart from those of others, interleaved ones joined."""
    rows = [(f"p{i:03d}", f"r{j}", "ACGT-."[: 3 + i % 3] if j else "NNN---"[: 3 + i % 3]) for i in range(100) for j in range(3)]
    tags = [(f"p{i:03d}", 1, "ID", f"p{i:03d}") for i in range(100)]
    records = formats.stockholm(spark.createDataFrame(rows, "aln_id string, row_id string, seq string"), spark.createDataFrame(tags, "aln_id string, place int, tag string, value string"))
    for _ in range(2):
        formats.write_records(records.repartition(4), str(tmp_path / "seeds"))
    assert sorted(map(tuple, formats.read_stockholm(spark, str(tmp_path / "seeds")).collect())) == sorted(rows)
    (tmp_path / "two.stk").write_text("# STOCKHOLM 1.0\n#=GF ID one\nr1 AC\nr2 GG\n\nr1 GT\nr2 TT\n//\n# STOCKHOLM 1.0\nr1 A-\n//\n")
    assert sorted(map(tuple, formats.read_stockholm(spark, str(tmp_path / "two.stk")).collect()), key=str) == [("one", "r1", "ACGT"), ("one", "r2", "GGTT"), (None, "r1", "A-")]
    (tmp_path / "rows.fa").write_text(">_R_c1:5-9_+ x\nac~g\nt.\n>plain\nA_C\n")
    assert sorted(map(tuple, formats.read_aligned_fasta(spark, str(tmp_path / "rows.fa")).collect())) == [("c1:5-9_+", True, "AC-GT-"), ("plain", False, "A-C")]


def test_drops_are_counted_in_the_pass_that_reads(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "bad"), (-4, "bad"), (-5, "b")], "x long, y string")
    kept, seen = drops.split(rows, {"negative": F.col("x") < 0, "no_name": F.col("y").isNull(), "bad_name": F.col("y") == "bad"})
    assert [r.x for r in kept.collect()] == [1] and kept.columns == rows.columns
    assert {r.reason: r.n for r in drops.counts(spark, seen).collect()} == {"bad_name": 1, "kept": 1, "negative": 2, "no_name": 1}


@pytest.mark.parametrize("tile", [16, 100, 16_384])
def test_overlap_links_give_the_components_of_all_pairs(spark, tile):
    rng = np.random.default_rng(11)
    rows = [("c" + str(i % 2), int(s), int(s + n), i) for i, (s, n) in enumerate(zip(rng.integers(0, 900, 150), rng.integers(1, 80, 150), strict=True))]
    label = list(range(len(rows)))
    for i, (c, s, e, _) in enumerate(rows):
        for j, (d, s2, e2, _) in enumerate(rows[:i]):
            if c == d and min(e, e2) - max(s, s2) >= 0.5 * min(e - s, e2 - s2):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    links = intervals.overlap_links(spark.createDataFrame(rows, "chrom string, s long, e long, row long"), "chrom", "row", 0.5, tile)
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert [got.get(i, i) for i in range(len(rows))] == label


def test_a_pile_up_of_copies_makes_no_pairs(spark):
    df = spark.range(3000).selectExpr("'c' AS chrom", "id % 50 AS s", "2000 + id % 50 AS e", "id AS row")
    links = intervals.overlap_links(df, "chrom", "row", 0.5)
    assert links.count() == 2999 and "Join" not in links._jdf.queryExecution().executedPlan().toString()


def test_eligible_tools_and_families(spark):
    hits_ = spark.createDataFrame([("names", f"f{i}", 1) for i in range(101)] + [("masks", "m", None)] * 1001 + [("good", f"f{i % 5}", i % 2 or None) for i in range(50)], "tool string, family string, cons_start int")
    manifest = spark.createDataFrame([("names", "general_homology"), ("masks", "ltr_only"), ("good", "structural_te"), ("none", "ltr_only"), ("odd", None)], "tool string, scope string")
    got = {r.tool: (r.ran, r.clusterable) for r in linkage.eligible_tools(manifest, linkage.tool_status(hits_)).collect()}
    assert got == {"names": (True, False), "masks": (True, False), "good": (True, True), "none": (False, False), "odd": (False, False)}
    rows = spark.createDataFrame([("a", "repeat:TE:LTR"), ("b", "repeat:tandem:x"), ("c", "repeat:multigene"), ("d", "repeat:artefact"), ("(AT)n", "repeat:TE"), ("e", None), (None, "repeat")], "family string, path string")
    assert sorted(str(r.family) for r in linkage.repeat_families(rows).collect()) == ["None", "a", "e"]


def test_counts_over_length_and_working_columns(spark):
    rows = spark.createDataFrame([("a", 0, 151, 100), ("a", 1, 150, 100), ("b", 0, 500, None)], "member string, mode_index int, span long, reference long")
    assert {(r.scope, r.name): (r.n, r.n_over) for r in selection.over_length(rows).collect()} == {("member", "a"): (2, 1), ("member", "b"): (1, 0), ("mode", "0"): (2, 1), ("mode", "1"): (1, 0)}
    given = spark.createDataFrame([("k", i, i % 2 == 0, 1, 50, 100, f"own{i}", i * 7) for i in range(40)], "key string, row long, is_full boolean, cons_start long, cons_end long, cons_len long, take string, draw long")
    made = copies.stratified_sample(given, "key", 10, 2, 0.5, F.col("row"))
    assert made.columns == [*given.columns, "cov_band"] and made.count() == 10 and all(r.take == f"own{r.row}" and r.draw == r.row * 7 for r in made.collect())


def test_file_digests(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.tsv").write_bytes(b"abc")
    (tmp_path / "b.tsv").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.sha256) for r in formats.file_digests(spark, str(tmp_path)).collect()}
    # an empty file is no row
    assert got == {"a.tsv": (3, "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")}


def test_annotation_reader(spark, tmp_path):
    (tmp_path / "x.bed").write_text("\t".join("abcdefghijklmnop") + "\n" + "\t".join(["c1", "10", "20", "fam", "0", "+", "1", "2.5", "0", "0", "-", "repeat:TE", "NA", ".", "5", "h1"]) + "\n")
    r = read_annotations(spark, str(tmp_path / "x.bed")).head()
    assert (r.chrom, r.chrom_start, r.repeat_start, r.repeat_end, r.repeat_left, r.hit_id) == ("c1", 10, None, None, 5, "h1")
