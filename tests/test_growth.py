"""Steps that the review of round 3 projected beyond their limits: what they move must not grow with more than the input."""

from random import Random

from pyspark.sql import functions as F

from spanforge.functions.graph import connected_components
from spanforge.operators import analysis, copies, evidence, intervals, linkage, readback

HIT = "tool string, family string, chrom string, s long, e long, strand string, div double, ord long, cons_start long, cons_end long, cons_len long"


def _hits(spark, n=600, end=60_000):
    draw = Random(5)
    rows = []
    for i in range(n):
        s = draw.randrange(end)
        rows.append((draw.choice("tuv"), draw.choice(["f", "g", None]), draw.choice(["c", "d", None]), s, s + draw.randrange(0, 900), draw.choice("+-"), 1.0, i, 1, 90, 100))
    return spark.createDataFrame(rows, HIT)


def test_loci_of_one_tile_are_joined_by_no_links(spark, monkeypatch):
    seen = []

    def counted(edges, a="a", b="b"):
        seen.append(edges.count())
        return connected_components(edges, a, b)

    monkeypatch.setattr(copies, "connected_components", counted)
    rows = spark.range(200).selectExpr("id AS copy_id", "'c' AS chrom", "id * 20 AS start", "id * 20 + 100 AS end", "'t' AS note")
    assert copies.loci(rows).select("locus_id", "note").distinct().count() == 1 and seen == [0]


def test_loci_across_tiles_are_those_of_all_links(spark):
    hits = _hits(spark, 1500, 150_000)
    rows = hits.select(F.col("ord").alias("copy_id"), "chrom", F.col("s").alias("start"), F.col("e").alias("end"))
    want = {r.node: r.component for r in connected_components(intervals.overlap_links(hits.filter("e > s").select("chrom", "s", "e", F.col("ord").alias("row")), "chrom", "row", 0.5)).collect()}
    assert {r.copy_id: r.locus_id for r in copies.loci(rows).collect()} == {i: want.get(i, i) for i in range(1500)}


def test_joint_bases_are_those_of_painted_pieces(spark):
    hits = _hits(spark)
    painted = intervals.paint(hits, ["tool", "chrom"], "family", F.col("ord"))
    want = {(r.tool, r.family): r.footprint for r in linkage.footprints(painted).collect()}
    pieces, joint = painted.filter("chrom IS NOT NULL AND family IS NOT NULL").collect(), {}
    for a in pieces:
        for b in pieces:
            bp = min(a.e, b.e) - max(a.s, b.s)
            if a.tool < b.tool and a.chrom == b.chrom and bp > 0:
                key = (a.tool, a.family, b.tool, b.family)
                joint[key] = joint.get(key, 0) + bp
    bases = linkage.joint_bases(hits)
    assert "Join" not in bases._jdf.queryExecution().optimizedPlan().toString()
    got = bases.collect()
    assert {(r.tool_a, r.family_a): r.bp for r in got if r.tool_b is None} == want
    assert {(r.tool_a, r.family_a, r.tool_b, r.family_b): r.bp for r in got if r.tool_b and r.family_a and r.family_b} == joint


def test_domains_are_not_multiplied_for_distinct_counts(spark):
    rows = [("a", "Transposase_1", 0.9), ("a", "Transposase_1", 0.1), ("a", "other", 0.9), ("a", None, 1.0), ("b", None, None)]
    made = analysis.domain_summary(spark.createDataFrame(rows, "seq string, profile string, hmm_cov double"))
    assert "Expand" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r.seq: (r.n_dom, r.domains, r.n_core, r.core_domains, r.best_cov) for r in made.collect()}
    assert got == {"a": (2, "Transposase_1;other", 1, "Transposase_1", 1.0), "b": (0, "", 0, "", None)}


def test_rows_that_are_found_share_no_key_of_the_second_look(spark):
    known = spark.createDataFrame([(f"a:c:{i}-{i + 9}_+", "c", i - 1, i + 9, "+") for i in range(1, 41)], "seq_id string, chrom string, start long, end long, strand string")
    ids = known.select(F.col("seq_id").alias("row_id")).unionByName(known.select(F.concat("seq_id", F.lit("?")).alias("row_id"))).unionByName(known.select(F.concat("seq_id", F.lit(":2-3_-")).alias("row_id")))
    made = readback.read_back(ids, known)
    keys = made._jdf.queryExecution().analyzed().toString()
    assert "other" in keys and sorted((r.chrom or "", r.end or 0) for r in made.collect()) == sorted([("c", i + 9) for i in range(1, 41)] + [("", 0)] * 40 + [("c", i + 2) for i in range(1, 41)])


def test_evidence_counts_copies_without_their_fragments(spark):
    hits = _hits(spark)
    made = evidence.family_evidence(hits)
    assert "collect_list" not in made._jdf.queryExecution().optimizedPlan().toString()
    merged = copies.merge_copies(hits).groupBy("tool", "family").count()
    assert {(r.tool, r.family): r.n_copies for r in copies.copy_counts(hits).collect()} == {(r.tool, r.family): r["count"] for r in merged.collect()}
