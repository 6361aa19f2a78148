"""What the review of round 3 found: whole jobs, and steps that must not grow faster than the input."""

from random import Random
from statistics import median

from pyspark.sql import functions as F

from spanforge.operators import copies, overassembly, sequences
from spanforge.plans import registry_rules, stages
from spanforge.settings import Settings
from spanforge.sources.hits import letters_of

HIT = "tool string, family string, chrom string, s long, e long, strand string, div double, ord long, cons_start long, cons_end long, cons_len long, hit_id string"


def test_stages_without_clusters_give_an_empty_table(spark, tmp_path):
    hits = spark.createDataFrame([(tool, "f", tool, 0, 900, "+", 2.0, 1, 1, 890, 900, None) for tool in "tu"], HIT)
    candidates = stages.stage0(spark, hits, str(tmp_path), settings=Settings(min_gates=0))
    got = stages.stage1(spark, hits, str(tmp_path), stages.chosen(candidates, top=2))
    assert got.columns == stages.COPIES and got.isEmpty()


def test_quota_query_takes_from_all_parts(spark, tmp_path):
    rows = [(i, 7 * (i % 5), "o", 1.0) for i in range(50)]
    spark.createDataFrame(rows, "p_partkey long, p_size int, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    depths = {r.cluster_id: r.path_depth for r in registry_rules.quota_selection(spark, str(tmp_path)).collect()}
    # all ten of depth 3, 0.45 of depth 4, all others
    assert len(depths) == 10 + 4 + 30 and sum(d == 3 for d in depths.values()) == 10


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


PHASES = "tool string, family string, repeat_start long, repeat_end long, repeat_left long, hit_len long"


def test_families_are_counted_by_places(spark):
    """Hits at the same places add to counts and no rows: what is laid out by factor doesn't grow with them."""
    rows = [("t", "f", 1 + 7 * i % 300, 1 + 7 * i % 300 + 100, 299 - 7 * i % 300, 100) for i in range(60)]
    one, many = (spark.createDataFrame(rows * n, PHASES) for n in (1, 5))
    assert overassembly.measured(one).count() == overassembly.measured(many).count()
    figures = [overassembly.family_records(x).select("cons_len", "median_len", "p90_len", "full_span_frac", "best_enrich_any_k", "reason").first() for x in (one, many)]
    assert figures[0] == figures[1]


def test_mates_are_met_by_length(spark):
    lengths = [("k", f"m{i % 9}", 100 * (1 + i * i % 7), i % 5 == 0) for i in range(14)]
    df = spark.createDataFrame([*lengths, ("k", "none", None, False), ("alone", "m", 5, False)], "cluster_key string, member string, cons_len int, protected boolean")
    made = copies.deconvolve(df)
    assert "<>" not in _plan(made) and "NOT (member" not in _plan(made)
    got = {r.member: r for r in made.collect()}
    assert set(got) == {f"m{i}" for i in range(9)}
    for name in ("m5", "m6", "m7", "m8"):  # members of one length
        own = next(x for _, m, x, _ in lengths if m == name)
        protected = next(p for _, m, _, p in lengths if m == name)
        others = [x for _, m, x, _ in lengths if m != name]
        mate = median(others)
        near = [x for x in others if mate / 1.3 <= x <= mate * 1.3]
        low = own / mate < 1.8
        agreed = len(near) >= 2 and len(near) >= 0.5 * len(others)
        want = "keep" if low else "abstain" if protected or not agreed else "deconvolve" if own / median(near) >= 1.8 else "keep"
        assert (got[name].verdict, got[name].cons_len) == (want, float(median(near)) if want == "deconvolve" else float(own))


def test_samples_are_ranked_before_the_shuffle(spark):
    rows = spark.createDataFrame([("k", i, i % 3 == 0, 1, 10 * (i % 9), 100) for i in range(90)], "key string, row long, is_full boolean, cons_start int, cons_end int, cons_len int")
    made = copies.stratified_sample(rows, "key", 10, 3, 0.5, F.expr("(row * 7) % 13"))
    assert "WindowGroupLimit" in _plan(made) and made.count() == 10


def test_gap_covers_are_swept(spark):
    """Covers of random gaps against sets of bases; no pairs of gaps and hits are planned."""
    r = Random(3)
    spot = lambda: (s := r.randrange(60_000), s + r.randrange(1, 9_000))
    hits = [(f"c{r.randrange(5)}", f"chr{r.randrange(2)}", *spot()) for _ in range(60)]
    gaps = [(f"c{r.randrange(7)}", f"chr{r.randrange(2)}", *spot()) for _ in range(40)]
    schema = "cluster string, chrom string, s long, e long"
    made = copies.foreign_cover(spark.createDataFrame(gaps + gaps[:5], schema), spark.createDataFrame(hits, schema))
    assert "Join" not in _plan(made)
    got = {tuple(x)[:4]: x.covered for x in made.collect()}
    for gap in gaps:
        own = set(range(gap[2], gap[3]))
        covered = set().union(*(own & set(range(s, e)) for c, chrom, s, e in hits if chrom == gap[1] and c != gap[0]))
        assert got.get(gap, 0.0) == len(covered) / len(own)


def test_alignments_are_read_once(spark):
    rows = spark.createDataFrame([(7, "1", "-aC.~"), (7, "1", "ggé------"), (7, "2", None), (8, "3", "..")], "aln_id int, row_id string, seq string")
    made = sequences.row_occupancy(rows)
    assert "MapInArrow" not in _plan(made)
    old = sequences.occupancy(sequences.alignment_cells(rows))
    assert sorted(map(tuple, made.select(old.columns).collect())) == sorted(map(tuple, old.collect()))


def test_letters_by_byte(spark):
    texts = ["aZ-é .\n", "日本\U0001f600b", "", None, "0z?"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", letters_of(F.col("text"), {"a": "A", "b": "C", "z": "N", "Z": "R"}).alias("x"))
    assert "UDF" in _plan(got)
    assert {r.i: r.x for r in got.collect()} == {0: "ARN", 1: "NNNC", 2: "", 3: None, 4: "N"}
