"""The jobs on growing copies of the tables: two runs, runs without news, runs that ended early."""

import json
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from jobs import annotation_store, sequence_intake
from spanforge.operators import evidence
from spanforge.sources import store as stored

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture()
def lines(spark, tmp_path):
    """A folder with the first orders, and a function that adds the others."""
    every = spark.read.parquet(f"{SF}/lineitem.parquet")
    source = str(tmp_path / "lineitem.parquet")
    every.filter("l_orderkey <= 700").write.parquet(source)
    return source, lambda: every.filter("l_orderkey > 700").write.mode("append").parquet(source)


def test_annotations_are_taken_once(spark, tmp_path, lines):
    source, grow = lines
    store = str(tmp_path / "store")
    first = rows_of(annotation_store.run(spark, source, store))
    assert rows_of(annotation_store.run(spark, source, store)) == first and len(stored.marks(spark, store)) == 1
    grow()
    second = rows_of(annotation_store.run(spark, source, store))
    assert second != first and second == rows_of(annotation_store.run(spark, source, str(tmp_path / "whole")))
    one, two = stored.marks(spark, store)
    assert (one["batch"], one["low"], one["high"], two["batch"], two["low"]) == (0, None, 700, 1, 700)
    n = spark.read.parquet(source).count()
    assert one["n_new"] + two["n_new"] == n and stored.read_hits(spark, store).count() == n
    with pytest.raises(ValueError, match="16 buckets"):
        annotation_store.run(spark, source, store, buckets=8)


@pytest.mark.parametrize("step", ["write_mark", "_renew"])
def test_a_run_that_ends_early_is_made_good(spark, tmp_path, lines, monkeypatch, step):
    source, grow = lines
    store = str(tmp_path / "store")

    def fail(*_):
        raise RuntimeError("lost")

    where = stored if step == "write_mark" else annotation_store
    with monkeypatch.context() as m:
        m.setattr(where, step, fail)
        with pytest.raises(RuntimeError):
            annotation_store.run(spark, source, store)
    # the source has grown since
    grow()
    assert rows_of(annotation_store.run(spark, source, store)) == rows_of(annotation_store.run(spark, source, str(tmp_path / "whole")))
    assert stored.read_hits(spark, store).count() == spark.read.parquet(source).count()


def test_a_family_is_read_from_its_bucket_alone(spark, tmp_path, lines):
    source, _ = lines
    store = str(tmp_path / "store")
    annotation_store.run(spark, source, store, buckets=4)
    family = stored.read_family(spark, store, "A", "F7")
    bucket = spark.range(1).select(stored.bucket_of(F.lit("F7"), 4)).first()[0]
    plan = family._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert re.search(r"\(tool#\d+ = A\)", read) and re.search(rf"\(bucket#\d+ = {bucket}\)", read)
    assert family.count() == spark.read.parquet(source).filter("l_returnflag = 'A' AND l_suppkey % 20 = 7").count() > 0
    assert family.filter("hit_len <> e - s").count() == 0
    assert "EqualTo(family,F7)" in plan


def test_empty_source_of_annotations(spark, tmp_path):
    source = str(tmp_path / "none")
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(0).write.parquet(source)
    assert annotation_store.run(spark, source, str(tmp_path / "store")) is None


HIT = "tool string, family string, chrom string, s long, e long, strand string, ord long, div double, cons_start long, cons_end long, cons_len long"


def test_evidence_of_families(spark):
    rows = [("t", "f", "c", 0, 100, "+", 1, 2.0, 1, 50, 100), ("t", "f", "c", 50, 150, "+", 2, 4.0, 30, 100, 100), ("t", "f", "c", 400, 500, "+", 3, None, 1, 100, 100), ("t", "f", "d", 10, 20, "-", 4, 6.0, 41, 60, 90), ("t", "f", "d", 30, 30, "-", 5, 6.0, None, None, None),
            ("t", "bare", "c", 5, 9, ".", 6, None, None, None, None), ("t", "long", "c", 5, 9, "+", 7, 1.0, 1, 300, 100), ("t", "long", "c", 6, 9, "+", 8, 1.0, 0, 300, 100), ("t", "long", "c", 7, 9, "+", 9, 1.0, 95, 300, 100)]
    got = {r["family"]: r for r in evidence.family_evidence(spark.createDataFrame(rows, HIT)).collect()}
    f = got["f"]
    places = [sum(a <= p <= b for *_, a, b, _ in rows[:4]) for p in range(1, 101)]
    assert (f["n_hits"], f["n_copies"], f["n_full_len"], f["genomic_bp"], f["modal_len"], f["div_median"]) == (5, 3, 1, 260, 100, 5.0)
    assert f["cov_ge3_frac"] == pytest.approx(sum(p >= 3 for p in places) / 100)
    assert (got["bare"]["modal_len"], got["bare"]["cov_ge3_frac"], got["bare"]["div_median"], got["bare"]["genomic_bp"]) == (None, None, None, 4)
    # what lies beyond the length isn't counted
    assert got["long"]["cov_ge3_frac"] == 0.06
    assert evidence.family_evidence(spark.createDataFrame([], HIT)).count() == 0


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def texts(spark, path, rows):
    spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOC).coalesce(1).write.mode("append").parquet(path)


FIRST = [(1, "aabbccdd", "a"), (2, "AABBCCDD", "b"), (3, None, "a"), (4, "", "a"), (5, "é1 Zz", "a")]
SECOND = [(0, "hhggffee", "c"), (6, "a-a-b-b c.c.d.d", "a"), (7, "new text", None), (7, "new text", None)]


def test_sequences_are_taken_once(spark, tmp_path):
    source, output = str(tmp_path / "docs"), str(tmp_path / "out")
    texts(spark, source, FIRST)
    got = {r["doc_id"]: r for r in sequence_intake.run(spark, source, output).collect()}
    assert (got[1]["length"], got[1]["n_count"], got[1]["gc_count"], got[1]["n_copies"], got[1]["first_id"], got[1]["n_sources"]) == (8, 0, 4, 2, 1, 2)
    assert got[3]["digest"] == got[4]["digest"] and got[3]["length"] == 0 and (got[5]["length"], got[5]["n_count"]) == (3, 3)
    same = rows_of(sequence_intake.read(spark, output))
    assert rows_of(sequence_intake.run(spark, source, output)) == same
    texts(spark, source, SECOND)
    rows = sequence_intake.run(spark, source, output).collect()
    assert len(rows) == len(FIRST) + len(SECOND)
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["n_copies"] == got[6]["n_copies"] == 3 and got[2]["first_id"] == 1 and got[7]["n_copies"] == 2 and got[7]["n_sources"] == 0
    # one run over all gives the same
    assert rows_of(sequence_intake.run(spark, source, str(tmp_path / "whole"))) == rows_of(sequence_intake.read(spark, output))


def test_a_reverse_complement_is_a_copy(spark, tmp_path):
    source, output = str(tmp_path / "docs"), str(tmp_path / "out")
    # a, c, g and t stand for A, G, C and T here: aacc and the complement of its reverse
    texts(spark, source, [(1, "aabd", "a"), (2, "acdd", "a")])
    got = {r["doc_id"]: r for r in sequence_intake.run(spark, source, output).collect()}
    assert got[1]["digest"] == got[2]["digest"] and got[1]["n_copies"] == 2


def test_a_batch_that_fails_is_taken_again(spark, tmp_path, monkeypatch):
    source, output = str(tmp_path / "docs"), str(tmp_path / "out")
    texts(spark, source, FIRST)
    sequence_intake.run(spark, source, output)
    texts(spark, source, SECOND)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        # after the measures are written
        m.setattr(sequence_intake, "read_or_none", fail)
        with pytest.raises(StreamingQueryException):
            sequence_intake.run(spark, source, output)
    assert spark.read.parquet(f"{output}/measures").count() == len(FIRST) + len(SECOND)
    assert rows_of(sequence_intake.run(spark, source, output)) == rows_of(sequence_intake.run(spark, source, str(tmp_path / "whole")))


def test_several_batches_give_the_same(spark, tmp_path):
    source = str(tmp_path / "docs")
    texts(spark, source, FIRST)
    texts(spark, source, SECOND)
    assert rows_of(sequence_intake.run(spark, source, str(tmp_path / "one"), max_files=1)) == rows_of(sequence_intake.run(spark, source, str(tmp_path / "all")))


def test_no_sequences(spark, tmp_path):
    source = str(tmp_path / "docs")
    spark.createDataFrame([], DOC).write.parquet(source)
    assert sequence_intake.run(spark, source, str(tmp_path / "out")) is None


@pytest.mark.parametrize(("job", "table", "place", "made"), [("annotation_store", "lineitem", "store", "evidence"), ("sequence_intake", "documents", "output", "copies")])
def test_command_line(spark, tmp_path, job, table, place, made):
    config = json.loads((ROOT / f"jobs/{job}.json").read_text()) | {"source": f"{SF}/{table}.parquet"}
    (tmp_path / "config.json").write_text(json.dumps(config))
    done = subprocess.run([sys.executable, "-m", f"jobs.{job}", str(tmp_path / "config.json"), f"--{place}", str(tmp_path / "out")], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert re.search(r"read .*new rows", done.stderr) and re.search(r"wrote \d+", done.stderr)
    assert spark.read.parquet(str(tmp_path / "out" / made)).count() > 0


def test_jobs_use_nothing_of_the_training_package():
    for path in (ROOT / "jobs").glob("*.py"):
        assert not re.search(r"\bllm\b|corpus_pipeline", path.read_text())
