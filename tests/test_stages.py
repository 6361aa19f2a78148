"""The staged runner: runs that end early, finished clusters, selection, settings, class lookup."""

import subprocess
import sys
from pathlib import Path

import pytest

from spanforge.operators import linkage
from spanforge.plans import stages
from spanforge.settings import Settings
from spanforge.sources.store import read_or_none

ROOT = Path(__file__).resolve().parent.parent
HIT = "tool string, family string, chrom string, s long, e long, strand string, div double, ord long, cons_start long, cons_end long, cons_len long, hit_id string"


@pytest.fixture(scope="module")
def hits(spark):
    """Five families of two tools each that lie on one another, and one that is alone."""
    rows = [(tool, f"f{i}", f"c{i}", 3000 * j, 3000 * j + 900 + 10 * k, "+", 2.0, 100 * i + j, 1, 890, 900, None) for i in range(5) for k, tool in enumerate("tu") for j in range(6)]
    return spark.createDataFrame([*rows, ("t", "alone", "z", 0, 900, "+", 2.0, 999, None, None, None, None)], HIT).cache()


def rows_of(df):
    return sorted(map(str, df.select(stages.COPIES).collect()))


EVERY = Settings(min_gates=0)


def test_a_killed_run_goes_on_where_it_stopped(spark, tmp_path, hits, monkeypatch):
    work, whole = str(tmp_path / "work"), str(tmp_path / "whole")
    candidates = stages.stage0(spark, hits, work, settings=EVERY)
    assert candidates.filter("candidate AND n_tools = 2 AND pooled_full_len = 12").count() == 5
    real, calls = stages.cluster_copies, []

    def killed(*given):
        calls.append(given[3].count())
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(*given)

    with monkeypatch.context() as m:
        m.setattr(stages, "cluster_copies", killed)
        with pytest.raises(KeyboardInterrupt):
            stages.stage1(spark, hits, work, stages.chosen(candidates), EVERY, batch=2)
    done = read_or_none(spark, f"{work}/finished")
    assert done.count() == 2
    with monkeypatch.context() as m:
        m.setattr(stages, "cluster_copies", lambda *given: calls.append(given[3].count()) or real(*given))
        got = stages.stage1(spark, hits, work, stages.chosen(candidates), EVERY, skip_existing=True, batch=2)
    assert calls == [2, 2, 2, 1]
    kept = rows_of(got)
    assert {(r["mode"], r["n_fragments"]) for r in got.collect()} == {("merge_always", 6), ("gap_aware", 6)}
    stages.stage0(spark, hits, whole, settings=EVERY)
    assert kept == rows_of(stages.stage1(spark, hits, whole, stages.chosen(candidates), EVERY))
    # nothing is left, and a run without skipping replaces and doubles nothing
    assert rows_of(stages.stage1(spark, hits, work, stages.chosen(candidates), EVERY, skip_existing=True)) == kept
    assert rows_of(stages.stage1(spark, hits, work, stages.chosen(candidates, top=1), EVERY)) == kept


def test_selection_of_clusters(spark, tmp_path, hits):
    work = str(tmp_path / "work")
    candidates = stages.stage0(spark, hits, work, settings=EVERY, mode="lenient")
    keys = sorted(r["cluster_key"] for r in candidates.collect())
    assert len(keys) == 5
    assert [r["cluster_key"] for r in stages.chosen(candidates, keys=[keys[2], "none"]).collect()] == [keys[2]]
    assert stages.chosen(candidates, names=spark.createDataFrame([(keys[0],), (keys[4],)], "cluster_key string")).count() == 2
    # without a class map no cluster passes all gates
    assert stages.stage0(spark, hits, work).filter("candidate").count() == 0
    mapped = spark.createDataFrame([(f"F{i}", "t" if i == 1 else None, "repeat:TE:ClassI:LTR") for i in range(5)], "label string, tool string, path string")
    assert stages.stage0(spark, hits, work, mapped, Settings(min_gates=6, min_deep=0.5)).filter("candidate AND winner = 'repeat:TE:ClassI:LTR'").count() == 5


def test_class_paths_fall_back_to_general_entries(spark):
    mapped = spark.createDataFrame([("L1", "t", "own"), ("L1", "t", "other"), ("l1", None, "general"), ("L2", "", "blank is general"), ("L3", "u", "of another tool")], "label string, tool string, path string")
    rows = spark.createDataFrame([(1, "t", "l1"), (2, "u", "L1"), (3, "t", "L2"), (4, "t", "L3"), (5, None, "L1"), (6, "t", None)], "id int, tool string, family string")
    got = {r["id"]: r["path"] for r in linkage.class_paths(rows, "family", mapped).collect()}
    assert got == {1: "other", 2: "general", 3: "blank is general", 4: None, 5: "general", 6: None}


@pytest.mark.parametrize(("text", "says"), [('{"min_joint": -1}', "min_joint"), ('{"veto": 1.5}', "veto"), ('{"min_tools": 2.5}', "min_tools"), ('{"vetos": 0.5}', "no such settings: vetos"), ('{"cap_ratio": 0.5}', "cap_ratio"), ('{"min_full": true}', "min_full")])
def test_settings_are_checked(text, says):
    with pytest.raises(ValueError, match=says):
        Settings.from_json(text)
    assert Settings.from_json('{"min_joint": 100, "veto": 0.25}') == Settings(min_joint=100, veto=0.25)


def test_command_line_of_stages(spark, tmp_path, hits):
    hits.coalesce(1).write.parquet(str(tmp_path / "hits"))
    (tmp_path / "s.json").write_text('{"min_gates": 0}')
    common = ["--hits", str(tmp_path / "hits"), "--work", str(tmp_path / "work"), "--settings", str(tmp_path / "s.json")]
    for stage, more in (("stage0", []), ("stage1", ["--top", "2", "--skip-existing"])):
        done = subprocess.run([sys.executable, "-m", "spanforge", stage, *common, *more], cwd=ROOT, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
    assert spark.read.parquet(str(tmp_path / "work" / "copies")).select("cluster_key").distinct().count() == 2
