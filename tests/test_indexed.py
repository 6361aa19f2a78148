"""Sequences by index against plain slicing: made in many splits, read by byte ranges, fetched from blocks."""

import numpy as np
import pytest

from spanforge.operators import readback
from spanforge.sources import indexed

SEQS = {"one": "ACGTACGTAC", "empty": "", "long": "".join("ACGTN"[i * i % 5] for i in range(1000)), "two": "GG", "last": "ACGTACG"}


def fasta(seqs, width, end="\n", final=True):
    lines = []
    for name, seq in seqs.items():
        lines += [f">{name} some words", *(seq[i : i + width] for i in range(0, len(seq), width))]
    return end.join(lines) + (end if final else "")


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "37")
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


@pytest.mark.parametrize(("width", "end", "final"), [(7, "\n", True), (60, "\r\n", True), (5, "\n", False)])
def test_index_over_splits_and_blocks(spark, tmp_path, small_splits, width, end, final):
    place = tmp_path / "fasta"
    place.mkdir()
    names = list(SEQS)
    (place / "a.fa").write_bytes(fasta({n: SEQS[n] for n in names[:3]}, width, end, final).encode())
    (place / "b.fa").write_bytes(fasta({n: SEQS[n] for n in names[3:]}, width, end, final).encode())
    made = indexed.fasta_index(spark, str(place))
    got = {r["name"]: r for r in made.collect()}
    assert {n: r["length"] for n, r in got.items()} == {n: len(s) for n, s in SEQS.items()}
    for n, r in got.items():
        raw = (place / ("a.fa" if n in names[:3] else "b.fa")).read_bytes()
        assert not SEQS[n] or raw[r["offset"] :].startswith(SEQS[n][:width].encode())
        assert len(SEQS[n]) < width or (r["line_bases"], r["line_width"]) == (width, width + len(end))
    index = indexed.write_index(made, str(tmp_path / "index"))
    blocks = indexed.read_blocks(spark, index, block=64)
    parts: dict = {}
    for r in blocks.collect():
        assert len(r["seq"]) <= 64
        parts.setdefault(r["chrom"], {})[r["block"]] = r["seq"]
    assert {n: "".join(p[i] for i in sorted(p)) for n, p in parts.items()} == SEQS
    # only the blocks that regions touch
    some = indexed.read_blocks(spark, index, [("long", 130, 200), ("long", 190, 260), ("two", 5, 9), ("one", -4, 3)], block=64)
    assert sorted((r["chrom"], r["block"]) for r in some.collect()) == [("long", 2), ("long", 3), ("long", 4), ("one", 0)]
    assert indexed.read_blocks(spark, index, [], block=64).count() == 0


def test_tasks_are_planned_from_the_index(tmp_path):
    (tmp_path / "index").write_text(f"f\tbig\t{200 * indexed.BLOCK}\t5\t60\t61\nf\tsmall\t10\t99\t60\t61\ng\tother\t10\t9\t60\t61\n")
    runs = indexed.FastaReader({"index": str(tmp_path / "index")}).partitions()
    assert [sum(p[-1] - p[-2] for p in r.pieces) for r in runs] == [64, 64, 64, 9, 1]
    assert all(r.file in "fg" for r in runs)


def test_fetch_is_slicing(spark):
    rng = np.random.default_rng(1)
    blocks = indexed.cut_blocks(spark.createDataFrame(list(SEQS.items()), "chrom string, seq string"), 16)
    rows = [(str(rng.choice([*SEQS, "none"])), int(s), int(s + n), i) for i, (s, n) in enumerate(zip(rng.integers(-30, 1010, 300), rng.integers(-5, 90, 300), strict=True))]
    rows += [("one", None, 5, 900), (None, 1, 5, 901), *rows[:5]]
    got = sorted(((r["chrom"], r["start"], r["end"], r["id"], r["seq"]) for r in indexed.fetch(spark.createDataFrame(rows, "chrom string, start long, end long, id long"), blocks, 16).collect()), key=str)
    plain = lambda c, s, e: None if c not in SEQS else "" if s is None or e <= max(s, 0) else SEQS[c][max(s, 0) : e]
    assert got == sorted(((c, s, e, i, plain(c, s, e)) for c, s, e, i in rows), key=str)


def test_rows_are_verified_against_blocks(spark):
    blocks = indexed.cut_blocks(spark.createDataFrame(list(SEQS.items()), "chrom string, seq string"), 16)
    long = SEQS["long"]
    turned = long[40:80][::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("ok", "long", 10, 60, "+", long[10:60].lower()), ("gaps", "long", 10, 20, "+", "--" + long[10:15] + "." + long[15:20]), ("minus", "long", 40, 80, "-", turned), ("wrong", "long", 40, 80, "+", turned),
            ("absent", "zz", 1, 5, "+", "ACGT"), ("nowhere", "long", None, 5, "+", "ACGT"), ("beyond", "long", 990, 1010, "+", long[990:]), ("bare", "long", 5, 9, "+", None)]
    checked = readback.verify_rows(spark.createDataFrame(rows, "row_id string, chrom string, start long, end long, strand string, seq string"), blocks, 16)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = {r["row_id"]: r["reason"] for r in checked.collect()}
    assert got == {"ok": None, "gaps": None, "minus": None, "beyond": None, "wrong": "sequence_mismatch", "absent": "chrom_absent", "nowhere": "no_place", "bare": "sequence_mismatch"}
    assert [r["row_id"] for r in readback.failures(checked, 2).collect()] == ["absent", "bare"]
    assert readback.verification(checked).head()["n_bad"] == 4


def test_flanks_from_blocks(spark):
    blocks = indexed.cut_blocks(spark.createDataFrame(list(SEQS.items()), "chrom string, seq string"), 16)
    sizes = spark.createDataFrame([(n, len(s)) for n, s in SEQS.items()], "chrom string, size long")
    long = SEQS["long"]
    rows = spark.createDataFrame([(1, "long", 5, 60, "+"), (2, "long", 900, 990, "-"), (3, "zz", 1, 2, "+")], "row long, chrom string, start long, end long, strand string")
    got = {r["row"]: r for r in readback.with_flanks(rows, blocks, sizes, 20, 16).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["seq"], got[1]["flanked"], got[1]["flank_left"], got[1]["flank_right"]) == (long[5:60], long[:80], 5, 20)
    assert (got[2]["flank_left"], got[2]["flank_right"], got[2]["length"]) == (10, 20, 120)
    # sizes that don't fit the genome are found out
    with pytest.raises(Exception, match="flank accounting"):
        readback.with_flanks(rows, blocks, sizes.withColumn("size", sizes["size"] + 50), 20, 16).collect()
