"""Every registered query with SQL against DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from spanforge.operators import copies
from spanforge.plans import registry, registry_more, registry_rules  # noqa: F401
from spanforge.sources.hits import demo_hits

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rel = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert sorted(repr(tuple(norm(r[c]) for c in columns)) for r in df.collect()) == sorted(repr(tuple(norm(r[i]) for i in at)) for r in rel.fetchall())


def test_queries_without_sql():
    """Each is held against a plain version elsewhere in these tests."""
    assert set(registry.QUERIES) - set(registry.ORACLE_SQL) == {"lenient_linkage", "msa_finalize"}


def test_widest_gap_query_against_plain_splits(spark):
    made = copies.merge_copies(demo_hits(spark, SF)).collect()
    want = []
    for r in made:
        pieces, todo = [], [[(f.start, f.end) for f in r.fragments]]
        while todo:
            part = todo.pop()
            span, last = max(e for _, e in part) - part[0][0], len(part)
            if r.cons_len is None or span <= 1.5 * r.cons_len or last == 1:
                pieces.append((part[0][0], max(e for _, e in part), last))
                continue
            at = max(range(1, last), key=lambda i: (part[i][0] - part[i - 1][1], -i))
            todo += [part[:at], part[at:]]
        want += [(r.tool, r.family, r.chrom, *p) for p in pieces]
    got = [(r.tool, r.family, r.chrom, r.start, r.end, r.n_fragments) for r in registry.QUERIES["cap_widest_gap"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_lenient_linkage_query_against_plain_components(spark):
    """Parts are within components, whole where dense enough, and each part's weakest edges part it from the rest."""
    edges = [(r.a, r.b, r.w_bp) for r in registry._edges(spark, SF).collect()]
    near = {}
    for a, b, _ in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def reach(members, links):
        left, out = set(members), []
        while left:
            todo, seen = [next(iter(left))], set()
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += [y for a, b, _ in links for x0, y in ((a, b), (b, a)) if x0 == x]
            out.append(seen)
            left -= seen
        return out

    def split(members, depth):
        inside = sorted((w, a, b) for a, b, w in edges if a in members and b in members)
        n = len(members)
        if n == 2 or depth > 12 or len(inside) / (n * (n - 1) / 2) >= 0.5:
            return [members]
        for i in range(1, len(inside) + 1):
            parts = reach(members, [(a, b, w) for w, a, b in inside[i:]])
            if len(parts) > 1:
                return [q for p in parts if len(p) > 1 for q in split(p, depth + 1)]
        return [members]

    want = sorted(sorted(p) for c in reach(near, edges) for p in split(c, 0))
    got = {}
    for r in registry.QUERIES["lenient_linkage"](spark, SF).collect():
        got.setdefault(r.cluster_key, []).append(r.member)
    assert sorted(map(sorted, got.values())) == want


def test_entry(spark):
    assert entry.entry(spark).columns == ["a", "b", "joint_bp", "w_bp"]
