"""Queries by name on the shared tables, and the same in SQL.

The tables hold no genomes, so each operator runs on a view of the shape it asks for: order lines
as hits of three tools, documents as sequences, and so on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators import analysis, copies, intervals, linkage, sequences
from spanforge.session import cut, table
from spanforge.sources.hits import DEMO_SQL, demo_hits

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# Views -----------------------------------------------------------------------------------------

PAINT_SQL = DEMO_SQL + """,
points AS (SELECT DISTINCT tool, chrom, s AS x FROM hits UNION SELECT DISTINCT tool, chrom, e FROM hits),
cells AS (SELECT tool, chrom, x AS s, lead(x) OVER (PARTITION BY tool, chrom ORDER BY x) AS e FROM points),
hit_bins AS (SELECT tool, chrom, s, e, family, ord, unnest(range(s // 512, (e - 1) // 512 + 1)) AS bin FROM hits),
painted AS (
  SELECT c.tool, c.chrom, c.s, c.e, arg_max(h.family, h.ord) AS family
  FROM cells c JOIN hit_bins h ON h.tool = c.tool AND h.chrom = c.chrom AND h.bin = c.s // 512 AND h.s <= c.s AND h.e >= c.e
  GROUP BY c.tool, c.chrom, c.s, c.e)"""

EDGE_SQL = PAINT_SQL + """,
footprints AS (SELECT tool, family, CAST(sum(e - s) AS BIGINT) AS footprint FROM painted GROUP BY tool, family),
paint_bins AS (SELECT *, unnest(range(s // 512, (e - 1) // 512 + 1)) AS bin FROM painted),
joint AS (
  SELECT a.tool AS tool_a, a.family AS family_a, b.tool AS tool_b, b.family AS family_b, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s)) AS BIGINT) AS joint_bp
  FROM paint_bins a JOIN paint_bins b ON a.chrom = b.chrom AND a.bin = b.bin AND a.tool < b.tool AND a.s < b.e AND b.s < a.e AND a.bin = greatest(a.s // 512, b.s // 512)
  GROUP BY ALL),
edges AS (
  SELECT tool_a || ':' || family_a AS a, tool_b || ':' || family_b AS b, joint_bp, joint_bp / CAST(least(x.footprint, y.footprint) AS DOUBLE) AS w_bp
  FROM joint JOIN footprints x ON x.tool = tool_a AND x.family = family_a JOIN footprints y ON y.tool = tool_b AND y.family = family_b
  WHERE joint_bp >= 100 AND joint_bp >= 0.03 * least(x.footprint, y.footprint))"""

BEST_SQL = EDGE_SQL + """,
ways AS (SELECT a, b, w_bp FROM edges UNION ALL SELECT b, a, w_bp FROM edges),
best AS (SELECT a, b FROM (SELECT *, row_number() OVER (PARTITION BY a, split_part(b, ':', 1) ORDER BY w_bp DESC, b) AS r FROM ways) WHERE r = 1),
mutual AS (SELECT a, b FROM best WHERE a < b AND EXISTS (SELECT 1 FROM best o WHERE o.a = best.b AND o.b = best.a)),
links AS (SELECT a, b FROM mutual UNION SELECT b, a FROM mutual),
reach AS (SELECT a AS node, a AS root FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
parts AS (SELECT node, min(root) AS component FROM reach GROUP BY node),
grouped AS (SELECT component, list_sort(list(node)) AS members FROM parts GROUP BY component),
clusters AS (
  SELECT CAST(row_number() OVER (ORDER BY len(members), array_to_string(members, ';')) - 1 AS INTEGER) AS cluster_id,
         substr(sha1(array_to_string(members, ';')), 1, 10) AS cluster_key, CAST(len(members) AS INTEGER) AS n_members, unnest(members) AS member
  FROM grouped)"""

EVIDENCE_SQL = """,
evidence AS (
  SELECT tool, family, tool || ':' || family AS member, CAST(count(*) FILTER (e - s >= 490) AS DOUBLE) AS n_full_len, CAST(sum(e - s) AS DOUBLE) AS genomic_bp,
         CASE WHEN family IN ('F3', 'F6', 'F9') THEN 1.0 ELSE 0.5 END AS cov, median(div) * 4 AS div_median, CASE WHEN family IN ('F7', 'F8', 'F14') THEN NULL ELSE avg(CASE WHEN strand = '-' THEN 0.5 ELSE 0.0 END) END AS frac_tandem,
         CASE WHEN family IN ('F1', 'F2') THEN 'repeat' WHEN family = 'F5' THEN NULL WHEN CAST(substr(family, 2) AS INTEGER) % 2 = 0 THEN 'LTR' ELSE 'TIR' END AS vote
  FROM hits GROUP BY tool, family),
few AS (SELECT 'k' || (CAST(substr(family, 2) AS INTEGER) % 6) AS cluster_key, * FROM evidence)"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.edges(demo_hits(spark, sf_dir), 100, 0.03)


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr("CAST(substr(family, 2) AS INT)")
    vote = F.when(F.col("family").isin("F1", "F2"), "repeat").when(F.col("family") == "F5", None).when(number % 2 == 0, "LTR").otherwise("TIR")
    rows = demo_hits(spark, sf_dir).groupBy("tool", "family").agg(
        F.count_if(F.expr("e - s >= 490")).cast("double").alias("n_full_len"), F.sum(F.expr("e - s")).cast("double").alias("genomic_bp"),
        (F.median("div") * 4).alias("div_median"), F.avg(F.when(F.col("strand") == "-", 0.5).otherwise(0.0)).alias("frac_tandem"),
    )
    cov = F.when(F.col("family").isin("F3", "F6", "F9"), 1.0).otherwise(0.5)
    rows = rows.withColumn("frac_tandem", F.when(~F.col("family").isin("F7", "F8", "F14"), F.col("frac_tandem")))
    return rows.withColumn("member", F.concat_ws(":", "tool", "family")).withColumn("cov", cov).withColumn("vote", vote).withColumn("cluster_key", F.concat(F.lit("k"), number % 6))


# Coverage, edges, linkage ------------------------------------------------------------------------


@query("WITH " + PAINT_SQL + " SELECT tool, family, CAST(sum(e - s) AS BIGINT) AS footprint FROM painted GROUP BY tool, family")
def paint_footprint(spark, sf_dir):
    return linkage.footprints(intervals.paint(demo_hits(spark, sf_dir), ["tool", "chrom"], "family", F.col("ord")))


@query("WITH " + EDGE_SQL + " SELECT a, b, joint_bp, round(w_bp, 6) AS w_bp FROM edges")
def joint_bp_edges(spark, sf_dir):
    return _edges(spark, sf_dir).withColumn("w_bp", F.round("w_bp", 6))


@query("WITH " + PAINT_SQL + """,
mids AS (SELECT tool, family, chrom, (s + e) // 2 AS mid FROM hits),
bins AS (SELECT *, unnest(range(s // 512, (e - 1) // 512 + 1)) AS bin FROM painted),
inside AS (
  SELECT m.tool, m.family, p.tool AS other_tool, p.family AS other_family, count(*) AS n_inside
  FROM mids m JOIN bins p ON p.chrom = m.chrom AND p.bin = m.mid // 512 AND p.s <= m.mid AND m.mid < p.e AND p.tool <> m.tool GROUP BY ALL),
total AS (SELECT tool, family, count(*) AS n_copies FROM hits GROUP BY ALL)
SELECT tool, family, other_tool, other_family, n_inside, n_copies, round(n_inside / n_copies, 6) AS fraction FROM inside JOIN total USING (tool, family)""")
def midpoint_coannotation(spark, sf_dir):
    return linkage.coannotation(demo_hits(spark, sf_dir)).withColumn("fraction", F.round("fraction", 6))


#: Tools by scope; one of them has no hits, and one no scope that is clustered.
MANIFEST = [("A", "general_homology"), ("N", "ltr_only"), ("R", "masking"), ("Z", "structural_te")]


@query("WITH " + DEMO_SQL + f""",
manifest(tool, scope) AS (VALUES {", ".join(map(str, MANIFEST))}),
status AS (
  SELECT tool, count(*) AS n_hits, count(DISTINCT family) AS n_names, round(avg(CASE WHEN cons_start IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS coord_fraction,
         count(DISTINCT family) = count(*) AND count(*) > 100 AS per_copy_ids, count(DISTINCT family) <= 3 AND count(*) > 1000 AS mask_only FROM hits GROUP BY tool)
SELECT m.tool, scope, n_hits, n_names, coord_fraction, per_copy_ids, mask_only, n_hits IS NOT NULL AS ran,
       coalesce(n_hits > 0 AND NOT per_copy_ids AND NOT mask_only AND scope IN ('general_homology', 'structural_te', 'ltr_only'), false) AS clusterable
FROM manifest m LEFT JOIN status s ON s.tool = m.tool""")
def tool_eligibility(spark, sf_dir):
    manifest = spark.createDataFrame(MANIFEST, "tool string, scope string")
    return linkage.eligible_tools(manifest, linkage.tool_status(demo_hits(spark, sf_dir))).withColumn("coord_fraction", F.round("coord_fraction", 6))


PATH_CASE = "CASE WHEN p_size % 9 = 0 THEN 'repeat:tandem' WHEN p_size % 9 = 4 THEN 'repeat:multigene:' || lower(p_type) WHEN p_size % 9 = 7 THEN 'repeat:artefact' WHEN p_size % 50 = 1 THEN NULL ELSE 'repeat:TE:' || lower(p_type) || CASE WHEN p_size % 2 = 0 THEN ':o' || (p_size % 4) ELSE '' END END"
FAMILY_CASE = "CASE WHEN p_partkey % 13 = 0 THEN '(' || p_brand || ')n' ELSE p_brand END"


@query(f"""
WITH paths AS (SELECT {FAMILY_CASE} AS family, {PATH_CASE} AS path FROM part),
kept AS (SELECT * FROM paths WHERE NOT regexp_matches(coalesce(path, ''), '^repeat:(tandem|multigene|artefact)') AND NOT starts_with(family, '(')),
counted AS (SELECT family, path, count(*) AS n FROM kept WHERE path IS NOT NULL GROUP BY ALL),
modal AS (SELECT family, path FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n DESC, path) AS r FROM counted) WHERE r = 1)
SELECT family, path, coalesce(string_split(path, ':')[4], string_split(path, ':')[2], 'repeat') AS order_name, CAST(len(string_split(path, ':')) AS INTEGER) AS depth FROM modal""")
def modal_class(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(f"{FAMILY_CASE} AS family", f"{PATH_CASE} AS path")
    modal = linkage.repeat_families(rows).groupBy("family").agg(F.mode("path", True).alias("path")).filter("path IS NOT NULL")
    return modal.withColumn("order_name", analysis.path_order(F.col("path"))).withColumn("depth", F.size(F.split("path", ":")))


@query("WITH RECURSIVE " + BEST_SQL + " SELECT cluster_id, cluster_key, n_members, member FROM clusters")
def strict_linkage(spark, sf_dir):
    return linkage.clusters(linkage.mutual_best(_edges(spark, sf_dir)))


@query()
def lenient_linkage(spark, sf_dir):
    return linkage.lenient_clusters(cut(_edges(spark, sf_dir)))


@query("WITH RECURSIVE " + BEST_SQL + """,
sizes AS (SELECT cluster_key, count(*) AS n, CAST(count(DISTINCT CAST(substr(split_part(member, ':', 2), 2) AS INTEGER) % 3) > 1 AS INTEGER) AS mixed FROM clusters GROUP BY cluster_key),
inside AS (SELECT x.cluster_key, count(*) AS m FROM edges JOIN clusters x ON x.member = a JOIN clusters y ON y.member = b AND y.cluster_key = x.cluster_key GROUP BY x.cluster_key)
SELECT count(*) AS n_clusters, CAST(sum(n) AS BIGINT) AS n_members, max(n) AS largest, CAST(floor(quantile_cont(n, 0.99)) AS BIGINT) AS p99,
       round(median(coalesce(m, 0) / (n * (n - 1) / 2)), 6) AS median_density, round(avg(mixed), 6) AS mixed_fraction
FROM sizes LEFT JOIN inside USING (cluster_key)""")
def linkage_diagnostics(spark, sf_dir):
    edges = cut(_edges(spark, sf_dir))
    members = cut(linkage.clusters(linkage.mutual_best(edges)))
    order = members.select("member", F.expr("CAST(substr(split_part(member, ':', 2), 2) AS INT) % 3").cast("string").alias("order_name"))
    return linkage.diagnostics(members, edges, order)


@query("WITH " + DEMO_SQL + EVIDENCE_SQL + """,
cast_votes AS (SELECT cluster_key, vote, sum(coalesce(genomic_bp, 0) + 1) AS w, min(member) AS first FROM few WHERE vote IS NOT NULL AND vote <> 'repeat' GROUP BY ALL),
won AS (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY w DESC, first) AS r, w / sum(w) OVER (PARTITION BY cluster_key) AS share FROM cast_votes)
SELECT k.cluster_key, vote AS winner, round(share, 6) AS share FROM (SELECT DISTINCT cluster_key FROM few) k LEFT JOIN won ON won.cluster_key = k.cluster_key AND r = 1""")
def weighted_vote(spark, sf_dir):
    rows = _evidence(spark, sf_dir).withColumn("weight", F.col("genomic_bp"))
    return linkage.weighted_vote(rows, ["repeat"]).withColumn("share", F.round("share", 6))


@query("WITH " + DEMO_SQL + EVIDENCE_SQL + """,
cast_votes AS (SELECT cluster_key, vote, sum(coalesce(genomic_bp, 0) + 1) AS w, min(member) AS first FROM few WHERE vote IS NOT NULL AND vote <> 'repeat' GROUP BY ALL),
won AS (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY w DESC, first) AS r, w / sum(w) OVER (PARTITION BY cluster_key) AS share FROM cast_votes),
figures AS (
  SELECT cluster_key, sum(n_full_len) AS full_len, bool_or(cov >= 0.999) AS deep, coalesce(sum(frac_tandem * genomic_bp), 0) / sum(genomic_bp) AS tandem,
         median(div_median) AS div, count(DISTINCT tool) AS n_tools, count(*) AS n_members FROM few GROUP BY cluster_key),
tested AS (
  SELECT f.*, vote AS winner, share, full_len >= 5 AS g1, deep AS g2, coalesce(share >= 0.667, false) AS g3, coalesce(tandem <= 0.30, false) AS g4, coalesce(div <= 25, false) AS g5, n_tools >= 2 AS g6
  FROM figures f LEFT JOIN won w ON w.cluster_key = f.cluster_key AND r = 1)
SELECT cluster_key, n_members, n_tools, winner, round(share, 6) AS share, round(tandem, 6) AS tandem, round(div, 6) AS div, g1, g2, g3, g4, g5, g6,
       g1::INTEGER + g2::INTEGER + g3::INTEGER + g4::INTEGER + g5::INTEGER + g6::INTEGER AS n_gates, g1 AND g2 AND g3 AND g4 AND g5 AND g6 AS candidate FROM tested""")
def cluster_gates(spark, sf_dir):
    rows = cut(_evidence(spark, sf_dir))
    return linkage.gates(rows, linkage.weighted_vote(rows.withColumn("weight", F.col("genomic_bp")), ["repeat"]))


@query("WITH " + EDGE_SQL + """,
mids AS (SELECT tool, family, chrom, (s + e) // 2 AS mid FROM hits),
inside AS (
  SELECT m.tool || ':' || m.family AS a, p.tool || ':' || p.family AS b, count(*) AS n
  FROM mids m JOIN paint_bins p ON p.chrom = m.chrom AND p.bin = m.mid // 512 AND p.s <= m.mid AND m.mid < p.e AND p.tool <> m.tool GROUP BY ALL),
total AS (SELECT tool || ':' || family AS a, count(*) AS n_copies FROM hits GROUP BY ALL),
shares AS (SELECT a, b, n / n_copies AS share FROM inside JOIN total USING (a))
SELECT e.a, e.b, joint_bp, round(w_bp, 6) AS w_bp, round(greatest(coalesce(x.share, 0), coalesce(y.share, 0)), 6) AS w_copy
FROM edges e LEFT JOIN shares x ON x.a = e.a AND x.b = e.b LEFT JOIN shares y ON y.a = e.b AND y.b = e.a""")
def edge_copy_weights(spark, sf_dir):
    rows = linkage.with_copy_weight(_edges(spark, sf_dir), demo_hits(spark, sf_dir))
    return rows.select("a", "b", "joint_bp", *[F.round(c, 6).alias(c) for c in ("w_bp", "w_copy")])


@query("WITH " + DEMO_SQL + EVIDENCE_SQL + """,
paths AS (SELECT member, cluster_key, genomic_bp, CASE CAST(substr(family, 2) AS INTEGER) % 5 WHEN 0 THEN 'repeat:TE:ClassI:LTR' WHEN 1 THEN 'repeat:TE' WHEN 2 THEN '' WHEN 3 THEN 'repeat:TE:ClassII:TIR:hAT' END AS path FROM few),
given AS (SELECT member, genomic_bp FROM evidence WHERE family <> 'F9'),
weighed AS (SELECT p.cluster_key, p.member, path, g.genomic_bp FROM paths p LEFT JOIN given g USING (member)),
votes AS (SELECT cluster_key, path, sum(coalesce(genomic_bp, 0) + 1) AS w, min(member) AS first FROM weighed WHERE path IS NOT NULL AND path NOT IN ('', 'repeat', 'repeat:TE') GROUP BY ALL),
won AS (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY w DESC, first) AS r, w / sum(w) OVER (PARTITION BY cluster_key) AS share FROM votes)
SELECT k.cluster_key, path AS winner, round(share, 6) AS share FROM (SELECT DISTINCT cluster_key FROM few) k LEFT JOIN won ON won.cluster_key = k.cluster_key AND r = 1""")
def path_vote(spark, sf_dir):
    path = "CASE CAST(substr(family, 2) AS INT) % 5 WHEN 0 THEN 'repeat:TE:ClassI:LTR' WHEN 1 THEN 'repeat:TE' WHEN 2 THEN '' WHEN 3 THEN 'repeat:TE:ClassII:TIR:hAT' END"
    rows = _evidence(spark, sf_dir)
    members = rows.select("cluster_key", "member", F.expr(path).alias("vote"))
    joined = linkage.with_evidence(members, rows.filter("family <> 'F9'").select("member", F.col("genomic_bp").alias("weight")))
    return linkage.weighted_vote(joined, linkage.VAGUE_PATHS).withColumn("share", F.round("share", 6))


# Copies --------------------------------------------------------------------------------------------

GAP_SQL = DEMO_SQL + """,
gapped AS (
  SELECT *, s - lag(e) OVER w AS gap, lag(e) OVER w AS before, lag(chrom) OVER w = chrom AND lag(strand) OVER w = strand AND s - lag(e) OVER w BETWEEN 0 AND 20000 AS joins
  FROM hits WINDOW w AS (PARTITION BY tool, family ORDER BY chrom, s, ord NULLS FIRST, e, strand))"""
REDUCE_SQL = """,
blocks AS (SELECT *, sum(CASE WHEN coalesce(joins, false) THEN 0 ELSE 1 END) OVER (PARTITION BY tool, family ORDER BY chrom, s, ord NULLS FIRST, e, strand ROWS UNBOUNDED PRECEDING) AS block FROM gapped),
copies AS (
  SELECT tool, family, chrom, min(s) AS "start", max(e) AS "end", arg_min(strand, row(s, ord, e, strand)) AS strand, count(*) AS n_fragments, round(avg(div), 6) AS div,
         min(cons_start) AS cons_start, max(cons_end) AS cons_end, max(cons_len) AS cons_len, list(e ORDER BY s, ord NULLS FIRST) AS ends, list(s ORDER BY s, ord NULLS FIRST) AS starts
  FROM blocks GROUP BY tool, family, chrom, block)"""
#: The demo clusters: families of all tools whose number leaves the same rest.
CLUSTER = "CAST(substr(family, 2) AS INT) % 6"
#: Places in a tool's file repeat between tools and members.
SHARED_SQL = DEMO_SQL.replace("hits AS (", "placed AS (") + ", hits AS (SELECT * REPLACE (CASE WHEN ord % 991 > 0 THEN ord % 991 END AS ord) FROM placed)"
VETO_SQL = GAP_SQL.replace(DEMO_SQL, SHARED_SQL).replace("gapped AS (", "gapped0 AS (") + f""",
named AS (SELECT chrom, s, e, {CLUSTER} AS cluster, unnest(range(s // 1024, (e - 1) // 1024 + 1)) AS bin FROM hits),
gaps AS (SELECT DISTINCT {CLUSTER} AS cluster, chrom, before AS s, s AS e FROM gapped0 WHERE joins AND gap > 0),
probes AS (SELECT *, unnest(range(s // 1024, (e - 1) // 1024 + 1)) AS bin FROM gaps),
pieces AS (
  SELECT p.cluster, p.chrom, p.s AS gs, p.e AS ge, greatest(p.s, n.s) AS s, least(p.e, n.e) AS e
  FROM probes p JOIN named n ON n.chrom = p.chrom AND n.bin = p.bin AND n.cluster <> p.cluster AND n.s < p.e AND p.s < n.e AND p.bin = greatest(p.s // 1024, n.s // 1024)),
marked AS (SELECT *, CASE WHEN max(e) OVER (PARTITION BY cluster, chrom, gs, ge ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= s THEN 0 ELSE 1 END AS new FROM pieces),
runs AS (SELECT *, sum(new) OVER (PARTITION BY cluster, chrom, gs, ge ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM marked),
covered AS (SELECT cluster, chrom, gs, ge, sum(bp) / (ge - gs) AS part FROM (SELECT cluster, chrom, gs, ge, run, max(e) - min(s) AS bp FROM runs GROUP BY ALL) GROUP BY cluster, chrom, gs, ge),
gapped AS (
  SELECT g.* REPLACE (coalesce(joins, false) AND coalesce(part, 0) <= 0.5 AS joins)
  FROM gapped0 g LEFT JOIN covered c ON c.cluster = {CLUSTER.replace("family", "g.family")} AND c.chrom = g.chrom AND c.gs = g.before AND c.ge = g.s)"""
COPY_COLUMNS = ["tool", "family", "chrom", "start", "end", "strand", "n_fragments", "div", "cons_start", "cons_end"]
COPY_SELECT = ' SELECT tool, family, chrom, "start", "end", strand, n_fragments, div, cons_start, cons_end FROM copies'


@query("WITH " + GAP_SQL + REDUCE_SQL + COPY_SELECT)
def merge_always(spark, sf_dir):
    return copies.merge_copies(demo_hits(spark, sf_dir)).select(COPY_COLUMNS)


def _shared(hits):
    """hits with ords that repeat and are missing, as between files of several tools."""
    return hits.withColumn("ord", F.expr("CASE WHEN ord % 991 > 0 THEN ord % 991 END"))


@query("WITH " + VETO_SQL + REDUCE_SQL + COPY_SELECT)
def gap_aware_merge(spark, sf_dir):
    return copies.merge_copies(_shared(demo_hits(spark, sf_dir)), gap_aware=True, cluster=F.expr(CLUSTER)).select(COPY_COLUMNS)


@query("WITH " + DEMO_SQL + """
SELECT tool, family, arg_min(chrom, row(s, ord, e, strand)) AS chrom, hit_id, min(s) AS "start", max(e) AS "end", arg_min(strand, row(s, ord, e, strand)) AS strand, count(*) AS n_fragments FROM hits WHERE hit_id IS NOT NULL GROUP BY tool, family, hit_id""")
def hit_id_group(spark, sf_dir):
    return copies.hit_id_copies(demo_hits(spark, sf_dir)).select("tool", "family", "chrom", "hit_id", "start", "end", "strand", "n_fragments")


@query("WITH RECURSIVE " + GAP_SQL + REDUCE_SQL + """,
numbered AS (SELECT *, row_number() OVER () AS id, coalesce("end" - "start" > 1.5 * cons_len AND n_fragments > 1, false) AS long FROM copies),
long AS (SELECT id, starts, ends, 1.5 * cons_len AS cap, list_transform(range(1, len(starts) + 1), lambda i: CASE WHEN i > 1 THEN starts[i] - ends[i - 1] END) AS gaps FROM numbered WHERE long),
walk AS (
  SELECT id, CAST(1 AS BIGINT) AS i, CAST(len(starts) AS BIGINT) AS j FROM long
  UNION ALL
  SELECT id, piece.i, piece.j
  FROM (
    SELECT id, unnest([{'i': i, 'j': i + list_position(gaps[i + 1:j], list_max(gaps[i + 1:j])) - 1}, {'i': i + list_position(gaps[i + 1:j], list_max(gaps[i + 1:j])), 'j': j}]) AS piece
    FROM walk JOIN long USING (id) WHERE j > i AND list_max(ends[i:j]) - starts[i] > cap)),
pieces AS (SELECT id, starts[i] AS "start", list_max(ends[i:j]) AS "end", j - i + 1 AS n_fragments FROM walk JOIN long USING (id) WHERE j = i OR list_max(ends[i:j]) - starts[i] <= cap)
SELECT tool, family, chrom, "start", "end", n_fragments FROM numbered WHERE NOT long
UNION ALL SELECT tool, family, chrom, p."start", p."end", p.n_fragments FROM pieces p JOIN numbered USING (id)""")
def cap_widest_gap(spark, sf_dir):
    return copies.cap_widest_gap(copies.merge_copies(demo_hits(spark, sf_dir)))


@query("WITH RECURSIVE " + GAP_SQL + REDUCE_SQL + """,
long AS (SELECT row_number() OVER () AS id, tool, family, chrom, starts, ends FROM copies WHERE "end" - "start" > 750),
walk AS (
  SELECT id, 1 AS i, 1 AS piece, starts[1] AS first, ends[1] AS last, 1 AS n, starts, ends FROM long
  UNION ALL
  SELECT id, i + 1, CASE WHEN ends[i + 1] - first <= 750 THEN piece ELSE piece + 1 END, CASE WHEN ends[i + 1] - first <= 750 THEN first ELSE starts[i + 1] END,
         CASE WHEN ends[i + 1] - first <= 750 THEN greatest(last, ends[i + 1]) ELSE ends[i + 1] END, CASE WHEN ends[i + 1] - first <= 750 THEN n + 1 ELSE 1 END, starts, ends
  FROM walk WHERE i < len(starts))
SELECT tool, family, chrom, min(first) AS "start", max(last) AS "end", CAST(max(n) AS BIGINT) AS n_fragments FROM walk JOIN long USING (id) GROUP BY tool, family, chrom, id, piece""")
def cap_greedy(spark, sf_dir):
    made = copies.merge_copies(demo_hits(spark, sf_dir))
    return copies.cap_greedy(made.filter(F.col("end") - F.col("start") > 750), F.lit(500))


MODES_SQL = """
SELECT mode, count(*) AS n, count(*) FILTER (full_len) AS n_full, median("end" - "start") AS median_length, max("end" - "start") AS longest,
       round(avg(CASE WHEN "end" - "start" > 1.5 * cons_len THEN 1.0 ELSE 0.0 END), 6) AS over_fraction, count(*) FILTER (n_fragments > 1) AS n_multi
FROM (SELECT '{mode}' AS mode, *, coalesce(cons_start <= 20 AND cons_end >= cons_len - 20 AND (cons_end - cons_start) / cons_len >= 0.8, false) AS full_len FROM copies) GROUP BY mode"""


@query("SELECT * FROM (WITH " + GAP_SQL + REDUCE_SQL + MODES_SQL.replace("{mode}", "always") + ") UNION ALL SELECT * FROM (WITH " + VETO_SQL + REDUCE_SQL + MODES_SQL.replace("{mode}", "gap_aware") + ")")
def merge_mode_comparison(spark, sf_dir):
    hits = demo_hits(spark, sf_dir)
    both = copies.merge_copies(hits).withColumn("mode", F.lit("always")).unionByName(copies.merge_copies(_shared(hits), True, cluster=F.expr(CLUSTER)).withColumn("mode", F.lit("gap_aware")))
    span = F.col("end") - F.col("start")
    full = copies.near_full(F.col("cons_len"))
    over = F.coalesce((span > 1.5 * F.col("cons_len")), F.lit(False)).cast("double")
    return both.groupBy("mode").agg(F.count("*").alias("n"), F.count_if(full).alias("n_full"), F.median(span).alias("median_length"), F.max(span).alias("longest"), F.round(F.avg(over), 6).alias("over_fraction"), F.count_if(F.col("n_fragments") > 1).alias("n_multi"))


@query("WITH " + DEMO_SQL + """
SELECT tool, family, count(*) FILTER (cons_start <= 20 AND cons_end >= cons_len - 20 AND (cons_end - cons_start) / cons_len >= 0.8) AS n_full,
       count(*) FILTER ((cons_end - cons_start) / cons_len >= 0.8) AS n_span, count(*) AS n FROM hits GROUP BY tool, family""")
def near_full_length(spark, sf_dir):
    length = F.col("cons_len")
    return demo_hits(spark, sf_dir).groupBy("tool", "family").agg(F.count_if(copies.near_full(length)).alias("n_full"), F.count_if(copies.near_full(length, span_only=True)).alias("n_span"), F.count("*").alias("n"))


LENGTH_SQL = "lengths AS (SELECT n_nationkey AS nation, s_suppkey AS supp FROM nation, supplier WHERE n_nationkey = s_nationkey), "
LENGTHS = "SELECT CAST(s_nationkey AS VARCHAR) AS cluster_key, s_name AS member, 't' || (s_suppkey % 3) AS tool, CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE 200 + (s_suppkey % 5) * 7 + CASE WHEN s_suppkey % 4 = 0 THEN 500 ELSE 0 END END AS cons_len, s_suppkey % 8 = 0 AS protected FROM supplier"


def _lengths(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("CAST(s_nationkey AS STRING) AS cluster_key", "s_name AS member", "'t' || (s_suppkey % 3) AS tool", "CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE 200 + (s_suppkey % 5) * 7 + CASE WHEN s_suppkey % 4 = 0 THEN 500 ELSE 0 END END AS cons_len", "s_suppkey % 8 = 0 AS protected")


@query("WITH lengths AS (" + LENGTHS + """),
pairs AS (SELECT a.*, b.cons_len AS other FROM lengths a JOIN lengths b ON a.cluster_key = b.cluster_key AND a.member <> b.member AND b.cons_len IS NOT NULL WHERE a.cons_len IS NOT NULL),
mid AS (SELECT *, median(other) OVER (PARTITION BY cluster_key, member) AS mate FROM pairs),
agreed AS (
  SELECT cluster_key, member, any_value(cons_len) AS own, any_value(protected) AS protected, any_value(mate) AS mate, count(*) AS n,
         count(*) FILTER (other BETWEEN mate / 1.3 AND mate * 1.3) AS agree, median(other) FILTER (other BETWEEN mate / 1.3 AND mate * 1.3) AS ref FROM mid GROUP BY cluster_key, member),
judged AS (
  SELECT *, CASE WHEN n < 2 OR own / mate < 1.8 THEN 'keep' WHEN protected THEN 'abstain' WHEN agree < 2 OR agree < 0.5 * n THEN 'abstain' WHEN own / ref >= 1.8 THEN 'deconvolve' ELSE 'keep' END AS verdict FROM agreed)
SELECT cluster_key, member, verdict, CAST(CASE WHEN verdict = 'deconvolve' THEN ref ELSE own END AS DOUBLE) AS cons_len FROM judged""")
def deconvolution(spark, sf_dir):
    return copies.deconvolve(_lengths(spark, sf_dir))


@query("WITH " + DEMO_SQL + """,
counted AS (SELECT family, cons_len, count(*) AS n FROM hits WHERE tool = 'A' GROUP BY ALL),
lengths AS (SELECT family, cons_len FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n DESC, cons_len) AS r FROM counted) WHERE r = 1),
sizes AS (SELECT family, count(*) AS n_hits FROM hits WHERE tool = 'A' GROUP BY family),
known AS (SELECT chrom, s, e, l.cons_len, row(n_hits, 'A:' || family) AS rank FROM hits JOIN lengths l USING (family) JOIN sizes USING (family) WHERE tool = 'A'),
points AS (SELECT DISTINCT chrom, s AS x FROM known UNION SELECT DISTINCT chrom, e FROM known),
cells AS (SELECT chrom, x AS s, lead(x) OVER (PARTITION BY chrom ORDER BY x) AS e FROM points),
bins AS (SELECT *, unnest(range(s // 512, (e - 1) // 512 + 1)) AS bin FROM known),
painted AS (SELECT c.chrom, c.s, c.e, arg_max(k.cons_len, k.rank) AS cons_len FROM cells c JOIN bins k ON k.chrom = c.chrom AND k.bin = c.s // 512 AND k.s <= c.s AND k.e >= c.e GROUP BY ALL),
paint_bins AS (SELECT *, unnest(range(s // 512, (e - 1) // 512 + 1)) AS bin FROM painted),
bare AS (SELECT ord, chrom, s, e, unnest(range(s // 512, (e - 1) // 512 + 1)) AS bin FROM hits WHERE tool = 'R'),
inside AS (SELECT b.ord, p.cons_len, sum(least(b.e, p.e) - greatest(b.s, p.s)) AS bp FROM bare b JOIN paint_bins p ON p.chrom = b.chrom AND p.bin = b.bin AND p.s < b.e AND b.s < p.e AND b.bin = greatest(p.s // 512, b.s // 512) GROUP BY ALL),
best AS (SELECT ord, cons_len FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY bp DESC, cons_len) AS r FROM inside) WHERE r = 1)
SELECT h.ord, best.cons_len, CASE WHEN best.cons_len IS NULL THEN 'none' ELSE 'clustermate' END AS source FROM hits h LEFT JOIN best USING (ord) WHERE h.tool = 'R'""")
def inherited_length(spark, sf_dir):
    hits = demo_hits(spark, sf_dir)
    mates = hits.filter("tool = 'A'")
    lengths = mates.groupBy("tool", "family").agg(F.mode("cons_len", True).alias("cons_len"))
    bare = hits.filter("tool = 'R'").select("ord", "chrom", "s", "e")
    return copies.inherited_lengths(bare, mates, lengths, "ord").select("ord", "cons_len", F.when(F.col("cons_len").isNull(), "none").otherwise("clustermate").alias("source"))


COPY_ROWS_SQL = DEMO_SQL + """,
rows AS (SELECT ord AS copy_id, tool, family, chrom, s AS "start", e AS "end", 1 AS n_fragments, cons_len, tool = 'A' AS measured,
         coalesce((cons_end - cons_start) / cons_len >= 0.8, false) AS is_full FROM hits)"""
LOCI_SQL = COPY_ROWS_SQL + """,
bins AS (SELECT *, unnest(range("start" // 512, ("end" - 1) // 512 + 1)) AS bin FROM rows),
pairs AS (SELECT DISTINCT x.copy_id AS a, y.copy_id AS b FROM bins x JOIN bins y ON x.chrom = y.chrom AND x.bin = y.bin AND x.copy_id < y.copy_id
          AND 2 * (least(x."end", y."end") - greatest(x."start", y."start")) >= least(x."end" - x."start", y."end" - y."start") AND x."start" < y."end" AND y."start" < x."end"),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS node, a AS root FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
parts AS (SELECT node AS copy_id, min(root) AS locus_id FROM reach GROUP BY node),
placed AS (SELECT r.*, coalesce(p.locus_id, r.copy_id) AS locus_id FROM rows r LEFT JOIN parts p USING (copy_id)),
loci AS (
  SELECT locus_id, count(*) AS n_members, count(DISTINCT tool) AS n_tools, array_to_string(list_sort(list(DISTINCT tool || ':' || family)), ';') AS members,
         bool_or(is_full) AS any_full, min("start") AS locus_start, max("end") AS locus_end FROM placed GROUP BY locus_id)"""


def _loci(spark, sf_dir):
    rows = demo_hits(spark, sf_dir).select(
        F.col("ord").alias("copy_id"), "tool", "family", "chrom", F.col("s").alias("start"), F.col("e").alias("end"), F.lit(1).alias("n_fragments"), "cons_len",
        (F.col("tool") == "A").alias("measured"), copies.near_full(F.col("cons_len"), span_only=True).alias("is_full"), "cons_start", "cons_end",
    )
    return copies.loci(rows)


@query("WITH RECURSIVE " + LOCI_SQL + """,
reps AS (SELECT locus_id, tool || ':' || family AS member, "start", "end", is_full, row_number() OVER (PARTITION BY locus_id ORDER BY is_full DESC, measured DESC, n_fragments, "end" - "start", copy_id) AS r FROM placed)
SELECT locus_id, n_members, n_tools, members, any_full, locus_start, locus_end, member, "start", "end", is_full FROM loci JOIN reps USING (locus_id) WHERE r = 1""")
def locus_dedup(spark, sf_dir):
    return copies.locus_table(_loci(spark, sf_dir)).select("locus_id", "n_members", "n_tools", "members", "any_full", "locus_start", "locus_end", "member", "start", "end", "is_full")


@query("WITH RECURSIVE " + LOCI_SQL + """
SELECT n_tools, count(*) AS n_loci, round(avg(CAST(any_full AS INTEGER)), 6) AS full_fraction, round(avg(n_members), 6) AS redundancy FROM loci GROUP BY n_tools""")
def support_completeness(spark, sf_dir):
    rows = copies.locus_table(_loci(spark, sf_dir))
    return rows.groupBy("n_tools").agg(F.count("*").alias("n_loci"), F.round(F.avg(F.col("any_full").cast("int")), 6).alias("full_fraction"), F.round(F.avg("n_members"), 6).alias("redundancy"))


MODE_SQL = "lengths AS (" + LENGTHS + """),
broken AS (SELECT *, CASE WHEN cons_len > 2.0 * lag(cons_len) OVER (PARTITION BY cluster_key ORDER BY cons_len, member) THEN 1 ELSE 0 END AS new FROM lengths WHERE cons_len IS NOT NULL),
numbered AS (SELECT *, CAST(sum(new) OVER (PARTITION BY cluster_key ORDER BY cons_len, member ROWS UNBOUNDED PRECEDING) AS BIGINT) AS mode_index FROM broken),
modes AS (
  SELECT cluster_key, mode_index, median(cons_len) AS centre, CAST(min(cons_len) AS DOUBLE) AS low, CAST(max(cons_len) AS DOUBLE) AS high, count(*) AS n_members,
         count(DISTINCT tool) AS n_tools, array_to_string(list_sort(list(DISTINCT tool)), ';') AS tools, count(DISTINCT tool) >= 2 AS credible FROM numbered GROUP BY cluster_key, mode_index)"""


@query("WITH " + MODE_SQL + " SELECT * FROM modes")
def length_modes(spark, sf_dir):
    return copies.length_modes(_lengths(spark, sf_dir), "cluster_key")


NEAR_SQL = MODE_SQL + """,
spans AS (SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS cluster_key, c_custkey % 1500 AS span FROM customer),
near AS (SELECT id, cluster_key, span, mode_index, centre, row_number() OVER (PARTITION BY id ORDER BY abs(ln(greatest(span, 1)) - ln(centre)), mode_index) AS r FROM spans LEFT JOIN modes USING (cluster_key))"""


def _spans(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "CAST(c_nationkey AS STRING) AS cluster_key", "c_custkey % 1500 AS span")
    return copies.nearest_mode(rows, copies.length_modes(_lengths(spark, sf_dir), "cluster_key"), "cluster_key", F.col("span"))


@query("WITH " + NEAR_SQL + " SELECT id, cluster_key, span, coalesce(mode_index, 0) AS mode_index, centre AS mode_centre FROM near WHERE r = 1")
def nearest_mode(spark, sf_dir):
    return _spans(spark, sf_dir).select("id", "cluster_key", "span", "mode_index", "mode_centre")


@query("WITH " + NEAR_SQL + " SELECT cluster_key, coalesce(mode_index, 0) AS mode_index, count(*) AS n, count(*) FILTER (span > 1.5 * centre) AS n_over FROM near WHERE r = 1 GROUP BY ALL")
def over_length(spark, sf_dir):
    return _spans(spark, sf_dir).groupBy("cluster_key", "mode_index").agg(F.count("*").alias("n"), F.count_if(F.col("span") > 1.5 * F.col("mode_centre")).alias("n_over"))


@query("WITH " + DEMO_SQL + """,
rows AS (SELECT tool || ':' || family AS member, ord, coalesce((cons_end - cons_start) / cons_len >= 0.8, false) AS is_full, (cons_start + cons_end) / 2.0 / cons_len AS mid, (ord % 1000003 * 7919 + 104729) % 1000003 AS draw FROM hits),
banded AS (SELECT *, CASE WHEN mid IS NULL THEN -1 WHEN mid <= 0.2 THEN 0 WHEN mid <= 0.4 THEN 1 WHEN mid <= 0.6 THEN 2 WHEN mid <= 0.8 THEN 3 ELSE 4 END AS band FROM rows),
sized AS (SELECT *, count(*) OVER (PARTITION BY member) AS n, count(*) FILTER (is_full) OVER (PARTITION BY member) AS n_full FROM banded),
quota AS (SELECT *, least(round_even(least(100, n) * 0.5, 0), n_full) AS fq, least(100, n) AS take FROM sized),
per AS (SELECT q.*, take - fq AS pq, greatest(1, floor((take - fq) / b.bands)) AS per FROM quota q LEFT JOIN (SELECT member, count(DISTINCT band) AS bands FROM banded WHERE NOT is_full GROUP BY member) b USING (member)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY member, is_full, band ORDER BY draw, ord) AS in_band FROM per),
rounds AS (SELECT *, NOT is_full AND in_band <= per AS first_round FROM ranked),
placed AS (SELECT *, row_number() OVER (PARTITION BY member, is_full ORDER BY CASE WHEN first_round THEN 0 ELSE 1 END, CASE WHEN first_round THEN band ELSE 99 END, draw, ord) AS place FROM rounds)
SELECT member, ord, is_full, CASE WHEN is_full OR n <= 10 THEN -1 ELSE band END AS cov_band FROM placed
WHERE n <= 10 OR (is_full AND place <= fq + greatest(0, pq - (n - n_full))) OR (NOT is_full AND place <= pq)""")
def stratified_sample(spark, sf_dir):
    rows = demo_hits(spark, sf_dir).select(F.concat_ws(":", "tool", "family").alias("member"), F.col("ord").alias("row"), copies.near_full(F.col("cons_len"), span_only=True).alias("is_full"), "cons_start", "cons_end", "cons_len")
    made = copies.stratified_sample(rows, "member", 100, 10, 0.5, F.expr("(row % 1000003 * 7919 + 104729) % 1000003"))
    return made.select("member", F.col("row").alias("ord"), "is_full", "cov_band")


@query("WITH " + GAP_SQL + REDUCE_SQL + """,
pieces AS (SELECT tool, family, chrom, "start", unnest(starts) AS frag_start, unnest(ends) AS frag_end, unnest(range(0, len(starts))) AS idx FROM copies)
SELECT tool, family, chrom, "start", CAST(idx AS INTEGER) AS idx, frag_start, frag_end FROM pieces WHERE frag_end - frag_start >= 30""")
def fragment_explode(spark, sf_dir):
    made = copies.merge_copies(demo_hits(spark, sf_dir)).select("tool", "family", "chrom", "start", F.posexplode("fragments").alias("idx", "f"))
    return made.select("tool", "family", "chrom", "start", "idx", F.col("f.start").alias("frag_start"), F.col("f.end").alias("frag_end")).filter("frag_end - frag_start >= 30")
