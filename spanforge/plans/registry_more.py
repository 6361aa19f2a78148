"""Queries on sequences, alignments, domains, selection and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanforge.operators import analysis, copies, permutation, sequences
from spanforge.plans.registry import DEMO_SQL, query
from spanforge.session import table
from spanforge.sources.hits import LETTERS, SEQUENCE_SQL, demo_hits, letters_of, sequence_of

SEQ_SQL = f"seqs AS (SELECT doc_id AS id, {SEQUENCE_SQL} AS seq FROM documents)"


def _seqs(spark, sf_dir):
    """Whole texts of all documents, all letters as bases."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), sequence_of(F.col("text")).alias("seq"))


RC = "reverse(translate({0}, '" + sequences.LETTERS + "', '" + sequences.OPPOSITE + "'))"


@query("WITH " + SEQ_SQL + f""",
cut AS (SELECT id, seq, id % 50 - 5 AS s, id % 50 + 60 AS e, CASE WHEN id % 2 = 0 THEN '-' ELSE '+' END AS strand FROM seqs),
pieces AS (SELECT id, strand, substr(seq, greatest(s, 0) + 1, greatest(least(e, length(seq)) - greatest(s, 0), 0)) AS piece FROM cut)
SELECT id, CASE WHEN strand = '-' THEN {RC.format('piece')} ELSE piece END AS seq, CAST(length(piece) AS INTEGER) AS length, length(piece) - length(replace(piece, 'N', '')) AS n_count FROM pieces""")
def revcomp_extract(spark, sf_dir):
    piece = sequences.extract(F.col("seq"), F.expr("id % 50 - 5"), F.expr("id % 50 + 60"), F.expr("CASE WHEN id % 2 = 0 THEN '-' ELSE '+' END"))
    rows = _seqs(spark, sf_dir).select("id", piece.alias("seq"))
    return rows.select("id", "seq", F.char_length("seq").alias("length"), (F.char_length("seq") - F.char_length(F.replace("seq", F.lit("N"), F.lit("")))).cast("bigint").alias("n_count"))


@query("WITH " + DEMO_SQL + """,
named AS (SELECT ord, chrom, s, e, strand, 'asm1:' || chrom || ':' || (s + 1) || '-' || e || '_' || CASE WHEN strand = '-' THEN '-' ELSE '+' END AS name FROM hits)
SELECT ord, name, chrom, s AS "start", e AS "end", CASE WHEN ord % 2 = 0 THEN CASE WHEN strand = '-' THEN '+' ELSE '-' END ELSE strand END AS strand FROM named""")
def interval_names(spark, sf_dir):
    rows = demo_hits(spark, sf_dir).select("ord", sequences.interval_id(F.lit("asm1"), F.col("chrom"), F.col("s"), F.col("e"), F.col("strand")).alias("name"))
    flipped = F.when(F.expr("ord % 2 = 0"), F.concat(F.lit("_R_"), "name")).otherwise(F.col("name"))
    return rows.withColumn("p", sequences.parse_interval_id(flipped)).select("ord", "name", "p.chrom", "p.start", "p.end", "p.strand")


@query("WITH " + SEQ_SQL + f""",
halves AS (SELECT id, least(120, length(seq) // 2) AS n, seq, {RC.format('seq')} AS rc FROM seqs),
places AS (SELECT id, i, CASE WHEN seq[i] = rc[i] THEN 0 ELSE 1 END AS miss FROM (SELECT id, seq, rc, unnest(range(1, n + 1)) AS i FROM halves)),
run AS (SELECT id, i, sum(miss) OVER (PARTITION BY id ORDER BY i) AS missed FROM places)
SELECT s.id, CAST(coalesce(max(i) FILTER (missed <= 0), 0) AS INTEGER) AS tir_0, CAST(coalesce(max(i) FILTER (missed <= 1), 0) AS INTEGER) AS tir_1,
       CAST(coalesce(max(i) FILTER (missed <= 2), 0) AS INTEGER) AS tir_2, CAST(coalesce(max(i) FILTER (missed <= 3), 0) AS INTEGER) AS tir_3
FROM seqs s LEFT JOIN run USING (id) GROUP BY s.id""")
def tir_scan(spark, sf_dir):
    return sequences.terminal_inverted_repeat(_seqs(spark, sf_dir))


ALN_SQL = """rows AS (
  SELECT source AS aln_id, CAST(doc_id AS VARCHAR) AS row_id,
         repeat('-', CAST(doc_id % 4 AS INTEGER)) || translate(regexp_replace(regexp_replace(text, '[^\x00-\x7F]', 'z', 'g'), '[^A-Za-z ]', '', 'g'), 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ ', 'acgtacgtaacgtacgtacgtacganacgtacgtaacgtacgtacgtacgan.') AS seq
  FROM documents),
cells AS (SELECT aln_id, row_id, i - 1 AS col, translate(upper(seq[i]), '._~', '---') AS base FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM rows)),
spans AS (SELECT aln_id, row_id, min(col) AS lo, max(col) AS hi FROM cells WHERE base <> '-' GROUP BY ALL),
counts AS (SELECT aln_id, col, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'C') AS c, count(*) FILTER (base = 'G') AS g, count(*) FILTER (base = 'T') AS t, count(*) FILTER (base <> '-') AS bases FROM cells GROUP BY ALL),
columns AS (SELECT k.*, (SELECT count(*) FROM spans s WHERE s.aln_id = k.aln_id AND k.col BETWEEN s.lo AND s.hi) AS cover FROM counts k),
sizes AS (SELECT aln_id, count(DISTINCT row_id) AS n_rows FROM rows GROUP BY aln_id),
tops AS (SELECT c.*, greatest(a, c, g, t) AS top, coalesce(bases / nullif(cover, 0), 0) AS occ, n_rows FROM columns c JOIN sizes USING (aln_id)),
calls AS (
  SELECT *, occ >= 0.5 AND cover >= least(3, n_rows) AS match,
         CASE WHEN top = 0 THEN 'N' ELSE map_extract_value(MAP {'A':'A','C':'C','G':'G','T':'T','AG':'R','CT':'Y','GT':'K','AC':'M','CG':'S','AT':'W','CGT':'B','AGT':'D','ACT':'H','ACG':'V','ACGT':'N'},
           CASE WHEN a = top THEN 'A' ELSE '' END || CASE WHEN c = top THEN 'C' ELSE '' END || CASE WHEN g = top THEN 'G' ELSE '' END || CASE WHEN t = top THEN 'T' ELSE '' END) END AS call
  FROM tops)"""


def _alignment(spark, sf_dir):
    """Whole texts of all documents, by source, all letters as bases and spaces as gaps."""
    letters = letters_of(F.col("text"), dict(zip(LETTERS + LETTERS.upper() + " ", 2 * "acgtacgtaacgtacgtacgtacgan" + ".", strict=True)))
    rows = table(spark, sf_dir, "documents")
    return rows.select(F.col("source").alias("aln_id"), F.col("doc_id").cast("string").alias("row_id"), F.concat(F.expr("repeat('-', CAST(doc_id % 4 AS INT))"), letters).alias("seq"), "doc_id")


def _calls(spark, sf_dir):
    rows = _alignment(spark, sf_dir)
    return sequences.called(sequences.row_occupancy(rows), rows.groupBy("aln_id").agg(F.count_distinct("row_id").alias("n_rows")))


@query("WITH " + ALN_SQL + " SELECT aln_id, CAST(col AS INTEGER) AS col, a, c, g, t, bases, cover, round(occ, 6) AS occ FROM tops")
def msa_occupancy(spark, sf_dir):
    return sequences.row_occupancy(_alignment(spark, sf_dir)).withColumn("occ", F.round("occ", 6))


@query("WITH " + ALN_SQL + """
SELECT aln_id, coalesce(string_agg(call, '' ORDER BY col) FILTER (match), '') AS consensus, string_agg(CASE WHEN match THEN call ELSE '.' END, '' ORDER BY col) AS rf FROM calls GROUP BY aln_id""")
def msa_consensus(spark, sf_dir):
    return sequences.consensus(_calls(spark, sf_dir)).select("aln_id", "consensus", "rf")


@query("WITH " + ALN_SQL + """
SELECT aln_id, CAST(min(col) FILTER (match) AS INTEGER) AS first_match, CAST(max(col) FILTER (match) AS INTEGER) AS last_match, floor(median(cover) FILTER (match))::BIGINT AS depth_median,
       min(cover) FILTER (match) AS depth_min, max(cover) FILTER (match) AS depth_max FROM calls GROUP BY aln_id""")
def msa_trim(spark, sf_dir):
    match = lambda c: F.when(F.col("match"), F.col(c))
    return _calls(spark, sf_dir).groupBy("aln_id").agg(F.min(match("col")).alias("first_match"), F.max(match("col")).alias("last_match"), F.floor(F.median(match("cover"))).cast("bigint").alias("depth_median"), F.min(match("cover")).alias("depth_min"), F.max(match("cover")).alias("depth_max"))


@query()
def msa_finalize(spark, sf_dir):
    rows = _alignment(spark, sf_dir).withColumn("start", F.col("doc_id") * 1000).withColumn("end", F.col("start") + F.char_length(F.regexp_replace("seq", r"[.\-]", ""))).withColumn("strand", F.expr("CASE WHEN doc_id % 2 = 0 THEN '-' ELSE '+' END"))
    return sequences.finalize(rows)


PROFILES = ["RVT_1", "rve", "DDE_Tnp_4", "gag_pre", "zf-CCHC", "Integrase_H2C2", "PMD", "Transposase_22", "Transposase_21", "RVP_2", "HTH_Tnp_Tc3_1", "Helitron_like_N", "Pao_retrotransp", "MULE", "Rep_3", "HTH_48", "IN_DBD_C"]
PATHS = ["SINE", "LINE", "LTR", "DNA/hAT", "Helitron", "Rolling", "RC", "Penelope", "DIRS", "source", "x"]
LISTS = {name: "['" + "', '".join(values) + "']" for name, values in (("profiles", PROFILES), ("paths", PATHS))}
#: The lookahead of one pattern, which this SQL's expressions lack, in two steps.
KIND_SQL = "CASE " + " ".join(
    "WHEN " + " OR ".join("(regexp_matches(profile, 'Transposase_\\d+$') AND NOT regexp_matches(profile, 'Transposase_22$'))" if "(?!" in x else f"regexp_matches(profile, '{x}')" for x in patterns) + f" THEN '{kind}'"
    for kind, patterns in analysis.DOMAIN_KINDS.items()
) + " END"
ORDER_SQL = "CASE " + " ".join(f"WHEN regexp_matches(path || '|' || coalesce(tp, ''), '(?i){pattern}') THEN '{name}'" for name, pattern in analysis.ORDERS) + " ELSE 'Unknown' END"
DOMAIN_SQL = f"""domains AS (SELECT l_orderkey AS seq, ({LISTS["profiles"]})[l_partkey % {len(PROFILES)} + 1] AS profile, l_quantity / 50 AS hmm_cov FROM lineitem),
kinds AS (SELECT *, CASE WHEN hmm_cov >= 0.5 THEN {KIND_SQL} END AS kind FROM domains),
summary AS (
  SELECT seq, count(DISTINCT profile) AS n_dom, array_to_string(list_sort(list(DISTINCT profile))[1:12], ';') AS domains, count(DISTINCT profile) FILTER (kind IS NOT NULL) AS n_core,
         coalesce(array_to_string(list_sort(list(DISTINCT kind) FILTER (kind IS NOT NULL)), ';'), '') AS core_kinds,
         coalesce(array_to_string(list_sort(list(DISTINCT profile) FILTER (kind IS NOT NULL)), ';'), '') AS core_domains, max(hmm_cov) AS best_cov FROM kinds GROUP BY seq),
models AS (
  SELECT o_orderkey AS seq, 'repeat:TE:' || ({LISTS["paths"]})[o_custkey % {len(PATHS)} + 1] AS path, CASE WHEN o_orderkey % 5 = 0 THEN 'Interspersed;TIR' END AS tp,
         CAST(floor(o_totalprice / 50) AS BIGINT) AS length, CASE WHEN o_custkey % 7 > 0 THEN o_custkey % 30 END AS n_rows, CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 12 END AS depth, o_orderkey % 50 AS n_full FROM orders),
joined AS (SELECT m.*, coalesce(n_dom, 0) AS n_dom, coalesce(n_core, 0) AS n_core, coalesce(best_cov, 0.0) AS best_cov, {ORDER_SQL} AS order_name FROM models m LEFT JOIN summary USING (seq)),
floors AS (SELECT *, CASE order_name WHEN 'LTR' THEN 4000 WHEN 'DIRS' THEN 4000 WHEN 'LINE' THEN 2500 WHEN 'RC' THEN 3000 WHEN 'TIR' THEN 1100 WHEN 'PLE' THEN 1200 END AS floor_len,
  coalesce(n_rows, 0) < 10 OR coalesce(depth, 0) < 5 AS thin FROM joined),
tiers AS (
  SELECT *, CASE WHEN order_name = 'SINE' THEN CASE WHEN length > 700 THEN 'D - oversized for class, no core domain (suspect chimera/rDNA)' ELSE 'E - non-autonomous at expected size (SINE)' END
    WHEN n_core > 0 AND coalesce(length >= floor_len, false) THEN CASE WHEN thin THEN 'B - core domain, alignment too thin to trust' ELSE 'A - autonomous (core domain + class size)' END
    WHEN n_core > 0 THEN 'B - core domain, short for class' WHEN n_dom > 0 THEN 'C - accessory domain only (likely truncated)'
    WHEN coalesce(length >= floor_len, false) THEN 'D - oversized for class, no core domain (suspect chimera/rDNA)' ELSE 'F - too short for class (MITE/fragment scale)' END AS tier FROM floors)"""


def _pick(values, number):
    return F.element_at(F.array(*map(F.lit, values)), (F.expr(number) % len(values) + 1).cast("int"))


def _domains(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("seq"), _pick(PROFILES, "l_partkey").alias("profile"), F.expr("l_quantity / 50").alias("hmm_cov"))
    return analysis.domain_summary(rows)


def _tiers(spark, sf_dir):
    models = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("repeat:TE:"), _pick(PATHS, "o_custkey")).alias("path"), F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'Interspersed;TIR' END").alias("tp"),
        F.expr("CAST(floor(o_totalprice / 50) AS BIGINT)").alias("length"), F.expr("CASE WHEN o_custkey % 7 > 0 THEN o_custkey % 30 END").alias("n_rows"),
        F.expr("CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 12 END").alias("depth"), F.expr("o_orderkey % 50").alias("n_full"),
    )
    rows = models.join(_domains(spark, sf_dir), "seq", "left").na.fill({"n_dom": 0, "n_core": 0, "best_cov": 0.0}).withColumn("order_name", analysis.order_of_path(F.col("path"), F.col("tp")))
    return rows.withColumn("tier", analysis.tier(*[F.col(c) for c in ("order_name", "length", "n_dom", "n_core", "n_rows", "depth")]))


@query("WITH " + DOMAIN_SQL + " SELECT * FROM summary")
def domain_summary(spark, sf_dir):
    return _domains(spark, sf_dir)


@query("WITH " + DOMAIN_SQL + " SELECT order_name, tier, count(*) AS n, CAST(sum(length) AS BIGINT) AS bp FROM tiers GROUP BY ALL")
def tier_assign(spark, sf_dir):
    return _tiers(spark, sf_dir).groupBy("order_name", "tier").agg(F.count("*").alias("n"), F.sum("length").alias("bp"))


@query("WITH " + DOMAIN_SQL + " SELECT seq, n_core, best_cov, n_full, length, row_number() OVER (ORDER BY n_core DESC, best_cov DESC, n_full DESC, length DESC, seq) AS place FROM tiers WHERE tier LIKE 'A%' ORDER BY place LIMIT 50")
def tier_rank(spark, sf_dir):
    order = [F.col("n_core").desc(), F.col("best_cov").desc(), F.col("n_full").desc(), F.col("length").desc(), F.col("seq")]
    best = _tiers(spark, sf_dir).filter(F.col("tier").startswith("A")).orderBy(*order).limit(50)
    return best.select("seq", "n_core", "best_cov", "n_full", "length", F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("place"))


@query("""WITH codes AS (SELECT user_id % 40 AS packet, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END AS severity, 'E' || (event_id % 7) AS code FROM events)
SELECT severity, code, count(DISTINCT packet) AS packets, count(*) AS total FROM codes GROUP BY ALL""")
def lint_triage(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("user_id % 40 AS packet", "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END AS severity", "'E' || (event_id % 7) AS code")
    return analysis.triage(rows)


@query("WITH codes AS (SELECT user_id AS packet, CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS severity FROM events) SELECT count(DISTINCT packet) AS n_packets, count(DISTINCT packet) FILTER (severity = 'ERROR') AS n_with_errors FROM codes")
def lint_error_packets(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("user_id AS packet", "CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS severity")
    return analysis.with_errors(rows)


@query("WITH " + DOMAIN_SQL + " SELECT order_name, " + ", ".join(f"count(*) FILTER (tier LIKE '{x}%') AS {x.lower()}" for x in "ABCDEF") + ", count(*) AS total FROM tiers GROUP BY order_name")
def tier_crosstab(spark, sf_dir):
    return analysis.tier_crosstab(_tiers(spark, sf_dir))


@query("""WITH pool AS (SELECT p_partkey AS id, p_size % 4 AS n_tools, p_type AS order_name, (p_partkey * 7919 + 104729) % 1000003 AS draw FROM part),
numbered AS (SELECT *, row_number() OVER (PARTITION BY n_tools, order_name ORDER BY draw, id) AS number FROM pool)
SELECT id, n_tools, order_name, CAST(number AS INTEGER) AS number FROM numbered ORDER BY number, n_tools, order_name LIMIT 100""")
def batch_select(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_size % 4 AS n_tools", "p_type AS order_name", "(p_partkey * 7919 + 104729) % 1000003 AS draw")
    return analysis.round_robin(rows, 100, ["n_tools", "order_name"], F.col("draw"), "id").drop("draw")


CROSS_SQL = """WITH pool AS (SELECT p_type AS order_name, p_size % 4 AS n_tools FROM part)
SELECT coalesce(order_name, 'all') AS order_name, coalesce(CAST(n_tools AS VARCHAR), 'all') AS n_tools, count(*) AS n FROM pool GROUP BY CUBE (order_name, n_tools)"""


@query(CROSS_SQL)
def selection_crosstab(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_type AS order_name", "p_size % 4 AS n_tools")
    return rows.cube("order_name", "n_tools").agg(F.count("*").alias("n")).select(F.coalesce("order_name", F.lit("all")).alias("order_name"), F.coalesce(F.col("n_tools").cast("string"), F.lit("all")).alias("n_tools"), "n")


RANK = """rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0"""


@query(f"""WITH pairs AS (SELECT o_orderpriority AS g, o_totalprice AS x, o_custkey % 97 AS y FROM orders),
ranked AS (SELECT g, {RANK.format(by='g', x='x')} AS rx, {RANK.format(by='g', x='y')} AS ry FROM pairs)
SELECT g, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM ranked GROUP BY g""")
def spearman(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderpriority AS g", "o_totalprice AS x", "o_custkey % 97 AS y")
    return analysis.spearman(rows, ["g"], "x", "y")


@query(f"""WITH pairs AS (SELECT lang AS g, toxic AS side, n_chars AS v FROM documents JOIN labels USING (doc_id)),
ranked AS (SELECT *, {RANK.format(by='g', x='v')} AS r FROM pairs),
sums AS (SELECT g, count(*) FILTER (side = 1) AS n1, count(*) FILTER (side = 0) AS n0, sum(r) FILTER (side = 1) AS r1 FROM ranked GROUP BY g)
SELECT g, n1, n0, CAST(r1 - n1 * (n1 + 1) / 2.0 AS DOUBLE) AS u, round(2 * (r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0) - 1, 6) AS effect FROM sums WHERE n1 > 0 AND n0 > 0""")
def mann_whitney(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").selectExpr("lang AS g", "toxic AS side", "n_chars AS v")
    return analysis.mann_whitney(rows, ["g"], "side", "v")


#: Both p-values in SQL over pairs(g, id, x, y): order of rounds, pairs by place, statistic over x and y.
NULL_SQL = """,
draws AS (SELECT g, id, x, y, round, md5(round || ':' || id) AS draw FROM pairs, (SELECT unnest(range(0, {rounds} + 1)) AS round)),
placed AS (SELECT *, row_number() OVER (PARTITION BY g, round ORDER BY draw, id) AS place FROM draws),
dealt AS (SELECT d.g, d.round, f.x, d.y FROM placed d JOIN placed f ON f.g = d.g AND f.place = d.place AND f.round = 0 WHERE d.round > 0),
nulls AS (SELECT g, round, {statistic} AS value FROM dealt GROUP BY g, round),
observed AS (SELECT g, count(*) AS n, {statistic} AS observed FROM pairs GROUP BY g)
SELECT o.g, o.n, round(observed, 6) + CAST(0 AS DOUBLE) AS observed, CASE WHEN observed IS NOT NULL THEN (count(*) FILTER (abs(value) >= abs(observed) * (1 - 1e-9) - 1e-9) + 1) / ({rounds} + 1) END AS p
FROM observed o LEFT JOIN nulls USING (g) GROUP BY o.g, o.n, observed"""
CORRELATION_SQL = "CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0 THEN corr(x, y) END"
EXCESS_SQL = """CASE WHEN count(*) FILTER (x = 1) > 0 AND count(*) FILTER (x = 0) > 0 THEN
  sum(y) FILTER (x = 1) - count(*) FILTER (x = 1) * (count(*) FILTER (x = 1) + 1) / 2.0 - count(*) FILTER (x = 1) * count(*) FILTER (x = 0) / 2.0 END"""


@query(f"""WITH named AS (SELECT CAST(s_nationkey AS VARCHAR) AS g, s_suppkey AS id, s_acctbal AS v, s_suppkey % 17 AS w FROM supplier),
pairs AS (SELECT g, id, CAST({RANK.format(by='g', x='v')} AS DOUBLE) AS x, CAST({RANK.format(by='g', x='w')} AS DOUBLE) AS y FROM named)""" + NULL_SQL.format(rounds=200, statistic=CORRELATION_SQL))
def permutation_test(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").selectExpr("CAST(s_nationkey AS STRING) AS g", "s_suppkey AS id", "s_acctbal AS v", "s_suppkey % 17 AS w")
    ranked = permutation.average_ranks(permutation.average_ranks(rows, ["g"], "v", "x"), ["g"], "w", "y")
    return permutation.permutation_p(ranked, ["g"], "id", "x", "y").withColumn("observed", F.round("observed", 6) + F.lit(0.0))


@query(f"""WITH pairs AS (SELECT g, id, side AS x, CAST({RANK.format(by='g', x='v')} AS DOUBLE) AS y FROM (SELECT lang AS g, doc_id AS id, toxic AS side, n_chars AS v FROM documents JOIN labels USING (doc_id)))""" + NULL_SQL.format(rounds=100, statistic=EXCESS_SQL))
def mann_whitney_p(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").selectExpr("lang AS g", "doc_id AS id", "toxic AS side", "n_chars AS v")
    ranked = permutation.average_ranks(rows, ["g"], "v", "r")
    return permutation.permutation_p(ranked, ["g"], "id", "side", "r", permutation.rank_sum_excess, 100).withColumn("observed", F.round("observed", 6) + F.lit(0.0))


@query("""WITH mapping AS (SELECT DISTINCT 'p' || (p_size % 30) AS path FROM part), vocabulary AS (SELECT DISTINCT 'p' || (s_suppkey % 25) AS path FROM supplier), used AS (SELECT DISTINCT 'p' || (c_custkey % 40) AS path FROM customer),
every AS (SELECT path FROM mapping UNION SELECT path FROM vocabulary UNION SELECT path FROM used),
flags AS (SELECT path, path IN (SELECT path FROM mapping) AS mapped, path IN (SELECT path FROM vocabulary) AS accepted, path IN (SELECT path FROM used) AS used FROM every)
SELECT *, CASE WHEN mapped AND NOT accepted THEN 'rejected' WHEN mapped THEN 'ok' WHEN used THEN 'missing' ELSE 'unmapped' END AS status FROM flags""")
def class_map_validate(spark, sf_dir):
    path = lambda name, e: table(spark, sf_dir, name).selectExpr(f"'p' || ({e}) AS path")
    return analysis.vocabulary_check(path("part", "p_size % 30"), path("supplier", "s_suppkey % 25"), path("customer", "c_custkey % 40"))


@query("WITH " + DEMO_SQL + """ SELECT tool || ':' || family AS member, count(*) FILTER (e - s >= 490) AS n_full FROM hits GROUP BY ALL ORDER BY n_full DESC, member LIMIT 20""")
def topk_candidates(spark, sf_dir):
    rows = demo_hits(spark, sf_dir).groupBy(F.concat_ws(":", "tool", "family").alias("member")).agg(F.count_if(F.expr("e - s >= 490")).alias("n_full"))
    return rows.orderBy(F.col("n_full").desc(), "member").limit(20)


@query("WITH " + DEMO_SQL + """ SELECT tool, CAST(least(floor(log10(e - s) * 10), 27) AS BIGINT) AS bin, count(*) AS n FROM hits GROUP BY ALL""")
def length_histogram(spark, sf_dir):
    return demo_hits(spark, sf_dir).groupBy("tool", F.least(F.floor(F.log10(F.expr("e - s")) * 10), F.lit(27)).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


@query("WITH " + DEMO_SQL + """,
rounded AS (SELECT tool, family, cons_len, count(*) AS n FROM hits WHERE cons_len IS NOT NULL GROUP BY ALL),
modal AS (SELECT tool, family, cons_len AS modal FROM (SELECT *, row_number() OVER (PARTITION BY tool, family ORDER BY n DESC, cons_len) AS r FROM rounded) WHERE r = 1)
SELECT h.tool, h.family, any_value(modal) AS modal, round(avg(CASE WHEN abs(cons_len - modal) <= greatest(1, 0.01 * modal) THEN 1.0 ELSE 0.0 END), 6) AS share FROM hits h JOIN modal USING (tool, family) WHERE cons_len IS NOT NULL GROUP BY ALL""")
def modal_length(spark, sf_dir):
    hits = demo_hits(spark, sf_dir).filter("cons_len IS NOT NULL")
    modal = hits.groupBy("tool", "family").agg(F.mode("cons_len", True).alias("modal"))
    near = F.expr("CASE WHEN abs(cons_len - modal) <= greatest(1, 0.01 * modal) THEN 1.0D ELSE 0.0D END")
    return hits.join(modal, ["tool", "family"]).groupBy("tool", "family").agg(F.first("modal").alias("modal"), F.round(F.avg(near), 6).alias("share"))
