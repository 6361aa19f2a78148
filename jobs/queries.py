"""The jobs as queries on the shared tables, each run twice into one new folder, and the same in SQL."""

from __future__ import annotations

from jobs import annotation_store, sequence_intake
from spanforge.operators.sequences import LETTERS, OPPOSITE
from spanforge.plans.registry import GAP_SQL, query
from spanforge.session import scratch_path
from spanforge.sources.hits import SEQUENCE_SQL

_RC = f"reverse(translate(seq, '{LETTERS}', '{OPPOSITE}'))"


@query("WITH " + GAP_SQL + """,
merged AS (SELECT tool, family, CAST(sum(CASE WHEN coalesce(joins, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_copies FROM gapped GROUP BY ALL),
counted AS (SELECT tool, family, cons_len, count(*) AS n FROM hits WHERE cons_len IS NOT NULL GROUP BY ALL),
modal AS (SELECT tool, family, cons_len AS modal_len FROM (SELECT *, row_number() OVER (PARTITION BY tool, family ORDER BY n DESC, cons_len) AS r FROM counted) WHERE r = 1),
figures AS (
  SELECT tool, family, count(*) AS n_hits, count(*) FILTER (cons_start <= 20 AND cons_end >= cons_len - 20 AND (cons_end - cons_start) / cons_len >= 0.8) AS n_full_len, round(median(div), 6) AS div_median
  FROM hits GROUP BY ALL),
marked AS (SELECT tool, family, chrom, s, e, CASE WHEN max(e) OVER (PARTITION BY tool, family, chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= s THEN 0 ELSE 1 END AS new FROM hits WHERE e > s),
islands AS (SELECT *, sum(new) OVER (PARTITION BY tool, family, chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM marked),
covered AS (SELECT tool, family, CAST(sum(bp) AS BIGINT) AS genomic_bp FROM (SELECT tool, family, max(e) - min(s) AS bp FROM islands GROUP BY tool, family, chrom, run) GROUP BY ALL),
spans AS (SELECT tool, family, cons_start AS a, cons_end AS b FROM hits WHERE cons_start IS NOT NULL AND cons_end >= cons_start),
steps AS (SELECT tool, family, pos, sum(d) AS d FROM (SELECT tool, family, a AS pos, 1 AS d FROM spans UNION ALL SELECT tool, family, b + 1, -1 FROM spans) GROUP BY ALL),
depths AS (SELECT tool, family, pos, sum(d) OVER w AS depth, lead(pos) OVER w AS upto FROM steps WINDOW w AS (PARTITION BY tool, family ORDER BY pos)),
deep AS (
  SELECT tool, family, sum(greatest(least(upto, modal_len + 1) - greatest(pos, 1), 0)) / any_value(modal_len) AS share
  FROM depths JOIN modal USING (tool, family) WHERE depth >= 3 AND modal_len > 0 GROUP BY ALL)
SELECT tool, family, n_hits, n_copies, n_full_len, coalesce(genomic_bp, 0) AS genomic_bp, modal_len,
       CASE WHEN modal_len > 0 THEN round(coalesce(share, 0), 6) END AS cov_ge3_frac, div_median
FROM figures JOIN merged USING (tool, family) LEFT JOIN modal USING (tool, family) LEFT JOIN covered USING (tool, family) LEFT JOIN deep USING (tool, family)""")
def job1_annotation_store(spark, sf_dir):
    store = scratch_path(spark, "annotation-store")
    for _ in range(2):
        evidence = annotation_store.run(spark, f"{sf_dir}/lineitem.parquet", store)
    return evidence.drop("bucket")


@query(rf"""
WITH seqs AS (
  SELECT doc_id, source, lang, {SEQUENCE_SQL} AS seq, row_number() OVER () AS row
  FROM documents),
halves AS (SELECT *, least(120, length(seq) // 2) AS n, {_RC} AS rc FROM seqs),
places AS (SELECT row, i, CASE WHEN seq[i] = rc[i] THEN 0 ELSE 1 END AS miss FROM (SELECT row, seq, rc, unnest(range(1, n + 1)) AS i FROM halves)),
run AS (SELECT row, i, sum(miss) OVER (PARTITION BY row ORDER BY i) AS missed FROM places),
ends AS (
  SELECT row, CAST(coalesce(max(i) FILTER (missed <= 0), 0) AS INTEGER) AS tir_0, CAST(coalesce(max(i) FILTER (missed <= 1), 0) AS INTEGER) AS tir_1,
         CAST(coalesce(max(i) FILTER (missed <= 2), 0) AS INTEGER) AS tir_2, CAST(coalesce(max(i) FILTER (missed <= 3), 0) AS INTEGER) AS tir_3
  FROM halves LEFT JOIN run USING (row) GROUP BY row),
measures AS (
  SELECT doc_id, source, lang, length(seq) AS length, length(seq) - length(replace(seq, 'N', '')) AS n_count, length(seq) - length(translate(seq, 'CG', '')) AS gc_count,
         sha256(least(seq, rc)) AS digest, tir_0, tir_1, tir_2, tir_3
  FROM halves JOIN ends USING (row))
SELECT *, count(*) OVER d AS n_copies, min(doc_id) OVER d AS first_id, (SELECT count(DISTINCT source) FROM measures m WHERE m.digest = measures.digest) AS n_sources
FROM measures WINDOW d AS (PARTITION BY digest)""")
def job2_sequence_intake(spark, sf_dir):
    output = scratch_path(spark, "sequence-intake")
    for _ in range(2):
        rows = sequence_intake.run(spark, f"{sf_dir}/documents.parquet", output)
    return rows
