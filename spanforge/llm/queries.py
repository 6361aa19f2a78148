"""The queries of this package's operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import ann, chat, decontaminate, licenses, mixing, near_vectors, ngram_join, search, substrings, tokens, toxicity, warc
from spanforge.session import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose a repeated passage, and those that keep it."""
    found = substrings.find_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "removed_words", F.size("spans").cast("bigint").alias("n_spans"), "spans", "kept_doc_ids")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"))
    records = warc.read_archive(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_trees(chat.linear_tree(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return chat.read_back(formatted).select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_copies(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_substrings": op2_substrings,
    "op3_mixing": op3_mixing,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_tokens": op6_tokens,
    "op7_ann": op7_ann,
    "op8_chat": op8_chat,
    "op9_ngram_join": op9_ngram_join,
    "op10_licenses": op10_licenses,
    "op11_search": op11_search,
    "op12_near_vectors": op12_near_vectors,
}

OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS draw,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS r
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM sources),
steps AS (
  SELECT *, row_number() OVER o AS pos,
         3 * sum(source_size) OVER () - 2 * coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         2 * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS under
  FROM weighed WHERE source_size > 0 WINDOW o AS (ORDER BY cap / weight, r)),
level AS (SELECT pos, rest, under FROM steps WHERE rest * weight <= cap * under ORDER BY pos LIMIT 1),
targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.pos < coalesce(l.pos, 1000000000) THEN CAST(s.cap AS DOUBLE)
              ELSE CAST(s.weight * l.rest AS DOUBLE) / CAST(l.under AS DOUBLE) END AS target
  FROM steps s LEFT JOIN level l ON true),
quotas AS (
  SELECT w.source, w.source_size, coalesce(t.target, 0.0) AS target, CAST(floor(coalesce(t.target, 0.0) + 0.5) AS BIGINT) AS quota
  FROM weighed w LEFT JOIN targets t ON w.source IS NOT DISTINCT FROM t.source),
placed AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.quota // greatest(q.source_size, 1) AS whole,
         q.quota % greatest(q.source_size, 1) AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + least(greatest(rest - start, 0), size) AS BIGINT) AS taken
FROM placed
"""

OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
spans AS (SELECT item_id, words, least(13, len(words)) AS n FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM spans)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n),
grams AS (SELECT row, n, i, array_to_string(words[i:i + n - 1], ' ') AS gram FROM places),
hits AS (SELECT row, item_id, g.n, i FROM grams g JOIN windows w ON g.n = w.n AND g.gram = w.gram),
covered AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""

OP5_SQL = r"""
WITH records AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS nth, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM records)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN first_id END AS refers_to
FROM ranked
"""

OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, len(regexp_extract_all(role || chr(10) || text, '</?s>|<</?SYS>>|<\|[a-z_]+\|>|\[/?INST\]'))
            + length(role) - length(replace(role, '\', '')) + length(text) - length(replace(text, '\', ''))
            + length(role) + length(text) + 17 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
lengths AS (SELECT row, doc_id, CAST(len(words) AS BIGINT) AS n FROM docs WHERE len(words) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
postings AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM docs) GROUP BY row, term),
asked AS (
  SELECT item_id, term, count(*) AS qtf
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
sizes AS (SELECT row, doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM lengths, totals),
scores AS (
  SELECT item_id, doc_id, row, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (row)
  GROUP BY item_id, doc_id, row),
ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _op10_sql() -> str:
    """Every window that begins with a word of a template, counted: the plain form of the join."""
    import math

    rows = ", ".join(
        f"({t}, '{label}', {w!r}, {len(set(text.split()))}, {math.ceil(0.9 * len(set(text.split())) - 1e-9)}, {licenses.SPAN * len(text.split())})"
        for t, (label, text) in enumerate(licenses.TEMPLATES) for w in sorted(set(text.split()))
    )
    places = " UNION ALL ".join(
        f"SELECT row, unnest(list_filter(range(0, len(words)), lambda i: {' AND '.join(f'words[i + {k + 1}] = {w!r}' for k, w in enumerate(phrase.split()))})) AS place, '{label}' AS label FROM cut"
        for phrase, label in licenses.PHRASES
    )
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
cut AS (SELECT row, doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM docs),
places AS ({places}),
base AS (SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base FROM places GROUP BY row),
templates(template, label, word, size, need, span) AS (VALUES {rows}),
hits AS (SELECT * FROM (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS place FROM cut) JOIN templates USING (word)),
rich AS (SELECT row, template FROM hits GROUP BY row, template HAVING count(DISTINCT word) >= min(need)),
near AS (SELECT hits.* FROM hits JOIN rich USING (row, template)),
windows AS (
  SELECT a.row, a.template, a.place, any_value(a.label) AS label, any_value(a.size) AS size, any_value(a.need) AS need, count(DISTINCT b.word) AS n
  FROM near a JOIN near b ON a.row = b.row AND a.template = b.template AND b.place >= a.place AND b.place < a.place + a.span
  GROUP BY a.row, a.template, a.place),
found AS (SELECT row, list(DISTINCT label) AS more, max(CAST(n AS DOUBLE) / size) AS share FROM windows WHERE n >= need GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM cut LEFT JOIN base USING (row) LEFT JOIN found USING (row)
"""


ORACLE_SQL = {"op3_mixing": OP3_SQL, "op4_decontaminate": OP4_SQL, "op5_warc": OP5_SQL, "op8_chat": OP8_SQL, "op10_licenses": _op10_sql(), "op11_search": OP11_SQL}
