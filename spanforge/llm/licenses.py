"""License scans: phrases at their places, and templates found by an exact set-similarity join.

A block of a template is a window of ``SPAN`` times its words, which goes on across line ends, so
wrapped notices are found and words scattered more widely aren't. Windows begin at each word of the
template; no other window holds more of them. A line of no more words than that is a block too, of
all templates at once. A template is found in a block that holds at least ``threshold`` of its
distinct words. Words are ordered by how many documents have them, rarest first; with a
template of n words, of which a block must have at least m, any such block has one of the
template's first n - m + 1 words among its own first words but m - 1 (prefix filter), has m words
of the templates at least (length filter), and from the first common word on both still hold m
words (positional filter). What passes is verified. DataFrame operations only.

Edge cases: a null text counts as empty; rows that share a doc_id stay apart; labels found in
several ways come once; an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.session import cut, let

#: What separates words once A-Z are in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window by words of its template, so that a notice with some words between its own is found.
SPAN = 2
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("public-domain", "dedicated to the public domain"),
    ("reserved", "copyright all rights reserved"),
)


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case. The two other letters that turn into ASCII ones are replaced first; what
    other letters turn into is neither a gap nor a word of a phrase."""
    plain = F.replace(F.replace(text, F.lit("K"), F.lit("ß")), F.lit("İ"), F.lit("ß"))
    return F.lower(plain)


def _places(parts: Column, phrase: str, label: str) -> Column:
    words = phrase.split()
    at = lambda i: [F.get(parts, i + k) == w for k, w in enumerate(words)]

    def stands(i: Column) -> Column:
        every = at(i)
        out = every[0]
        for x in every[1:]:
            out = out & x
        return F.coalesce(out, F.lit(False))

    return F.transform(F.filter(F.sequence(F.lit(0), F.size(parts) - 1), stands), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = 0.9) -> DataFrame:
    """docs(doc_id, text) as doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: 1 where a phrase stands, else the largest share of a template's words found in a block
    that meets the threshold, else 0. phrases and templates are parameters, so their size is known.
    """
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    spans = [SPAN * len(text.split()) for _, text in templates]
    need = [math.ceil(threshold * len(words) - 1e-9) for _, words in sets]
    vocabulary = sorted({w for _, words in sets for w in words})
    vocab = F.array(*map(F.lit, vocabulary))
    lower = ascii_lower(F.coalesce("text", F.lit("")))

    def near(text: Column) -> Column:
        """Whether a text holds the words of a phrase at all; the places are looked for only there."""
        out = F.lit(False)
        for phrase, _ in phrases:
            every = F.lit(True)
            for word in sorted(phrase.split(), key=len, reverse=True):
                every = every & F.contains(text, F.lit(word))
            out = out | every
        return out

    nowhere = F.array().cast("array<struct<at:int,label:string>>")

    def of_words(text: Column) -> Column:
        def inner(parts: Column) -> Column:
            lead = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
            trail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
            base = F.when(near(text), F.concat(*[_places(parts, p, label) for p, label in phrases])).otherwise(nowhere)
            return F.struct(
                (F.size(parts) - lead - trail).cast("bigint").alias("n_words"), lead.alias("lead"),
                F.array_intersect(parts, vocab).alias("tokens"), base.alias("base"),
            )

        return let(F.split(text, GAP), inner)

    def enough(tokens: Column) -> Column:
        out = F.lit(False)
        for (_, words), m in zip(sets, need, strict=True):
            out = out | (F.size(F.array_intersect(tokens, F.array(*map(F.lit, words)))) >= m)
        return out

    no_blocks = F.array().cast("array<struct<own:int,length:int,block:array<string>>>")

    def windows_of(t: int, parts: Column, own: Column) -> Column:
        def window(hits: Column, hit: Column, i: Column) -> Column:
            near = F.filter(F.slice(hits, i + 1, F.lit(spans[t])), lambda x: x["at"] < hit["at"] + spans[t])
            return F.struct(F.lit(t).alias("own"), F.lit(0).alias("length"), F.array_distinct(F.transform(near, lambda x: x["token"])).alias("block"))

        placed = F.filter(F.transform(parts, lambda w, i: F.struct(i.alias("at"), w.alias("token"))), lambda x: F.array_contains(own, x["token"]))
        return let(placed, lambda hits: F.array_distinct(F.filter(F.transform(hits, lambda hit, i: window(hits, hit, i)), lambda b: F.size(b["block"]) >= need[t])))

    def windows(parts: Column, tokens: Column) -> Column:
        """Of each template that the whole text could hold, the windows with enough of its words."""
        out = []
        for t, (_, words) in enumerate(sets):
            own = F.array(*map(F.lit, words))
            out.append(F.when(F.size(F.array_intersect(tokens, own)) >= need[t], windows_of(t, parts, own)).otherwise(no_blocks))
        return F.concat(*out)

    def line_block(line: Column) -> Column:
        def inner(parts: Column) -> Column:
            return F.struct(F.lit(-1).alias("own"), F.size(F.array_remove(parts, "")).alias("length"), F.array_intersect(parts, vocab).alias("block"))

        return let(F.split(line, GAP), inner)

    def whole(text: Column) -> Column:
        def inner(found: Column) -> Column:
            lines = F.transform(F.split(text, "\n"), line_block)
            lines = F.filter(lines, lambda b: (F.size(b["block"]) >= min(need)) & (b["length"] <= max(spans)))
            every = F.concat(lines, let(F.split(text, GAP), lambda parts: windows(parts, found["tokens"])))
            return F.struct(found.alias("found"), F.when(enough(found["tokens"]), every).otherwise(no_blocks).alias("blocks"))

        return let(of_words(text), inner)

    light = docs.select("doc_id", let(lower, whole).alias("w"))
    at = F.transform("w.found.base", lambda x: x["at"])
    light = light.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("w.found.n_words").alias("n_words"),
        F.size("w.found.base").cast("bigint").alias("n_base"),
        (F.array_min(at) - F.col("w.found.lead")).cast("bigint").alias("first_word"), (F.array_max(at) - F.col("w.found.lead")).cast("bigint").alias("last_word"),
        F.array_distinct(F.transform("w.found.base", lambda x: x["label"])).alias("base"), F.col("w.found.tokens").alias("tokens"), F.col("w.blocks").alias("blocks"),
    )
    light = cut(light)

    # as many rows as the templates have words
    frequency = {r["token"]: r["n"] for r in light.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = F.create_map(*[x for i, w in enumerate(order) for x in (F.lit(w), F.lit(i))])
    prefixes = []
    for t, ((label, words), m) in enumerate(zip(sets, need, strict=True)):
        ranked = sorted(words, key=order.index)
        prefixes += [(w, t, label, i, len(words), m, words, spans[t]) for i, w in enumerate(ranked[: len(words) - m + 1])]
    spark = docs.sparkSession
    known = spark.createDataFrame(prefixes, "token string, template int, label string, t_pos int, t_size int, need int, t_words array<string>, t_span int")

    ranked = F.array_sort(F.transform("block", lambda w: F.struct(rank[w].alias("rank"), w.alias("token"))))
    blocks = light.filter(F.size("blocks") > 0).select("row", F.inline("blocks")).select("row", "own", "length", ranked.alias("ranked"), "block")
    probes = blocks.select("row", "own", "length", "block", F.posexplode("ranked").alias("b_pos", "x")).select("row", "own", "length", "block", "b_pos", F.col("x.token").alias("token"))
    pairs = probes.join(F.broadcast(known), "token").filter("own = template OR (own = -1 AND length <= t_span)")
    size = F.size("block")
    pairs = pairs.filter((size >= F.col("need")) & (F.col("b_pos") <= size - F.col("need")))
    pairs = pairs.filter(F.least(F.col("t_size") - F.col("t_pos"), size - F.col("b_pos")) >= F.col("need"))
    share = F.size(F.array_intersect("block", "t_words")) / F.col("t_size")
    found = pairs.filter(F.size(F.array_intersect("block", "t_words")) >= F.col("need")).groupBy("row").agg(F.collect_set("label").alias("more"), F.max(share).alias("share"))

    out = light.join(found, "row", "left")
    join = lambda labels: F.array_join(F.array_sort(labels), ",")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", join("base").alias("base_labels"),
        join(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
