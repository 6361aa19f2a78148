"""Chat formatting of reply trees.

A message names its parent. Ancestor pointers are doubled by self-joins until every message has
its root, so a path of n messages takes about log2(n) joins; on the way the scores along a path
are summed. The leaves of a tree are ranked by that score, the best ``paths`` of them are kept,
and only their paths are expanded, again by doubling. Each path becomes one text:

    [INST]role[/INST]text</s>  for each turn

Control strings inside a role or text get a backslash behind their first character, after every
backslash has been doubled; ``unescape`` turns that back. DataFrame operations only.

Edge cases: a null role, text or score counts as empty or 0; a message whose parent isn't in the
tree is a root; messages on a cycle have no root and give no conversation; leaves with equal
scores rank by id; of rows that repeat a message id in a tree only one (by role, then text) stays
in ``format_trees``, while ``linear_tree`` numbers all of them; a null conversation id is a tree of its own; an empty
table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.session import cut, let

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
#: Doublings whose joins are planned together.
STEPS = 2
#: Strings that a tokenizer or a template may take for control.
CONTROL = r"<(/?s>|</?SYS>>|\|[a-z_]+\|>)|\[(/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    first = F.regexp_replace(doubled, r"<(?=/?s>|</?SYS>>|\|[a-z_]+\|>)", r"<\\")
    return F.regexp_replace(first, r"\[(?=/?INST\])", r"[\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_tree(rows: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) as a tree of one path: each turn replies to the one before."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    node = F.row_number().over(order).cast("bigint")
    return rows.select(F.col("conv_id").alias("tree_id"), node.alias("node_id"), (F.nullif(node - 1, F.lit(0))).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def best_paths(messages: DataFrame, paths: int | None = 1) -> DataFrame:
    """messages(tree_id, node_id, parent_id, score) as tree_id, path, node_id, from_leaf of the best paths.

    path counts from 1 by summed score, highest first. Only ids and scores are handled here.
    """
    key = F.coalesce(F.to_json(F.struct("tree_id")), F.lit(""))
    base = messages.select(key.alias("tree"), "tree_id", "node_id", "parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    nodes = base.groupBy("tree", "node_id").agg(F.first("tree_id").alias("tree_id"), F.min("parent_id").alias("parent_id"), F.max("score").alias("score")).filter("node_id IS NOT NULL")
    known = nodes.select("tree", F.col("node_id").alias("parent_id"), F.lit(True).alias("known"))
    nodes = cut(nodes.join(known, ["tree", "parent_id"], "left").withColumn("parent_id", F.when(F.col("known"), F.col("parent_id"))).drop("known"))

    # level k: the ancestor 2^k above, and the score summed over the nodes up to there; a node
    # that has reached its root takes no part in further joins
    level = cut(nodes.select("tree", "node_id", F.col("parent_id").alias("up"), F.col("score").alias("total"), F.lit(1).alias("depth")))
    rooted, levels = level.filter("up IS NULL"), []
    largest = nodes.groupBy("tree").count().agg(F.max("count")).head()[0] or 0
    for _ in range(int(largest).bit_length()):
        level = level.filter("up IS NOT NULL")
        if level.isEmpty():
            break
        levels.append(level)
        far = level.unionByName(rooted).select("tree", F.col("node_id").alias("up"), F.col("up").alias("next_up"), F.col("total").alias("more"), F.col("depth").alias("deeper"))
        level = cut(level.join(far, ["tree", "up"]).select("tree", "node_id", F.col("next_up").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("deeper")).alias("depth")))
        rooted = rooted.unionByName(level.filter("up IS NULL"))

    leaves = rooted.join(nodes.select("tree", F.col("parent_id").alias("node_id")).distinct(), ["tree", "node_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("total").desc(), "node_id"))
    leaves = leaves.select("tree", "node_id", F.col("total").alias("path_score"), "depth", rank.alias("path"))
    if paths is not None:
        leaves = leaves.filter(F.col("path") <= paths)
    members = leaves.select("tree", "path", "node_id", F.lit(0).cast("bigint").alias("from_leaf"), "path_score")
    for k in reversed(range(len(levels))):
        # a member stays, and its ancestor 2^k above joins it
        step = levels[k].select("tree", "node_id", "up")
        here = F.struct(F.col("node_id").alias("to"), F.lit(0).cast("bigint").alias("by"))
        above = F.struct(F.col("up").alias("to"), F.lit(2**k).cast("bigint").alias("by"))
        both = F.filter(F.array(here, above), lambda x: x["to"].isNotNull())
        members = members.join(step, ["tree", "node_id"], "left").withColumn("step", F.explode(both)).select("tree", "path", F.col("step.to").alias("node_id"), (F.col("from_leaf") + F.col("step.by")).alias("from_leaf"), "path_score")
        if k % STEPS == 0:
            # the driver holds the plan of some steps at a time, however long the paths are
            members = cut(members)
    return members


def format_trees(messages: DataFrame, paths: int | None = 1, learn: str = "assistant") -> DataFrame:
    """messages(tree_id, node_id, parent_id, role, text, score) as one row a chosen path.

    tree_id, path, path_score, formatted, and mask: for each turn the span (start, length, in
    characters from the turn's start) of the text to learn, null for turns of other roles.
    """
    members = best_paths(messages, paths)
    key = F.coalesce(F.to_json(F.struct("tree_id")), F.lit(""))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE))
    turns = messages.select(key.alias("tree"), "tree_id", "node_id", head.alias("head"), escape(text).alias("body"), (role == learn).alias("learn"))
    joined = members.join(turns, ["tree", "node_id"])
    segment = F.struct(
        (-F.col("from_leaf")).alias("at"), F.concat("head", "body", F.lit(CLOSE)).alias("segment"),
        F.when(F.col("learn"), F.struct(F.char_length("head").alias("start"), F.char_length("body").alias("length"))).alias("span"),
    )
    grouped = joined.groupBy("tree", "path").agg(F.first("tree_id").alias("tree_id"), F.first("path_score").alias("path_score"), F.array_sort(F.collect_list(segment)).alias("segments"))
    # of rows with one message id a single one stays
    kept = F.filter("segments", lambda x, i: (i == 0) | (F.get(F.col("segments"), i - 1)["at"] != x["at"]))
    return grouped.select("tree_id", "path", "path_score", let(kept, lambda s: F.struct(F.array_join(F.transform(s, lambda x: x["segment"]), "").alias("formatted"), F.transform(s, lambda x: x["span"]).alias("mask"))).alias("out")).select("tree_id", "path", "path_score", "out.formatted", "out.mask")


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted, mask of ``format_trees`` with turns (role, text) and learned (texts under the mask), parsed from the text alone."""
    parts = F.split("formatted", r"\Q" + CLOSE + r"\E")
    pieces = formatted.withColumn("pieces", let(parts, lambda p: F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))))
    turn = lambda s: F.struct(
        unescape(F.substring(F.substring_index(s, MIDDLE, 1), len(OPEN) + 1, 2147483647)).alias("role"),
        unescape(s.substr(F.char_length(F.substring_index(s, MIDDLE, 1)) + len(MIDDLE) + 1, F.char_length(s))).alias("text"),
    )
    under = lambda p, m: F.when(m.isNotNull(), unescape(p.substr(m["start"] + 1, m["length"])))
    learned = F.filter(F.zip_with("pieces", "mask", under), lambda x: x.isNotNull())
    return pieces.withColumn("turns", F.transform("pieces", turn)).withColumn("learned", learned).drop("pieces")
