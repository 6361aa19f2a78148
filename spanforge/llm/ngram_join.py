"""N-gram Jaccard join over whole texts, by prefix filters under several global token orders.

A text's tokens are 64-bit hashes of its distinct word shingles. Two texts link when
100 * |A and B| >= percent * |A or B|; such texts share a token among the first
n - ceil(percent * n / 100) + 1 of their tokens under any one order of all tokens. Three orders
are used: tokens by how many texts have them, tokens by hash upwards, and by hash downwards.

1. Every text gives its set's size and digest, and its tokens of the lowest hashes: all below
   ``region`` of the hash's range, and as many as its prefix has at least. In the first order
   these come before all others.
2. Tokens of one set only are counted away. A set of which these fill the whole prefix links
   with none; the others, live ones, post the rest of their prefix, rarest first. Equal sets are
   one from here on.
3. Sets under a token pair up: all of a short posting list, and every set of a long one with a
   few hubs, so that a group of n copies makes a multiple of n pairs. Pairs whose sizes and
   token parities fit get the prefixes of both sets under the second and third order by join; those
   that share a token under each are verified on whole sets.
4. Where a long list still holds several components, its sets post again under an order of which
   the tokens that step 2 counted away come first and then a further slice of the hash range, so
   each makes only that slice; they pair as in step 3.
5. Where a long list of these holds several components yet, its sets post under a first order of
   all their tokens, pair with hubs of that order, and then each set outside a list's main
   component pairs with all of it that is in another component.
Components are those of the verified links; copies follow their set.

Edge cases: null texts and texts without words have no shingles and link with nothing; rows that
share a doc_id stay apart as texts and may be in different components; an empty table gives an
empty result; further columns are left alone. ``keep_one`` keeps one row of each component, that
with the smallest doc_id (null last) and then the smallest hash of its text, whatever other rows
share its doc_id; of repeated rows it keeps one; texts without words all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.functions.graph import connected_components
from spanforge.llm.spread import hot_keys, spread_join, unused
from spanforge.llm.words import DARK, Texts, Words, mix64, pieces, shingles
from spanforge.session import cut, remove_table, written

#: One row of a posting list pairs with all others up to this length, beyond it with hubs.
SHORT = 48
HUBS = 3
#: Parities of a set's tokens by 512 hash classes, as longs. Two sets differ in one token at least for each parity that differs.
BITS = [f"b{i}" for i in range(8)]
#: Bits of the filter by which tasks pass over texts that no candidate pair needs; 2 ** 27 are 16 MB.
FILTER_BITS = 27
#: Pairs under one token that a task compares.
TASK_PAIRS = 1_000_000


def token_sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in rising order, their bounds, and a digest of each set."""
    words = Words(Texts(batch.column("text")), DARK)
    made, bounds = shingles(words.hashes(), words.bounds, k)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((made, row))
    made, row = made[order], row[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (row[1:] != row[:-1])
    made, row = made[new], row[new]
    bounds = np.searchsorted(row, np.arange(len(bounds)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(made ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    digest = mix64(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return made, bounds, digest


def prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def _posted(made: np.ndarray, bounds: np.ndarray, percent: int, region: float) -> np.ndarray:
    """How many tokens of lowest hashes each set posts."""
    n = np.diff(bounds)
    top = np.uint64(min(int(region * 2**64), 2**64 - 1))
    below = np.concatenate([[0], np.cumsum(made < top)])
    return np.minimum(np.maximum(below[bounds[1:]] - below[bounds[:-1]], prefix(n, percent)), n)


def _parities(made: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    odd = np.bincount(row * 512 + (made >> np.uint64(20) & np.uint64(511)).astype(np.int64), minlength=512 * (len(bounds) - 1)) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(-1, 512), axis=1).view(np.int64).reshape(-1, 8)
    return [pa.array(np.ascontiguousarray(packed[:, i])) for i in range(8)]


def _sizes(k: int, percent: int, region: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            made, bounds, digest = token_sets(part, k)
            posted = _posted(made, bounds, percent, region)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(bounds), pa.int64()), pa.array(posted, pa.int64()), pa.array(digest.view(np.int64)), *_parities(made, bounds)], names=["doc_id", "text_hash", "n", "posted", "node", *BITS])

    return run


def _rows(node: np.ndarray, token: np.ndarray, most: int = 200_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(node), most):
        yield pa.RecordBatch.from_arrays([pa.array(node[i : i + most].view(np.int64)), pa.array(token[i : i + most].view(np.int64))], names=["node", "token"])


def _low_tokens(k: int, percent: int, region: float):
    """node, token rows of each set's lowest hashes; equal sets of a part come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            made, bounds, digest = token_sets(part, k)
            _, first = np.unique(digest, return_index=True)
            take = np.zeros(len(digest), np.int64)
            take[first] = _posted(made, bounds, percent, region)[first]
            at = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(take)[:-1]]), take) + np.arange(take.sum())
            yield from _rows(np.repeat(digest, take), made[at])

    return run


def _all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, tokens in zip(batch.column("node").to_pylist(), batch.column("tokens"), strict=True):
            token = np.frombuffer(tokens.as_py(), np.uint64)
            yield from _rows(np.full(len(token), node, np.int64), token)


def _next_tokens(percent: int, region: float, width: float):
    """Of rows node, room, posted, tokens of a first posting below region, with room left: the tokens that follow.

    slice: tokens by their distance above region, round the hash's range: those nearer than width,
    and as many as the room at least. posted: their number and that of the lone ones before, so
    that it stands for a posting of both. These aren't relied on where a set has posted beyond
    region, as others needn't have then, or hasn't tokens enough above: it fills its prefix anew.
    """
    start, near = np.uint64(min(int(region * 2**64), 2**64 - 1)), np.uint64(min(int(width * 2**64), 2**64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, room, before, tokens in zip(*(batch.column(x).to_pylist() for x in ("node", "room", "posted")), batch.column("tokens"), strict=True):
                own = np.sort(np.frombuffer(tokens.as_py(), np.uint64) - start)
                n = len(own)
                most = int(prefix(n, percent))
                lone = most - room if before > most and n - before >= room else 0
                own = own[: max(int(np.searchsorted(own, near)), most - lone)]
                yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([n], pa.int64()), pa.array([lone + len(own)], pa.int64()), pa.array([own.view(np.int64)], pa.list_(pa.int64()))], names=["node", "n", "posted", "slice"])

    return run


def _prefixes(tokens: DataFrame, sizes: DataFrame, percent: int, region: float) -> DataFrame:
    """node, n, room, token: the tokens of each set's prefix under the first order that another set has too.

    tokens(node, token): the posted ones; sizes(node, n, posted). Tokens below region come first,
    of these the lone ones, then by texts, then by hash. Lone ones only take up room.

    The tokens are made and shuffled once, and counted where they lie by a window, which spills; a token has a row a text at most.
    """
    same = Window.partitionBy("token")
    shared = tokens.select("node", "token", F.count("*").over(same).alias("texts"), F.min("node").over(same).alias("low"), F.max("node").over(same).alias("high")).filter("low <> high")
    rising = F.col("token").bitwiseXOR(F.lit(-(2**63)))  # as signed numbers in the order of the unsigned ones
    outside = rising >= F.lit(int(region * 2**64) - 2**63 if region < 1 else 2**63 - 1)
    place = F.struct(outside.alias("outside"), F.when(outside, F.lit(0)).otherwise(F.col("texts")).alias("texts"), rising.alias("rising"), "token")
    ranked = shared.groupBy("node").agg(F.array_sort(F.collect_set(place)).alias("shared")).join(sizes, "node")
    room = (F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1 - (F.col("posted") - F.size("shared"))).cast("int")
    live = ranked.withColumn("room", room).filter("room > 0")
    return live.select("node", "n", "room", F.explode(F.slice("shared", F.lit(1), F.col("room"))).alias("x")).select("node", "n", "room", F.col("x.token").alias("token"))


def _fits(percent: int):
    """Whether sizes and parities of columns a and b, structs (node, n, b0, ...), allow the threshold."""
    apart = sum((F.bit_count(F.col(f"a.{x}").bitwiseXOR(F.col(f"b.{x}"))) for x in BITS[1:]), F.bit_count(F.col(f"a.{BITS[0]}").bitwiseXOR(F.col(f"b.{BITS[0]}"))))
    near = (100 - percent) * (F.col("a.n") + F.col("b.n")) >= (100 + percent) * apart
    return (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & near


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))


def _first_pairs(posts: DataFrame, sizes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of short lists, and of long ones with their hubs; and the rows token, node, room of long lists."""
    rows = cut(_listed(posts))
    long = rows.filter(F.col("length") > SHORT)
    short = rows.filter(F.col("length") <= SHORT).join(sizes.select("node", *BITS), "node").select("token", F.struct("node", "n", *BITS).alias("a"))
    near = short.join(short.withColumnRenamed("a", "b"), "token").filter(F.col("a.node") < F.col("b.node")).filter(_fits(percent))
    return cut(_pairs(near).unionByName(_star(long, sizes, percent)).distinct()), long.select("token", "node", "room")


def _undecided(long: DataFrame, placed: DataFrame) -> DataFrame:
    """node, room of the sets in long lists that hold several components."""
    mixed = long.join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = mixed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return cut(long.join(mixed.select("token"), "token").select("node", "room").distinct())


def _listed(posts: DataFrame) -> DataFrame:
    """The posts with the length and hubs of their token's list, if others are in it; a long list is dealt over tasks."""
    lists = cut(posts.groupBy("token").agg(F.count("*").alias("length"), _hubs().alias("hubs")).filter("length > 1"))
    return spread_join(posts, lists, "token", hot_keys(lists, "token", "length"))


def _hubs():
    """Of a token's sets the one with most room, which has the fewest tokens of its own, and some by hash."""
    return F.array(F.max_by("node", F.struct("room", "node")), *[F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(1, HUBS)])


def _star(rows: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows(node, hubs) with their hubs that fit."""
    ends = sizes.select(F.struct("node", "n", *BITS).alias("x"))
    far = cut(rows.select(F.col("node").alias("left"), F.explode("hubs").alias("right")).filter("left <> right").distinct())
    far = spread_join(far, ends.select(F.col("x.node").alias("right"), F.col("x").alias("b")), "right", hot_keys(far, "right"))
    far = far.join(ends.select(F.col("x.node").alias("left"), F.col("x").alias("a")), "left")
    return _pairs(far.filter(_fits(percent)))


def _late_pairs(posts: DataFrame, sizes: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components under a token, each with one side outside the token's main component."""
    placed = posts.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = placed.groupBy("token", "component").agg(F.count("*").alias("c"))
    main = counts.groupBy("token").agg(F.max_by("component", "c").alias("main"), F.count("*").alias("parts")).filter("parts > 1").select("token", "main")
    placed = cut(placed.join(main, "token").join(sizes.select("node", *BITS), "node").select("token", "component", "main", F.struct("node", "n", *BITS).alias("a")))
    # the sets outside are dealt so that a task compares about TASK_PAIRS; all of the list goes to each of its parts
    outside = F.count_if(F.col("component") != F.col("main"))
    parts = placed.groupBy("token").agg(F.greatest(F.lit(1), F.least(outside, F.ceil(outside * F.count("*") / TASK_PAIRS))).cast("int").alias("parts"))
    dealt = placed.join(parts, "token")
    left = dealt.filter("component <> main").select("token", F.pmod(F.xxhash64("a.node"), F.col("parts")).cast("int").alias("part"), "a", F.col("component").alias("a_part"))
    right = dealt.select("token", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("b"), F.col("component").alias("b_part"))
    return cut(_pairs(left.join(right, ["token", "part"]).filter("a_part <> b_part").filter(_fits(percent))).distinct())


def _sets(docs: DataFrame, sizes: DataFrame, wanted: DataFrame, k: int, percent: int) -> tuple[DataFrame, str]:
    """node, tokens (bytes), low and high (the prefixes by rising and by falling hash) of the wanted nodes, from the text with each one's smallest doc_id; and where this is written.

    Tasks get a filter of a bounded number of bits, 64 a wanted node below that, which lets all
    wanted texts pass and the more of the others the more are wanted; what passes is joined with
    the wanted nodes. Texts of one node have the same set, so any of them will do.
    """
    named = cut(wanted.select("node").distinct().join(sizes.select("node", F.col("doc_id").alias("own")), "node"))
    width = min(FILTER_BITS, max(6, (64 * named.count()).bit_length()))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slots(batch.column("node"), batch.column("own"), width)
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (slot & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    words = named.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(1 << width - 6, np.int64)
    held[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            made, bounds, digest = token_sets(part, k)
            slot = _slots(pa.array(digest.view(np.int64)), part.column("doc_id"), width)
            passes = (shared.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)).astype(np.int64)) & 1
            for i in np.flatnonzero((passes == 1) & (np.diff(bounds) > 0)):
                own = made[bounds[i] : bounds[i + 1]]
                p = prefix(len(own), percent)
                ends = [pa.array([x.view(np.int64)], pa.list_(pa.int64())) for x in (own[:p], own[-p:])]
                yield pa.RecordBatch.from_arrays([pa.array(digest[i : i + 1].view(np.int64)), pa.array([own.tobytes()], pa.binary()), *ends], names=["node", "tokens", "low", "high"])

    found = docs.mapInArrow(run, "node long, tokens binary, low array<long>, high array<long>")
    # written, so that joins read the columns they need and one exchange serves both ends of a pair
    sets, path = written(found.join(named.select("node"), "node").dropDuplicates(["node"]), "token-sets")
    shared.destroy()
    return sets, path


def _slots(node: pa.Array, doc: pa.Array, width: int) -> np.ndarray:
    """The filter's bit for a node's text under a doc_id."""
    own = doc.fill_null(-(2**63)).to_numpy(zero_copy_only=False).view(np.uint64)
    return mix64(node.to_numpy().view(np.uint64) ^ mix64(own)) >> np.uint64(64 - width)


def _candidates(pairs: DataFrame, sets: DataFrame, hot: dict) -> DataFrame:
    """The pairs that share prefix tokens by rising and by falling hash too."""
    ends = {x: sets.select(F.col("node").alias(x), F.col("low").alias(f"low_{x}"), F.col("high").alias(f"high_{x}")) for x in "ab"}
    shares = F.arrays_overlap("low_a", "low_b") & F.arrays_overlap("high_a", "high_b")
    return spread_join(spread_join(pairs, ends["a"], "a", hot), ends["b"], "b", hot, ["a", "b"]).filter(shares).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidates among the pairs whose sets meet the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(a, b, True))
                keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    hot = hot_keys(pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
    near = cut(_candidates(pairs, sets, hot))
    first = spread_join(near, sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a", hot)
    return cut(spread_join(first, sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b", hot, ["a", "b"]).select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def components(docs: DataFrame, k: int, percent: int, region: float | None = None) -> DataFrame:
    """docs(doc_id, text) as doc_id, text_hash, n, and least: the component's smallest (none, doc_id, text_hash), null without words; one row for each row.

    region: the share of the hash range whose tokens are counted; by default four thirds of a
    prefix, so that a text of which a quarter of them are its own alone is left out.
    """
    region = (100 - percent) / 75 if region is None else region
    light = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    rows = cut(light.mapInArrow(_sizes(k, percent, region), "doc_id long, text_hash long, n long, posted long, node long, " + ", ".join(f"{x} long" for x in BITS)))
    sizes = cut(rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"), F.min("n").alias("n"), F.min("posted").alias("posted"), *[F.min(x).alias(x) for x in BITS]))

    tokens = light.mapInArrow(_low_tokens(k, percent, region), "node long, token long")
    posts = cut(_prefixes(tokens, sizes.select("node", "n", "posted"), percent, region))
    pairs, long = _first_pairs(posts, sizes, percent)
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(long.select("node"))
    sets, path = _sets(light.drop("text_hash"), sizes, named, k, percent)
    links = _linked(pairs, sets, percent)
    placed = connected_components(links)

    again = _undecided(long, placed)
    if not again.isEmpty():
        # a slice as wide as a prefix: most sets have enough tokens of their own in it
        width = (100 - percent) / 100
        more = sets.select("node", "tokens").join(again.join(sizes.select("node", "posted"), "node"), "node").select("node", "room", "posted", "tokens")
        more = cut(more.mapInArrow(_next_tokens(percent, region, width), "node long, n long, posted long, slice array<long>"))
        posts = cut(_prefixes(more.select("node", F.explode("slice").alias("token")), more.drop("slice"), percent, width))
        pairs, long = _first_pairs(posts, sizes, percent)
        links = links.unionByName(_linked(pairs, sets, percent))
        placed = connected_components(links)
        again = _undecided(long, placed)
    if not again.isEmpty():
        again = again.select("node")
        every = sets.join(again, "node").mapInArrow(_all_tokens, "node long, token long")
        own = sizes.join(again, "node").select("node", "n", F.col("n").alias("posted"))
        posts = cut(_prefixes(every, own, percent, 1.0))
        # first with hubs again, now by all tokens, so that few sets are left outside main components
        star = _linked(cut(_star(_listed(posts), sizes, percent).distinct()), sets, percent)
        links = links.unionByName(star)
        placed = connected_components(links)
        more = _linked(_late_pairs(posts, sizes, placed, percent), sets, percent)
        if not more.isEmpty():
            placed = connected_components(links.unionByName(more))
    remove_table(docs.sparkSession, path)

    joined = sizes.select("node", "first").join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = joined.join(joined.groupBy("component").agg(F.min("first").alias("least")), "component").select("node", "least")
    return rows.select("doc_id", "text_hash", "n", "node").join(named, "node", "left").drop("node")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, region: float | None = None) -> DataFrame:
    """docs(doc_id, text) as doc_id, n_shingles, component_id (the smallest doc_id that links reach); one row for each row."""
    rows = components(docs, k, percent, region)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """docs with one row of each component, and all rows without words."""
    rows = components(docs, k, percent).filter("n > 0")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    doc, text, stay, many = (unused(docs, x) for x in ("__doc", "__hash", "__stays", "__many"))
    keys = cut(rows.groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(text), stays.alias(stay)).agg((F.count("*") > 1).alias(many)))
    own = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text))
    left = docs.join(keys.filter(~F.col(stay)), own, "left_anti")
    repeated = keys.filter(F.col(stay) & F.col(many)).select(doc, text)
    if repeated.isEmpty():
        return left
    once = left.join(repeated, own).dropDuplicates([doc, text]).select(docs.columns)
    return left.join(repeated, own, "left_anti").unionByName(once)
