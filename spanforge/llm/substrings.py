"""Substring dedup by content-defined chunks.

A gear hash rolls over the last 16 bytes before each word. A word where it hits and where neither
of the two words before was hit begins a chunk, so chunks have three words at least, about seven
on average, and the same boundaries wherever a passage stands, whatever was inserted before it;
chunks beyond 64 words are split by count. Where words repeat with a period of up to 32 for 20
words and two periods at least, hits do too, and there may be no such word however long it goes on;
such a passage begins and ends a chunk, and is split by whole periods of about 8 words from its
first word on that begins the smallest rotation of the period. A chunk's digest is 64 bits over its words, white space
aside. Of equal chunks that in the document with the smallest doc_id stays, and in one document
the first. Consecutive repeats form a run; runs of ``min_words`` words, ``min_support`` of which
have one and the same keeper, are cut, so that chance repeats of a few words stay.

Edge cases: a null or empty text has no chunks; rows that share a doc_id keep what they have in
common, each text by its own; a null doc_id is never cut nor kept for; a text cut as a whole
becomes empty; an empty table gives an empty result; further columns are kept by ``remove``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.spread import hot_keys, spread_join, unused
from spanforge.llm.words import BYTE, DARK, Texts, Words, mix64, pieces
from spanforge.session import cut

WINDOW = 16
LONGEST = 64
#: Periods of words that are looked for, the fewest words of a periodic passage, and the least of its chunks.
PERIODS = 32
PERIODIC = 20
PACE = 8
_GEAR = (BYTE >> np.uint64(13)).astype(np.uint16)
_STEP = 0xD1342543DE82EF95
SPANS = "array<struct<start:long,end:long>>"


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash that ends at each byte: the byte j places before counts shifted by j."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        before = np.zeros_like(h)
        before[width:] = h[:-width] if width <= len(h) else 0
        h = h + (before << np.uint16(width))
        width *= 2
    return h


def periodic(hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """First word, end and period of the passages whose words repeat, the shortest period first; no two overlap."""
    n, out = len(hashes), []
    within = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    covered = np.zeros(n, bool)
    for p in range(1, min(PERIODS, n - 1) + 1):
        same = (hashes[p:] == hashes[:-p]) & (within[p:] >= p)
        if out:
            same &= ~(covered[p:] | covered[:-p])
        edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
        first, end = edge[::2], edge[1::2] + p
        for s, e in zip(first, end, strict=True) if len(first) and (end - first).max() >= PERIODIC else ():
            s = max(s, out[-1][1]) if out and out[-1][2] == p else s
            if e - s >= max(PERIODIC, 2 * p):
                out.append((int(s), int(e), p))
                covered[s:e] = True
    return out


def chunks(words: Words, hashes: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of every chunk."""
    texts, n = words.texts, len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    since = words.start - np.repeat(texts.offsets[:-1], words.counts)
    value = gear(texts.data)[np.maximum(words.start - 1, 0)]
    hit = (value < int(rate * 65536)) & (since >= WINDOW)
    begin = hit.copy()
    begin[1:] &= ~hit[:-1]
    begin[2:] &= ~hit[:-2]
    for s, e, p in periodic(hashes, words.bounds):
        # hits at its end are those of a whole period, whatever stands before it
        if not begin[e - p : e].any():
            lead = min(range(p), key=lambda j: tuple(hashes[s + j : s + j + p]))
            begin[s:e] = False
            begin[s] = True
            begin[e : e + 1] = True
            begin[s + lead : e : p * -(-PACE // p)] = True
    begin[words.bounds[:-1][words.counts > 0]] = True
    first = np.flatnonzero(begin)
    length = np.diff(np.append(first, n))
    parts = -(-length // LONGEST)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    at = np.repeat(first, parts) + nth * LONGEST
    return at, np.diff(np.append(at, n))


def _sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    down = np.full(len(hashes) + 1, pow(_STEP, -1, 1 << 64), np.uint64)
    up = np.full(len(hashes) + 1, _STEP, np.uint64)
    down[0] = up[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[:-1], dtype=np.uint64)]), down


def _chunked(part: pa.RecordBatch, rate: float) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and of each chunk: row, first word in the row, words, digest; of each row the hash of its words."""
    words = Words(Texts(part.column("text")), DARK)
    hashes = words.hashes(lower=False)
    at, length = chunks(words, hashes, rate)
    total, down = _sums(hashes)
    digest = mix64((total[at + length] - total[at]) * down[at] + length.astype(np.uint64))
    row = np.searchsorted(words.bounds, at, side="right") - 1
    whole = mix64((total[words.bounds[1:]] - total[words.bounds[:-1]]) * down[words.bounds[:-1]])
    return words, row, at - words.bounds[row], length, digest, whole.view(np.int64)


def _emit(rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            _, row, first, length, digest, tag = _chunked(part, rate)
            # in one text all but the first of equal chunks are repeats
            order = np.lexsort((first, digest, row))
            same = np.zeros(len(row), bool)
            same[order[1:]] = (digest[order[1:]] == digest[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
            at = first << 8 | length
            yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), part.column("doc_id").take(pa.array(row)), pa.array(tag[row]), pa.array(np.where(same, -at - 1, at))], names=["digest", "doc_id", "tag", "at"])

    return run


def _runs(found: list[dict], min_words: int, min_support: int) -> tuple[list[dict], list[int]]:
    spans, keepers = [], set()
    places = sorted({(x["at"] >> 8, x["at"] & 255, x["kept"]) for x in found})
    i = 0
    while i < len(places):
        j = i
        while j + 1 < len(places) and places[j + 1][0] == places[j][0] + places[j][1]:
            j += 1
        run = places[i : j + 1]
        by: Counter = Counter()
        for _, n, kept in run:
            by[kept] += n
        kept, support = by.most_common(1)[0]
        if sum(n for _, n, _ in run) >= min_words and support >= min_support:
            spans.append({"start": run[0][0], "end": run[-1][0] + run[-1][1]})
            keepers.add(kept)
        i = j + 1
    return spans, sorted(keepers)


def find_repeats(docs: DataFrame, rate: float = 1 / 3, min_words: int = 20, min_support: int = 15) -> DataFrame:
    """docs(doc_id, text) as one row for each text that loses words.

    doc_id, tag (64-bit hash of the text's words, which tells rows that share the doc_id apart), removed_words, spans (of words,
    from 0, the end not included), kept_doc_ids (documents that keep the cut passages).
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id IS NOT NULL").mapInArrow(_emit(rate), "digest long, doc_id long, tag long, at long")
    shared = rows.groupBy("digest").agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("last"), F.min("at").alias("least"), F.count("*").alias("length"))
    shared = cut(shared.filter("kept < last OR least < 0").select("digest", "kept", "length"))
    repeats = spread_join(rows, shared, "digest", hot_keys(shared, "digest", "length")).filter("kept < doc_id OR at < 0")
    place = F.when(F.col("at") < 0, -F.col("at") - 1).otherwise(F.col("at"))
    grouped = repeats.select("doc_id", "tag", place.alias("at"), "kept").groupBy("doc_id", "tag").agg(F.collect_list(F.struct("at", "kept")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, tag, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "found")), strict=True):
                spans, keepers = _runs(found, min_words, min_support)
                if spans:
                    out.append((doc, tag, sum(s["end"] - s["start"] for s in spans), spans, keepers))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64())))],
                names=["doc_id", "tag", "removed_words", "spans", "kept_doc_ids"],
            )

    return grouped.mapInArrow(run, f"doc_id long, tag long, removed_words long, spans {SPANS}, kept_doc_ids array<long>")


def remove(docs: DataFrame, repeats: DataFrame, rate: float = 1 / 3) -> DataFrame:
    """docs with the spans of ``find_repeats`` cut out of text."""
    doc, cuts_name = unused(docs, "__doc"), unused(docs, "__cut")
    own = repeats.groupBy(F.col("doc_id").alias(doc)).agg(F.collect_list(F.struct("tag", "spans")).alias(cuts_name))
    joined = docs.join(own, F.col("doc_id") == F.col(doc), "left").drop(doc)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            cuts = part.column(cuts_name).to_pylist()
            if any(cuts):
                words, _, _, _, _, tag = _chunked(part, rate)
                texts = part.column("text").to_pylist()
                for i, own_ in enumerate(cuts):
                    for spans in [x["spans"] for x in own_ or [] if x["tag"] == tag[i]]:
                        base, start = words.bounds[i], words.texts.offsets[i]
                        raw, left, out = texts[i].encode(), 0, []
                        for s in spans:
                            out.append(raw[left : words.start[base + s["start"]] - start])
                            left = words.start[base + s["end"]] - start if base + s["end"] < words.bounds[i + 1] else len(raw)
                        texts[i] = (b"".join(out) + raw[left:]).decode()
                columns = [*part.columns[:at], pa.array(texts, part.schema.field(at).type), *part.columns[at + 1 : -1]]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])
            else:
                yield part.select(part.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
