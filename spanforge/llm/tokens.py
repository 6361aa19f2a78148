"""Token counts by rank-synchronous merging of byte-pair pre-tokens.

A text is cut at special strings, then into pre-tokens by the tokenizer's pattern. Pre-tokens not
seen before are laid out as one ragged array of symbols; in each round every pre-token applies its
own lowest-rank pair, at all its places at once, until no pair is left; the symbols that survive
are counted. Counts of pre-tokens are remembered up to ``remember`` entries a worker.

Edge cases: a null or empty text has 0 bytes and 0 tokens; rows that share a doc_id stay apart;
long pre-tokens take more rounds, not more memory; an empty table gives an empty result; further
columns are left alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.words import pieces

#: How a byte-level tokenizer cuts texts (fixed).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Merges of a byte-level BPE file; ``count`` gives the tokens of each pre-token."""

    def __init__(self, path: str, remember: int = 400_000):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte[byte] = vocab[letter]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.sorted = np.argsort(key)
        self.key = key[self.sorted]
        self.into = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.find = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}
        self.remember = remember

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.sorted[at], len(self.key))

    def count(self, tokens: list[str]) -> np.ndarray:
        raw = [t.encode() for t in tokens]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        symbol = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), size)
        result = size.copy()
        none = len(self.key)
        while len(symbol) > 1:
            rank = np.full(len(symbol), none, np.int64)
            same = owner[1:] == owner[:-1]
            rank[:-1][same] = self.rank(symbol[:-1][same], symbol[1:][same])
            first = np.concatenate([[0], np.flatnonzero(~same) + 1])
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.concatenate([first, [len(symbol)]]))
            going = lowest < none
            least = np.repeat(lowest, length)
            hit = (rank == least) & (least < none)
            # of hits in a row (a pair of equal symbols) each second one merges
            run = hit & ~np.concatenate([[False], hit[:-1]])
            place = np.arange(len(symbol))
            since = place - np.maximum.accumulate(np.where(run, place, -1))
            hit &= since % 2 == 0
            symbol = symbol.copy()
            symbol[hit] = self.into[rank[hit]]
            gone = np.concatenate([[False], hit[:-1]])
            np.subtract.at(result, owner[gone], 1)
            stay = ~gone & np.repeat(going, length)
            symbol, owner = symbol[stay], owner[stay]
        return result

    def texts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        cut: list[list[str]] = []
        more = []
        for text in texts:
            if not text:
                cut.append([])
                more.append(0)
                continue
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            more.append(len(parts) - 1)
            cut.append(self.find(parts[0]) if len(parts) == 1 else [t for p in parts for t in self.find(p)])
        if len(self.known) > self.remember:
            self.known.clear()
        new = list({t for own in cut for t in own} - self.known.keys())
        if new:
            self.known.update(zip(new, self.count(new).tolist(), strict=True))
        get = self.known.__getitem__
        return [sum(map(get, own)) + k for own, k in zip(cut, more, strict=True)]


_merger: dict[str, Merger] = {}


def count_tokens(docs: DataFrame, vocabulary: str | None = None, name: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """docs(doc_id, text) as doc_id, n_bytes, n_tokens, over_limit.

    vocabulary: path of a byte-level BPE file that every executor can read; if none, each executor
    asks its installed ``public_tokenizers`` for ``name``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(name)
        if path not in _merger:
            _merger.clear()
            _merger[path] = Merger(path)
        for part in pieces(batches):
            n = _merger[path].texts(part.column("text").to_pylist())
            size = pa.compute.fill_null(pa.compute.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    import pyarrow.compute  # noqa: F401

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
