"""Words of Arrow string batches as numpy arrays: places, hashes and windows, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A pseudo-random number for each byte, by rule.
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_byte = np.arange(256)
#: Letters, digits and everything beyond ASCII.
ALNUM = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
#: Everything but ASCII white space.
DARK = ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13)))

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 19)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


class Texts:
    """The bytes of some rows' texts; a null text is empty."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        column = column.fill_null("") if column.null_count else column
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = raw[offsets[0] : offsets[-1]]

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words:
    """Words of ``texts`` under a table of word bytes: start and end bytes, and by row ``bounds``."""

    def __init__(self, texts: Texts, table: np.ndarray):
        self.texts = texts
        inside = table[texts.data]
        n = len(inside)
        head = np.zeros(n + 1, dtype=bool)
        head[texts.offsets] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
            before &= ~head[:-1]
            after = np.empty(n, dtype=bool)
            after[-1] = False
            after[:-1] = inside[1:]
            after &= ~head[1:]
            self.start = np.flatnonzero(inside & ~before)
            self.end = np.flatnonzero(inside & ~after) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        self.bounds = np.searchsorted(self.start, texts.offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word's bytes, A-Z as a-z."""
        data = LOWER[self.texts.data] if lower else self.texts.data
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE[data] * up[:-1], out=total[1:])
        return mix64((total[self.end] - total[self.start]) * down[self.start])


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's windows of k words, and bounds by row; a shorter row with words is one window."""
    counts = np.diff(bounds)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(made)])
    first = np.repeat(bounds[:-1] - out[:-1], made) + np.arange(out[-1])
    length = np.minimum(np.repeat(counts, made), k)
    total = length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(k):
        has = j < length
        factor = np.uint64((0xA0761D6478BD642F + 2 * j * 0xE7037ED1A0B428DB) & 0xFFFFFFFFFFFFFFFF | 1)
        value = words[np.minimum(first + j, len(words) - 1)] if len(words) else np.zeros(0, np.uint64)
        total += np.where(has, value * factor, np.uint64(0))
    return mix64(total), out


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 600_000) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``most`` bytes of text each; a longer text is a part of its own."""
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
        size = np.concatenate([[0], np.cumsum(length)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
