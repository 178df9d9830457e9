"""Words of whole texts as 64-bit hashes, computed on Arrow batches with numpy.

A word is a run of bytes other than space and 0x09-0x0D, A-Z lower-cased. Hashes are
polynomials modulo 2**64 over random values per byte, taken from prefix sums and then
mixed with the word's length; they are the same on every executor and in every run.
Work is cut into pieces at white space, so memory follows the piece and the number of
words and not a text's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes hashed at a time
CHUNK = 1 << 20  # bytes of whole documents handed on at a time

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads every bit of a uint64 array."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random uint64 values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _letters(fold: bool) -> np.ndarray:
    values = seeded(256, 77)
    if fold:
        values[65:91] = values[97:123]
    return values


_FOLDED, _EXACT = _letters(True), _letters(False)


class _Powers:
    """Powers of the base and of its inverse, made in each process as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            steps = np.full(max(n, PIECE + 1), _BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = _BASE_INVERSE
            self.down = np.cumprod(steps)


_POWERS = _Powers()


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A hash of each run data[start:end] of bytes; runs lie in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    letters, at = _FOLDED if fold else _EXACT, 0
    while at < len(starts):
        origin = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, origin + PIECE, side="right")))
        size = int(ends[to - 1]) - origin
        _POWERS.upto(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(letters[data[origin : origin + size]] * _POWERS.up[:size], out=sums[1:])
        a, b = starts[at:to] - origin, ends[at:to] - origin
        out[at:to] = mix((sums[b] - sums[a]) * _POWERS.down[a] + (b - a).astype(np.uint64))
        at = to
    return out


@dataclass
class Words:
    """Words of a chunk of documents, in order."""

    data: np.ndarray  # the chunk's bytes
    offsets: np.ndarray  # of documents in data, one more than documents
    starts: np.ndarray  # of words in data
    ends: np.ndarray
    first: np.ndarray  # index of each document's first word, one more than documents

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, fold: bool = True) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends, fold)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    blank = SPACE[data]
    inside = ~blank
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.ones(len(data), bool)
    after[:-1] = blank[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches holding about CHUNK bytes of text: the slice, its bytes, its documents' offsets.

    A null text has no bytes.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
        _, at, values = texts.buffers()
        offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
        row = 0
        while row < len(texts):
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
            to = min(to, len(texts))
            yield batch.slice(row, to - row), data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
            row = to


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles in order, and where each document's begin (one more than documents).

    A document of fewer words has its whole sequence as its one shingle; one without
    words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begins = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(int(begins[-1]), np.uint64)
    full = np.flatnonzero(counts >= n)
    if len(full):
        rolled = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(_BASE) + words[k : len(words) - n + 1 + k]
        rolled = mix(rolled)
        if len(counts) == 1:
            return rolled, begins
        sizes = made[full]
        target = np.repeat(begins[full] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum()))
        source = np.repeat(first[full] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum()))
        out[target] = rolled[source]
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            value = np.full(len(short), size, np.uint64)
            for k in range(size):
                value = value * np.uint64(_BASE) + words[first[short] + k]
            out[begins[short]] = mix(value ^ np.uint64(size))
    return out, begins
