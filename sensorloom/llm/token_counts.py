"""Token counts by byte-pair merging with a heap and a linked list; no ids are emitted.

A piece of text starts as one symbol per byte. The adjacent pair of lowest rank, leftmost
first, is popped from a heap and merged in the list, until no pair has a rank: the count
is the initial symbols minus the merges. A worker keeps the counts of pieces it has seen
in a table of bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces whose counts a worker remembers; the table is emptied when full.
REMEMBERED = 1 << 20


class Counter(dict):
    """Tokens per piece of text, computed on first use.

    ranks: rank per adjacent pair, as left * stride + right; made: the symbol a merge
    of that rank makes; symbols: the symbol of each byte.
    """

    def __init__(self, left, right, made, symbols, specials, pattern):
        super().__init__()
        self.parts = (left, right, made, symbols, specials, pattern)
        self.stride = 1 + max([0, *left, *right, *made, *symbols])
        self.ranks = {a * self.stride + b: rank for rank, (a, b) in reversed([*enumerate(zip(left, right, strict=True))])}
        self.made, self.symbols = made, symbols
        self.pieces = regex.compile(pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def __reduce__(self):
        return Counter, self.parts

    def __missing__(self, piece: str) -> int:
        self[piece] = count = self.merged(piece.encode())
        return count

    def merged(self, data: bytes) -> int:
        stride, get, made = self.stride, self.ranks.get, self.made
        symbol = [*map(self.symbols.__getitem__, data)]
        n = len(symbol)
        # An entry holds a rank and a place; every rank is below `none`.
        none = len(made)
        ranks = [get(a * stride + b, none) for a, b in zip(symbol, symbol[1:], strict=False)]
        ranks.append(none)
        heap = [rank << 40 | i for i, rank in enumerate(ranks) if rank != none]
        if not heap:
            return n
        heapify(heap)
        after, before, count = [*range(1, n + 1)], [*range(-1, n - 1)], n
        while heap:
            top = heappop(heap)
            rank, i = top >> 40, top & 0xFFFFFFFFFF
            if ranks[i] != rank:  # another merge has changed or taken this pair since
                continue
            j = after[i]
            symbol[i] = new = made[rank]
            ranks[j] = none
            after[i] = k = after[j]
            count -= 1
            if k < n:
                before[k] = i
                ranks[i] = found = get(new * stride + symbol[k], none)
                if found != none:
                    heappush(heap, found << 40 | i)
            else:
                ranks[i] = none
            h = before[i]
            if h >= 0:
                ranks[h] = found = get(symbol[h] * stride + new, none)
                if found != none:
                    heappush(heap, found << 40 | h)
        return count

    def count(self, text: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        if self.special is None:
            return sum(map(self.__getitem__, self.pieces(text)))
        parts = self.special.split(text)  # each special string is one token
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable bytes stand for themselves; the others take the letters from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (b for b in range(256) if b not in plain)
    spare = {b: chr(256 + i) for i, b in enumerate(other)}
    return [spare.get(b, chr(b)) for b in range(256)]


def load(path: str, pattern: str) -> Counter:
    """The counter for a byte-level BPE vocabulary file; pattern cuts texts into pieces."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary = content["model"]["vocab"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
    return Counter(
        [vocabulary[a] for a, _ in pairs],
        [vocabulary[b] for _, b in pairs],
        [vocabulary[a + b] for a, b in pairs],
        [vocabulary[letter] for letter in _byte_letters()],
        [t["content"] for t in content.get("added_tokens", [])],
        pattern,
    )


def token_counts(docs: DataFrame, counter: Counter, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs (doc_id, text).

    Whole texts are counted, without added begin or end tokens; special strings inside
    them are single tokens. A null or empty text has no bytes and no tokens. Rows with
    equal or null ids are counted one by one; other columns are ignored.
    """
    # As large as the vocabulary; plain lists, which executors load without this package.
    shared = docs.sparkSession.sparkContext.broadcast(counter.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(*shared.value).count
        for batch in batches:
            found = [count(text) if text else 0 for text in map(pa.StringScalar.as_py, batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long"), text.alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    counted = slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
