"""Ranked lexical search: documents grouped by which of an item's terms they hold.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII, A-Z
lower-cased. Documents are reduced once to the items' terms they hold. A task then keeps a
bitmap of documents per term; the bitmaps of an item's terms, read across, give each
document's presence mask. A mask's score is at most the sum of its terms' largest
contributions, so masks are taken by falling bound and the rest is skipped as soon as the
next bound lies below the lowest of the best documents found. What is skipped can't be
among them: results are exact.

Only the best rows per task and item are shuffled, so a hot source, a frequent term or a
document's copies make no task larger. Items are handled in blocks of at most
``BLOCK_BYTES`` of text, whose terms are what is broadcast.

Rows of the items are items, also with equal ids or texts. A null or empty text has no
terms; an item without terms and an empty table give no rows. A null doc_id ranks behind
others of its score. Terms are compared by 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorloom.llm.common import written
from sensorloom.llm.words import Words, chunks, find_words

BLOCK_BYTES = 4 << 20  # of items' texts; a block's terms are a bounded broadcast
CELLS = 1 << 22  # of a document by term matrix, handled at a time

_TERM = np.zeros(256, bool)
_TERM[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = True
_TERM[0x80:] = True

FOUND = "doc_id long, n long, terms array<int>, tfs array<int>"


def term_runs(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Terms of a chunk of documents, as words between blanks."""
    return find_words(np.where(_TERM[data], data, np.uint8(0x20)), offsets)


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in chunks(batches):
        found = term_runs(data, offsets)
        hashes = found.hashes().view(np.int64)
        lists = [np.unique(hashes[a:b]) for a, b in zip(found.first[:-1], found.first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(lists, pa.list_(pa.int64()))], ["item", "terms"])


def found_terms(vocabulary: np.ndarray):
    """Documents with a term: number of terms, and the vocabulary's among them with their counts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            found = term_runs(data, offsets)
            hashes, n = found.hashes(), found.counts
            at = np.searchsorted(vocabulary, hashes)
            at[at == len(vocabulary)] = 0
            hit = vocabulary[at] == hashes
            pairs, tfs = np.unique(found.doc[hit] * len(vocabulary) + at[hit], return_counts=True)
            doc, term = np.divmod(pairs, len(vocabulary))
            some = np.flatnonzero(n)
            begins = np.searchsorted(doc, np.append(some, len(n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(some)), pa.array(n[some], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(begins), pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(begins), pa.array(tfs.astype(np.int32))),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return find


def _masks(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a boolean matrix: a column that has each, and each column's number."""
    packed = np.packbits(bits, axis=0)
    packed = np.vstack([packed, np.zeros((-len(packed) % 8, bits.shape[1]), np.uint8)])
    words = np.ascontiguousarray(packed.T).view(np.uint64)
    first, number = np.unique(words[:, 0], return_index=True, return_inverse=True)[1:]
    for k in range(1, words.shape[1]):
        own = np.unique(words[:, k], return_inverse=True)[1]
        first, number = np.unique(number * (int(own.max()) + 1) + own, return_index=True, return_inverse=True)[1:]
    return first, number


class _Postings:
    """Documents of a batch by term: their contributions, and a bitmap per term."""

    def __init__(self, docs: int, doc: np.ndarray, term: np.ndarray, gain: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.docs, self.doc, self.gain = docs, doc[order], gain[order]
        self.terms, self.begin = np.unique(term[order], return_index=True)
        self.end = np.append(self.begin[1:], len(doc))
        self.most = np.maximum.reduceat(self.gain, self.begin) if len(doc) else self.gain
        width = (docs + 7) // 8
        place = np.repeat(np.arange(len(self.terms)), self.end - self.begin) * width + (self.doc >> 3)
        cells, start = np.unique(place, return_index=True)
        self.bitmaps = np.zeros((len(self.terms), width), np.uint8)
        if len(doc):
            bit = (np.uint8(128) >> (self.doc & 7).astype(np.uint8)).astype(np.uint8)
            self.bitmaps.ravel()[cells] = np.bitwise_or.reduceat(bit, start)

    def rows(self, terms: np.ndarray) -> np.ndarray:
        """Where the batch has some of the terms."""
        at = np.searchsorted(self.terms, terms)
        inside = at < len(self.terms)
        return at[inside][self.terms[at[inside]] == terms[inside]]

    def scores(self, rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of some documents (in order) over the rows' terms."""
        total = np.zeros(len(docs), np.int64)
        for row in rows:
            own = self.doc[self.begin[row] : self.end[row]]
            at = np.searchsorted(own, docs)
            at[at == len(own)] = 0
            total += np.where(own[at] == docs, self.gain[self.begin[row] : self.end[row]][at], 0)
        return total


class _Best:
    """The best documents of an item so far."""

    def __init__(self, top: int):
        self.top, self.scores = top, np.empty(0, np.int64)
        self.ids, self.nulls = np.empty(0, np.int64), np.empty(0, bool)

    @property
    def floor(self) -> int:
        """A score below this can't enter."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        enter = scores >= max(1, self.floor)
        scores = np.concatenate((self.scores, scores[enter]))
        ids, nulls = np.concatenate((self.ids, ids[enter])), np.concatenate((self.nulls, nulls[enter]))
        order = np.lexsort((ids, nulls, -scores))[: self.top]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def search_block(postings: _Postings, terms: np.ndarray, best: _Best, ids: np.ndarray, nulls: np.ndarray) -> int:
    """Add a batch's documents to an item's best ones; returns how many were scored."""
    rows, scored = postings.rows(terms), 0
    if not len(rows):
        return 0
    step = max(64, CELLS // len(rows) // 8 * 8)
    for at in range(0, postings.docs, step):
        here = min(step, postings.docs - at)
        bits = np.unpackbits(postings.bitmaps[rows, at // 8 : (at + here + 7) // 8], axis=1)[:, :here]
        first, number = _masks(bits)
        # Sums of integers below 2**53 are exact in doubles.
        bounds = postings.most[rows].astype(np.float64) @ bits[:, first].astype(np.float64)
        # Documents in order of their mask's bound; a mask's documents lie together.
        falling = np.argsort(-bounds, kind="stable")
        rank = np.empty(len(falling), np.int64)
        rank[falling] = np.arange(len(falling))
        order = np.argsort(rank[number], kind="stable")
        bounds, done, size = -bounds[number[order]], 0, 64
        while done < here:
            # Masks whose bound is the floor itself may hold a tie with a smaller id.
            to = min(done + size, int(np.searchsorted(bounds, -best.floor, side="right")))
            if to <= done:
                break
            docs = np.sort(order[done:to]) + at
            best.add(postings.scores(rows, docs), ids[docs], nulls[docs])
            scored, done, size = scored + to - done, to, size * 2
    return scored


def best_of_task(items: list[tuple[int, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """The best documents of each item among a task's, as rows."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(top) for _ in items]
        for batch in batches:
            n = batch.column("n").to_numpy()
            lists, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy().astype(np.int64)
            term = lists.flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            gain = weights[term] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]))
            some = gain > 0
            postings = _Postings(batch.num_rows, doc[some], term[some], gain[some])
            ids = batch.column("doc_id")
            nulls, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for (_, terms), found in zip(items, best):
                search_block(postings, terms, found, ids, nulls)
        for (item, _), found in zip(items, best):
            if len(found.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.scores), item)), pa.array(found.ids, pa.int64(), mask=found.nulls),
                        pa.array(found.scores),
                    ],
                    ["item", "doc_id", "score"],
                )

    return search


def ranked(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    items = written(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "search-items")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    best = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = part.select("item", "text").mapInArrow(item_terms, "item long, terms array<long>").toArrow()
        terms = rows.column("terms").combine_chunks()
        vocabulary = np.unique(terms.flatten().to_numpy()).view(np.uint64) if len(rows) else np.empty(0, np.uint64)
        if not len(vocabulary):
            continue
        vocabulary = np.sort(vocabulary)
        found = written(docs.mapInArrow(found_terms(vocabulary), FOUND), "search-found")
        n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
        held = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in zip(held.column("term").to_pylist(), held.column("df").to_pylist()):
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        asked = [
            (item, np.sort(np.searchsorted(vocabulary, np.array(own, np.int64).view(np.uint64))))
            for item, own in zip(rows.column("item").to_pylist(), terms.to_pylist())
        ]
        task = best_of_task(asked, weights, n_docs, max(1, n_terms), top)
        own = found.mapInArrow(task, "item long, doc_id long, score long")
        best = own if best is None else best.unionByName(own)
    if best is None:
        best = spark.createDataFrame([], "item long, doc_id long, score long")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
