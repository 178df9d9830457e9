"""Spelling variants: words one edit apart, found through Bloom filters of the vocabulary.

Every word generates its neighbours: what one deletion or one replacement by a later
letter makes of it (an insertion is another word's deletion, a replacement by an earlier
letter another word's). A neighbour is probed in the Bloom filter of its length, in one
block of 64 bits. Only those that pass are shuffled and joined with the vocabulary, which
removes what the filter let through wrongly.

The filters are built by Spark in slices and broadcast; together they take
``FILTER_BYTES`` at most: a larger vocabulary is dealt by hash into rounds, each with
filters of its share. A word has a bounded number of neighbours, so no key of the join is
hot, and occurrences are summed in each task before they are shuffled.

A null or empty text has no words; a null doc_id counts as an empty one. Repeated rows
count each; other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import written
from sensorloom.llm.words import chunks, mix, seeded

FILTER_BYTES = 64 << 20  # of all filters broadcast in a round
BITS = 24  # of a filter per word
SLICE = 1 << 16  # blocks of 64 bits built in one task
CELLS = 1 << 19  # neighbours handled at a time
SUMMED = 1 << 18  # different words a task sums up before it hands them on
LONG = 64  # words of this many letters and more share a filter

#: Letters of words, A-Z aside; all are one byte in Latin-1.
LETTERS = np.concatenate((np.arange(0x61, 0x7B), np.arange(0xC0, 0x100))).astype(np.uint8)

_VALUES = seeded(256, 1313)
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))


def dropped_letters(least: int, dropping: int):
    """Occurrences of the words of documents; where ``dropping`` divides a word's hash, a letter of it is left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A run too short for a word matches nowhere, a longer one as a whole.
        runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall
        total: Counter = Counter()
        for batch, data, offsets in chunks(batches):
            for row, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = data[offsets[row] : offsets[row + 1]].tobytes().lower().decode("utf-8", "replace")
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs(text)).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % dropping == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    total[word] += n
                if len(total) > SUMMED:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    return count


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
    )


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length: their numbers, and a row of letters for each."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        letters = np.frombuffer("".join(words[i] for i in at).encode("latin-1"), np.uint8)
        yield at, letters.reshape(len(at), length)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _STEP, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _finish(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length))


def hashes(letters: np.ndarray) -> np.ndarray:
    """A hash per row of letters."""
    return _finish((_VALUES[letters] * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64), letters.shape[1])


def shard_of(length: int) -> int:
    return min(length, LONG)


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        found, shard = np.empty(len(words), np.uint64), np.empty(len(words), np.int32)
        for at, letters in _by_length(words):
            found[at], shard[at] = hashes(letters), shard_of(letters.shape[1])
        columns = [batch.column("word"), batch.column("n"), pa.array(found.view(np.int64)), pa.array(shard)]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n", "hash", "shard"])


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


_SHIFTS = [np.uint64(6 * k) for k in range(5)]
_ONE, _LOW = np.uint64(1), np.uint64(63)


def filter_slice(blocks: dict[int, int]):
    """Bits of a shard's slice of blocks that its words set."""

    def build(group: pa.Table) -> pa.Table:
        shard, number = group.column("shard")[0].as_py(), group.column("slice")[0].as_py()
        h = group.column("hash").to_numpy().view(np.uint64)
        first = number * SLICE
        bits = np.zeros(min(SLICE, blocks[shard] - first), np.uint64)
        mask = np.zeros(len(h), np.uint64)
        for shift in _SHIFTS:
            mask |= _ONE << ((h >> shift) & _LOW)
        np.bitwise_or.at(bits, _block(h, blocks[shard]) - first, mask)
        return pa.table({"shard": pa.array([shard], pa.int32()), "slice": pa.array([number], pa.int64()),
                         "bits": pa.array([bits.tobytes()], pa.binary())})

    return build


def passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that a filter doesn't rule out."""
    own = bits[_block(h, len(bits))]
    left = np.flatnonzero((own >> (h & _LOW)) & _ONE)
    for shift in _SHIFTS[1:]:
        left = left[((own[left] >> ((h[left] >> shift) & _LOW)) & _ONE).astype(bool)]
    return left


def deletions(letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, hash) of what is left of each word without the letter at a place; each result once."""
    length = letters.shape[1]
    powers = _powers(length)
    rows, width = max(1, CELLS // length), length
    for a in range(0, len(letters), rows):
        part = letters[a : a + rows]
        sums = np.zeros((len(part), width + 1), np.uint64)
        np.cumsum(_VALUES[part] * powers, axis=1, out=sums[:, 1:])
        cut = sums[:, :-1] + (sums[:, -1:] - sums[:, 1:]) * _BACK
        # Of equal letters in a row the last one goes.
        once = np.ones(part.shape, bool)
        once[:, :-1] = part[:, :-1] != part[:, 1:]
        row, place = np.nonzero(once)
        yield row + a, place, _finish(cut[row, place], length - 1)


def replacements(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, letter, hash) of each word with the letter at a place replaced by a later one."""
    length = letters.shape[1]
    powers, values = _powers(length), _VALUES[alphabet]
    total = (_VALUES[letters] * powers).sum(axis=1, dtype=np.uint64)
    wide = max(1, min(length, CELLS // len(alphabet)))
    rows = max(1, CELLS // (wide * len(alphabet)))
    for a in range(0, len(letters), rows):
        for p in range(0, length, wide):
            part = letters[a : a + rows, p : p + wide]
            row, place, letter = np.nonzero(alphabet[None, None, :] > part[:, :, None])
            change = (values[letter] - _VALUES[part[row, place]]) * powers[p + place]
            yield row + a, place + p, alphabet[letter], _finish(total[row + a] + change, length)


def probed(shared, rounds: int, number: int, least: int):
    """Neighbours of words that the filters of a round let pass."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, filters = shared.value

        def hits(h: np.ndarray, shard: int) -> np.ndarray:
            if shard not in filters:
                return np.empty(0, np.int64)
            if rounds == 1:
                return passes(h, filters[shard])
            own = np.flatnonzero(h % np.uint64(rounds) == number)
            return own[passes(h[own], filters[shard])]

        for batch in batches:
            words, ns = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            near, source = [], []
            for at, letters in _by_length(words):
                length = letters.shape[1]
                for row, place, h in deletions(letters) if length > least else ():
                    for i in hits(h, shard_of(length - 1)):
                        word, k = words[at[row[i]]], place[i]
                        near.append(word[:k] + word[k + 1 :])
                        source.append(at[row[i]])
                for row, place, letter, h in replacements(letters, alphabet):
                    for i in hits(h, shard_of(length)):
                        word, k = words[at[row[i]]], place[i]
                        near.append(word[:k] + chr(letter[i]) + word[k + 1 :])
                        source.append(at[row[i]])
            at = np.array(source, np.int64)
            columns = [pa.array(near, pa.string()), batch.column("word").take(pa.array(at)), pa.array(ns[at])]
            yield pa.RecordBatch.from_arrays(columns, ["near", "word", "n"])

    return probe


def filters_of(vocabulary: DataFrame, rounds: int, number: int) -> dict[int, np.ndarray]:
    """The Bloom filter of each length's words of a round, built in slices by Spark."""
    own = vocabulary.where(F.expr(f"{_unsigned_mod('hash', rounds)} = {number}")) if rounds > 1 else vocabulary
    sizes = own.groupBy("shard").agg(F.count("*").alias("words")).collect()
    blocks = {r.shard: -(-r.words * BITS // 64) for r in sizes}
    if not blocks:
        return {}
    count = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])[F.col("shard")].cast("long")
    block = F.shiftrightunsigned(F.shiftrightunsigned("hash", 32) * count, 32)
    sliced = own.select("shard", "hash", F.floor(block / F.lit(SLICE)).alias("slice"))
    rows = sliced.groupBy("shard", "slice").applyInArrow(filter_slice(blocks), "shard int, slice long, bits binary").toArrow()
    found = {shard: np.zeros(n, np.uint64) for shard, n in blocks.items()}
    for row in rows.to_pylist():
        bits, first = np.frombuffer(row["bits"], np.uint64), row["slice"] * SLICE
        found[row["shard"]][first : first + len(bits)] = bits
    return found


def _unsigned_mod(column: str, n: int) -> str:
    """A long's value as an unsigned one, modulo n."""
    return f"pmod(pmod(shiftrightunsigned({column}, 1), {n}) * 2 + ({column} & 1), {n})"


def vocabulary(docs: DataFrame, least: int = 5, often: int = 3, dropping: int = 97) -> DataFrame:
    """(word, n) of the words of docs (doc_id, text) with ``least`` letters and ``often`` occurrences or more."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = slim.mapInArrow(dropped_letters(least, dropping), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def near_words(words: DataFrame, least: int = 5) -> DataFrame:
    """(word, near, n, near_n) of words (word, n, hash, shard) one edit apart, both ways round; exact."""
    spark = words.sparkSession
    n = words.count()
    rounds = max(1, -(-n * BITS // 8 // FILTER_BYTES))
    used = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    used = np.array(sorted(ord(r.letter) for r in used.where("letter <> ''").collect()), np.uint8)
    found = None
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((used, filters_of(words, rounds, number)))
        near = words.select("word", "n").mapInArrow(probed(shared, rounds, number, least), "near string, word string, n long")
        found = near if found is None else found.unionByName(near)
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = found.join(other, "near")
    there = F.struct("word", "near", "n", "near_n")
    back = F.struct(
        F.col("near").alias("word"), F.col("word").alias("near"), F.col("near_n").alias("n"), F.col("n").alias("near_n")
    )
    return pairs.select(F.explode(F.array(there, back)).alias("pair")).select("pair.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last form reached. A round doubles the steps taken."""
    step = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = step.join(onward, "root", "left")
        step = written(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")


def variants(docs: DataFrame, least: int = 5, often: int = 3, dropping: int = 97, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of docs (doc_id, text).

    A word's form is its near word of most occurrences, the first in code-point order of
    several, if these are ``times`` the word's or more; its root is the last form reached.
    """
    counted = vocabulary(docs, least, often, dropping)
    words = written(counted.mapInArrow(hashed, "word string, n long, hash long, shard int"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words, least).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    known = words.select("word", "n").join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    known = written(known, "spelling-forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
