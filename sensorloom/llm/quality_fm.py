"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise sum takes
linear time through 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2).

Features of a text: its distinct words hashed to WORDS slots (square roots of counts,
scaled to length 1), one slot per statistic for the bin its value falls into, and one for
the bin of the `n_chars` column. Labels, language, source and doc_id are never inputs.
Texts are read whole, once, and scored where they lie; the model is a fixed-size array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.words import SPACE, chunks, find_words, mix, run_hashes, shingle_hashes

WORDS, BINS = 1 << 16, 32
FACTORS = 8
#: Labelled rows the model is fitted on at most: those with the smallest hashed ids.
TRAIN_ROWS = 8_000
BATCH, LEAST_STEPS = 128, 300


def _kind(characters: bytes) -> np.ndarray:
    found = np.zeros(256, np.uint8)
    found[list(characters)] = 1
    return found


_UPPER, _LOWER = _kind(bytes(range(65, 91))), _kind(bytes(range(97, 123)))
_KINDS = {
    "digit": _kind(b"0123456789"),
    "shout": _kind(b"!?"),
    "stop": _kind(b".,;:"),
    "symbol": _kind(b"#*$%&|<>@^~=_+/\\`{}[]"),
    "line": _kind(b"\n"),
    "blank": SPACE.astype(np.uint8),
    "beyond_ascii": _kind(bytes(range(128, 256))),
}
STATISTICS = 18


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: items equal to another one before them, and the count of the commonest."""
    sizes = np.diff(begins)
    doc = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    keys, counts = np.unique((mix(hashes) & ~np.uint64(0xFFFFF)) | (doc & np.uint64(0xFFFFF)), return_counts=True)
    owner = (keys & np.uint64(0xFFFFF)).astype(np.int64)
    most = np.zeros(len(sizes), np.int64)
    np.maximum.at(most, owner, counts)
    return sizes - np.bincount(owner, minlength=len(sizes)), most


def _log_bin(values: np.ndarray) -> np.ndarray:
    return np.log2(values + 1.0) / 32  # 32 bins of a doubling each


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of all documents of a chunk, and where each document's begin.

    n_chars: the metadata column, NaN where null.
    """
    words = find_words(data, offsets)
    hashes, counts, docs = words.hashes(), words.counts, len(offsets) - 1
    n_bytes, per_word = np.diff(offsets), np.maximum(counts, 1)
    size = np.maximum(n_bytes, 1)
    upper, lower = _sums(_UPPER[data], offsets), _sums(_LOWER[data], offsets)
    kinds = {k: _sums(v[data], offsets) for k, v in _KINDS.items()}
    same, most = _repeated(hashes, words.first)
    trigrams, begins = shingle_hashes(hashes, words.first, 3)
    same3, _ = _repeated(trigrams, begins)
    adjacent = np.zeros(len(hashes), np.uint8)
    adjacent[1:] = hashes[1:] == hashes[:-1]
    adjacent[words.first[:-1][counts > 0]] = 0
    is_break = data == 10
    edges = np.unique(np.concatenate((np.flatnonzero(is_break) + 1, offsets)))
    starts, ends = edges[:-1], edges[1:]
    lines = run_hashes(data, starts, np.where(is_break[ends - 1], ends - 1, ends), fold=False) if len(starts) else np.empty(0, np.uint64)
    line_begins = np.searchsorted(starts, offsets)
    same_lines, _ = _repeated(lines, line_begins)
    shares = [
        _log_bin(n_bytes),
        _log_bin(counts),
        np.minimum((n_bytes - kinds["blank"]) / per_word, 15.9) / 16,
        upper / np.maximum(upper + lower, 1),
        np.sqrt(kinds["digit"] / size),
        np.sqrt(kinds["shout"] / size),
        np.sqrt(kinds["stop"] / size),
        np.sqrt(kinds["symbol"] / size),
        np.sqrt(kinds["line"] / per_word),
        np.sqrt(kinds["beyond_ascii"] / size),
        np.sqrt(same / per_word),
        np.sqrt(most / per_word),
        np.sqrt(_sums(adjacent, words.first) / per_word),
        np.sqrt(same3 / np.maximum(np.diff(begins), 1)),
        np.sqrt(same_lines / np.maximum(np.diff(line_begins), 1)),
        _log_bin(np.diff(line_begins)),
        kinds["blank"] / size,
        _log_bin(np.maximum(np.nan_to_num(n_chars, nan=0.0), 0.0)),
    ]
    bins = np.minimum((np.stack(shares, axis=1) * BINS).astype(np.int64), BINS - 1)
    bins[:, -1] = np.where(np.isnan(n_chars), 0, np.maximum(bins[:, -1], 1))
    structure = WORDS + np.arange(STATISTICS) * BINS + bins

    doc = np.repeat(np.arange(docs, dtype=np.int64), counts)
    keys, times = np.unique(doc * WORDS + (hashes >> np.uint64(48)).astype(np.int64), return_counts=True)
    owner = keys // WORDS
    values = np.sqrt(times / np.maximum(counts, 1)[owner])  # their squares sum to 1
    slots = np.concatenate((keys % WORDS, structure.ravel()))
    owner = np.concatenate((owner, np.repeat(np.arange(docs), STATISTICS)))
    values = np.concatenate((values, np.full(docs * STATISTICS, STATISTICS**-0.5)))
    order = np.argsort(owner, kind="stable")
    return slots[order], values[order], np.searchsorted(owner[order], np.arange(docs + 1))


@dataclass
class Machine:
    """bias, linear weights and factors (one row per slot)."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, slots: np.ndarray, values: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Every document has features, so no run is empty."""
        if len(begins) == 1:
            return np.empty(0)
        scaled = self.factors[slots] * values[:, None].astype(np.float32)
        sums = np.add.reduceat(scaled, begins[:-1], axis=0)
        squares = np.add.reduceat(scaled * scaled, begins[:-1], axis=0)
        linear = np.add.reduceat(self.linear[slots] * values, begins[:-1])
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def scores(self, slots: np.ndarray, values: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(slots, values, begins), -30, 30)))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, rate: float = 0.3, decay: float = 1e-6
) -> Machine:
    """Logistic loss by AdaGrad in batches; the order and the start are fixed. Without rows: all scores 0.5.

    Few rows are gone through more often, until LEAST_STEPS batches have been seen.
    """
    size, rng = WORDS + STATISTICS * BINS, np.random.default_rng(7)
    made = Machine(0.0, np.zeros(size), (rng.standard_normal((size, FACTORS)) * 0.05).astype(np.float32))
    if not len(rows):
        return Machine(0.0, made.linear, np.zeros_like(made.factors))
    mean = min(max(float(labels.mean()), 0.01), 0.99)
    made.bias = float(np.log(mean / (1 - mean)))
    seen, seen_factors = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2, np.float32)
    epochs = max(epochs, -(-LEAST_STEPS // -(-len(rows) // BATCH)))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            lengths = np.array([len(rows[i][0]) for i in batch])
            slots, values = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
            begins = np.concatenate(([0], np.cumsum(lengths)))
            scaled = made.factors[slots] * values[:, None].astype(np.float32)
            sums = np.add.reduceat(scaled, begins[:-1], axis=0)
            error = made.scores(slots, values, begins) - labels[batch]
            made.bias -= 0.02 * float(error.mean())
            each = np.repeat(error, lengths) * values
            used, back = np.unique(slots, return_inverse=True)
            step = np.bincount(back, each) / len(batch) + decay * made.linear[used]
            seen[used] += step * step
            made.linear[used] -= rate * step / np.sqrt(seen[used])
            pull = each[:, None] * (np.repeat(sums, lengths, axis=0) - scaled)
            step = np.stack([np.bincount(back, pull[:, f]) for f in range(FACTORS)], axis=1) / len(batch)
            step = (step + decay * made.factors[used]).astype(np.float32)
            seen_factors[used] += step * step
            made.factors[used] -= rate * step / np.sqrt(seen_factors[used])
    return made


def _meta(part: pa.RecordBatch, column: str) -> np.ndarray:
    values = part.column(part.schema.get_field_index(column))
    return values.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def held_out() -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text divides by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, **options) -> Machine:
    """Fit on labelled documents that aren't held out: at most `rows`, by the smallest hashed ids.

    Only features of those rows come to the driver. Rows without a label, id or text are
    not learnt from.
    """
    chosen = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            slots, values, begins = features(data, offsets, _meta(part, "n_chars"))
            cut = pa.array(begins, pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column(part.schema.get_field_index("doc_id")),
                    "quality": part.column(part.schema.get_field_index("quality")),
                    "slots": pa.ListArray.from_arrays(cut, pa.array(slots, pa.int32())),
                    "values": pa.ListArray.from_arrays(cut, pa.array(values, pa.float32())),
                }
            )

    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), "text", "n_chars")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "n_chars", F.col("quality").cast("int"))
    found = sample.mapInArrow(run, "doc_id long, quality int, slots array<int>, values array<float>").toArrow()
    if not found.num_rows:
        return fit([], np.empty(0), **options)
    found = found.sort_by([("doc_id", "ascending")]).combine_chunks()
    columns = {k: found[k].chunk(0) for k in ("slots", "values")}
    cuts = columns["slots"].offsets.to_numpy()
    slots, values = (columns[k].values.to_numpy() for k in ("slots", "values"))
    rows_ = [(slots[a:b], values[a:b].astype(float)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return fit(rows_, found["quality"].to_numpy().astype(float), **options)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """docs with a column `score` (0 to 1) added in front of any of that name.

    Null and empty texts have no words and are scored by their structure. Columns
    other than text and n_chars pass through untouched.
    """
    kept = [c for c in docs.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            found = machine.scores(*features(data, offsets, _meta(part, "n_chars")))
            columns = [part.column(part.schema.get_field_index(c)) for c in kept] + [pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score"])

    inner = docs.select(*(F.col(f"`{c}`") for c in kept))
    return inner.mapInArrow(run, T.StructType([*inner.schema.fields, T.StructField("score", T.DoubleType())]))


def good(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """docs that the classifier doesn't reject."""
    return score(docs, train(docs, labels)).where(F.col("score") >= least).select(docs.columns)


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    A null doc_id counts as not held out. Rows that share an id are scored one by one.
    """
    machine = train(docs, labels)
    slim = docs.select("doc_id", "text", "n_chars")
    scored = score(slim.select("doc_id", held_out().alias("held_out"), "text", "n_chars"), machine)
    return scored.select(
        F.col("doc_id").cast("long"), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
