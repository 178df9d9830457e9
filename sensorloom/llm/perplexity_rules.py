"""Quality rules: n-gram perplexity under modified Kneser-Ney models, one per language.

Spark counts the grams of four characters of all texts and derives the continuation counts
of shorter ones, the discounts and the interpolated probabilities by aggregations and joins.
A character is a whole code point, none is folded into another. The probabilities are sorted
arrays of the grams' hashes, looked up by binary search; where there are more grams than may
be held at once, each range of hashes is a pass over the texts whose sums are added up. All
texts are trained on, so every gram that is scored is found. A document is rejected outside a
band of log perplexity around the middle half of its language's documents, or by the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import few_or_shuffled, written
from sensorloom.llm.quality_fm import _sums
from sensorloom.llm.words import SPACE, chunks, find_words, mix, run_hashes, shingle_hashes

ORDER, WIDTH = 4, 6
#: Code points take 21 bits, moved up by one; a gram is its first two symbols and its last two.
BITS = 21
START, END = 0, 0x110001
#: Grams of the models that are held in memory at once; hashes beyond go in further passes.
MODEL_ROWS = 1 << 23
#: Distinct grams that a task sums up before it hands them on.
TASK_ROWS = 1 << 21


def _classes() -> np.ndarray:
    found = np.full(256, 57, np.uint8)  # control characters
    found[33:127] = 58  # other signs
    found[97:123] = np.arange(1, 27)
    found[65:91] = np.arange(27, 53)
    found[48:58] = 53
    found[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 54
    found[0x0A] = 55
    found[[0x2C, 0x2E]] = 56
    found[128:] = 59 + (np.arange(128) & 3)
    return found


CLASSES = _classes()
SIGNS = np.zeros(256, np.uint8)
SIGNS[list(b"#*$%&|<>")] = 1
LEADING = ((np.arange(256) & 0xC0) != 0x80) & ~SPACE


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last halves of a chunk's grams in order, one per code point and one for each text's end; where each text's begin."""
    texts = [data[a:b].tobytes().decode("utf-8", "surrogateescape") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sizes = np.array([len(t) for t in texts], np.int64)
    # START before each text as often as a gram looks back, END behind it.
    line = np.full(int(sizes.sum()) + ORDER * len(sizes), START, np.int64)
    ends = np.cumsum(sizes + ORDER) - 1
    line[ends] = END
    inside = np.zeros(len(line) + 1, np.int8)
    np.add.at(inside, ends - sizes, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    line[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    inside[ends] = True
    at = np.flatnonzero(inside)
    pairs = line.copy()
    pairs[1:] |= line[:-1] << BITS
    return pairs[at - 2], pairs[at], np.concatenate(([0], np.cumsum(sizes + 1)))


def gram_hashes(language: str | None, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    seed = xxhash.xxh64_intdigest((language or "").encode(), int(language is None))
    return mix(mix(first.astype(np.uint64) ^ np.uint64(seed)) * _SPREAD + last.astype(np.uint64)).view(np.int64)


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _languages(part: pa.RecordBatch) -> tuple[list, np.ndarray]:
    """The distinct values of column lang, null included, and each row's place among them."""
    coded = part.column(part.schema.get_field_index("lang")).dictionary_encode(null_encoding="encode")
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, hash, first, last, n over all whole texts; each task sums up what it has read before the shuffle."""

    def added(parts: list) -> tuple:
        """Hashes, halves and counts of several lists as one."""
        hashes, first, last, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        at = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        return hashes[at], first[order[at]], last[order[at]], np.add.reduceat(n[order], at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for name, parts in known.items():
                hashes, first, last, n = added(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(n), pa.string()), *(pa.array(x, pa.int64()) for x in (hashes, first, last, n))],
                    ["lang", "hash", "first", "last", "n"],
                )
            known.clear()

        for part, data, offsets in chunks(batches):
            names, index = _languages(part)
            first, last, begins = grams(data, offsets)
            which = np.repeat(index, np.diff(begins))
            for k, name in enumerate(names):
                own = np.flatnonzero(which == k)
                a, b = first[own], last[own]
                parts = known.setdefault(name, [])
                parts.append(added([(gram_hashes(name, a, b), a, b, np.ones(len(own), np.int64))]))
                if len(parts) > 1 and sum(len(p[0]) for p in parts[1:]) > max(len(parts[0][0]), TASK_ROWS // 4):
                    known[name] = [added(parts)]
            if sum(len(p[0]) for parts in known.values() for p in parts) > 2 * TASK_ROWS:
                yield from rows()
        yield from rows()

    found = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    found = found.mapInArrow(run, "lang string, hash long, first long, last long, n long")
    return found.groupBy("lang", "hash", "first", "last").agg(F.sum("n").alias("n"))


def probabilities(counts: DataFrame) -> DataFrame:
    """hash, p (natural logarithm) of each language's grams by interpolated modified Kneser-Ney smoothing."""
    low, lang = (1 << BITS) - 1, F.concat(F.lit("="), "lang")  # a null language is one of its own
    levels = [counts.select(F.coalesce(lang, F.lit("")).alias("lang"), "first", "last", "n", "hash")]
    # A shorter gram counts the different symbols seen before it.
    for order in range(ORDER - 1, 0, -1):
        first = F.col("first").bitwiseAND(low) if order == 3 else F.lit(0).cast("long")
        last = F.col("last").bitwiseAND(low) if order == 1 else F.col("last")
        shorter = levels[0].select("lang", first.alias("first"), last.alias("last")).groupBy("lang", "first", "last")
        levels.insert(0, written(shorter.agg(F.count("*").alias("n")), "rules-shorter"))
    below = few_or_shuffled(written(levels[0].groupBy("lang").agg((1 / F.count("*")).alias("lower")), "rules-symbols"))
    for order, level in enumerate(levels, start=1):
        seen = [F.greatest(F.count_if(F.col("n") == k), F.lit(1)).alias(f"n{k}") for k in range(1, 5)]
        y = F.expr("n1 / (n1 + 2 * n2)")
        off = [F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"), F.lit(0.1)), F.lit(k - 0.1)) for k in (1, 2, 3)]
        off = written(level.groupBy("lang").agg(*seen).select("lang", F.array(*off).alias("off")), "rules-off")
        less = F.get("off", F.least(F.col("n"), F.lit(3)).cast("int") - 1)
        level = level.join(few_or_shuffled(off), "lang").withColumn("off", less)
        # What comes before the last symbol.
        level = level.withColumns({"context": F.shiftright("last", BITS), "ahead": F.col("first")})
        contexts = level.groupBy("lang", "ahead", "context").agg(F.sum("n").alias("total"), F.sum("off").alias("kept"))
        level = level.join(contexts, ["lang", "ahead", "context"])
        keys = ["lang"]
        if order > 1:
            keys += ["lower_first", "lower_last"]
            first = F.col("first").bitwiseAND(low) if order == ORDER else F.lit(0).cast("long")
            last = F.col("last").bitwiseAND(low) if order == 2 else F.col("last")
            level = level.withColumns({"lower_first": first, "lower_last": last})
        level = level.join(below, keys).withColumn("p", F.expr("(n - off) / total + kept / total * lower"))
        if order < ORDER:
            below = level.select("lang", F.col("first").alias("lower_first"), F.col("last").alias("lower_last"), F.col("p").alias("lower"))
            below = written(below, "rules-lower")
    return level.select("hash", F.ln("p").cast("float").alias("p"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """What counts of 0, 1, 2 and 3 or more lose: from the numbers of grams seen one to four times."""
    n = [max(int((counts == k).sum()), 1) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    off = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.1) for k in (1, 2, 3)]
    return np.array([0.0, *off])


def _hashed(language: str | None, codes: np.ndarray, order: int) -> np.ndarray:
    seed = xxhash.xxh64_intdigest((language or "").encode(), 2 * order + (language is None))
    return mix(codes.astype(np.uint64) ^ np.uint64(seed))


@dataclass
class Model:
    """The same smoothing in one process, over symbols of WIDTH bits, with back-off for grams that weren't counted.

    Per order: sorted hashes of (language, gram), log probabilities; sorted hashes of contexts, log back-off.
    """

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(counts: dict[str | None, tuple[np.ndarray, np.ndarray]]) -> Model:
        """From each language's gram codes and counts."""
        grams = [[] for _ in range(ORDER)]
        contexts = [[] for _ in range(ORDER)]
        for language, (codes, seen) in counts.items():
            # From full grams down: a shorter gram counts the different symbols seen before it.
            levels = [(codes.astype(np.int64), seen.astype(float))]
            for order in range(ORDER - 1, 0, -1):
                tail, times = np.unique(levels[0][0] & ((1 << WIDTH * order) - 1), return_counts=True)
                levels.insert(0, (tail, times.astype(float)))
            below, of_below = np.zeros(1, np.int64), np.array([1.0 / (1 << WIDTH)])
            for order, (code, times) in enumerate(levels, start=1):
                off = _discounts(times)[np.minimum(times, 3).astype(int)]
                context, back = np.unique(code >> WIDTH, return_inverse=True)
                total, kept_back = np.bincount(back, times), np.bincount(back, off)
                lower = of_below[np.searchsorted(below, code & ((1 << WIDTH * (order - 1)) - 1))]
                p = (times - off) / total[back] + kept_back[back] / total[back] * lower
                grams[order - 1].append((_hashed(language, code, order), np.log(p)))
                contexts[order - 1].append((_hashed(language, context, order), np.log(kept_back / total)))
                below, of_below = code, p
        return Model(*([Model._sorted(level) for level in kind] for kind in (grams, contexts)))

    @staticmethod
    def _sorted(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
        values = np.concatenate([p[1] for p in parts]).astype(np.float32) if parts else np.empty(0, np.float32)
        order = np.argsort(keys)
        return keys[order], values[order]

    @staticmethod
    def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
        """The values of keys; NaN where absent."""
        if not len(table[0]):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where(table[0][at] == keys, table[1][at], np.nan)

    def log_probabilities(self, language: str | None, codes: np.ndarray) -> np.ndarray:
        """Of each gram's last symbol after the others."""
        distinct, back = np.unique(codes, return_inverse=True)
        distinct = distinct.astype(np.int64)
        out, weight = np.full(len(distinct), np.nan), np.zeros(len(distinct))
        for order in range(ORDER, 0, -1):
            todo = np.flatnonzero(np.isnan(out))
            if not len(todo):
                break
            part = distinct[todo] & ((1 << WIDTH * order) - 1)
            out[todo] = self._look(self.grams[order - 1], _hashed(language, part, order)) + weight[todo]
            loss = self._look(self.contexts[order - 1], _hashed(language, part >> WIDTH, order))
            weight[todo] += np.nan_to_num(loss)  # an unseen context takes nothing off
        return np.where(np.isnan(out), weight - WIDTH * np.log(2), out)[back]


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text of a chunk."""
    words, docs = find_words(data, offsets), len(offsets) - 1
    first, counts = words.first, words.counts

    is_break = data == 10
    edges = np.unique(np.concatenate((np.flatnonzero(is_break) + 1, offsets)))
    starts, ends = edges[:-1], edges[1:]
    starts, ends = (e[ends > starts] for e in (starts, ends))
    ends = ends - is_break[ends - 1] if len(ends) else ends
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    _, once = np.unique(np.stack((owner.astype(np.uint64), run_hashes(data, starts, ends, fold=False))), axis=1, return_index=True)
    lines = np.bincount(owner, minlength=docs) - np.bincount(owner[once], minlength=docs)

    repeated = np.zeros(len(words.starts), bool)
    if len(repeated) >= 8:
        windows, begins = shingle_hashes(words.hashes(fold=False), first, 8)
        full = np.maximum(counts - 7, 0)
        windows = windows[np.repeat(counts >= 8, np.diff(begins))]
        doc = np.repeat(np.arange(docs), full)
        at = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(full)[:-1])), full) + np.arange(len(windows))
        order = np.lexsort((windows, doc))
        w, d = windows[order], doc[order]
        same = (w[1:] == w[:-1]) & (d[1:] == d[:-1])
        twice = np.zeros(len(w), bool)
        twice[1:] |= same
        twice[:-1] |= same
        change = np.zeros(len(repeated) + 9, np.int32)
        np.add.at(change, at[order[twice]], 1)
        np.add.at(change, at[order[twice]] + 8, -1)
        repeated = np.cumsum(change)[: len(repeated)] > 0
    return {
        "n_words": counts,
        "word_chars": _sums(LEADING[data], offsets),
        "n_symbols": _sums(SIGNS[data], offsets),
        "n_dup_lines": lines,
        "n_repeat_words": _sums(repeated, first),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _texts_scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], based: bool) -> DataFrame:
    """Of every row of docs: doc_id, lang, same, log_sum over the grams in the model, n_grams; if based, the base counts.

    ``same`` is a hash of the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # plain arrays, which executors load without this package
    counted = COUNTS if based else ()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, logs = shared.value
        for part, data, offsets in chunks(batches):
            names, index = _languages(part)
            first, last, begins = grams(data, offsets)
            which = np.repeat(index, np.diff(begins))
            keys = np.empty(len(first), np.int64)
            for k, name in enumerate(names):
                own = which == k
                keys[own] = gram_hashes(name, first[own], last[own])
            distinct, back = np.unique(keys, return_inverse=True)
            at = np.minimum(np.searchsorted(hashes, distinct), max(len(hashes) - 1, 0))
            values = np.where(hashes[at] == distinct, logs[at].astype(float), 0.0)[back] if len(hashes) else np.zeros(len(keys))
            same = [xxhash.xxh64_intdigest(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            base = base_counts(data, offsets) if based else {}
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part.column(0), "lang": pc.cast(part.column(1), pa.string()),
                 "same": pa.array(np.array(same, np.uint64).view(np.int64)),
                 "log_sum": pa.array(np.add.reduceat(values, begins[:-1]), pa.float64()),
                 "n_grams": pa.array(np.diff(begins), pa.int64()), **{c: pa.array(base[c], pa.int64()) for c in counted}}
            )

    counts = "".join(f", {c} long" for c in counted)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return slim.mapInArrow(run, f"doc_id long, lang string, same long, log_sum double, n_grams long{counts}")


def _ranges(model: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A model's (hashes, p) sorted, by ranges of hashes of about MODEL_ROWS at most."""
    parts = -(-model.count() // MODEL_ROWS)
    edges = [-(1 << 63) + (k << 64) // max(parts, 1) for k in range(max(parts, 1))] + [(1 << 63) - 1]
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        below = F.col("hash") <= b if k == len(edges) - 2 else F.col("hash") < b
        found = model.where((F.col("hash") >= a) & below).toArrow()
        hashes, logs = found["hash"].to_numpy(), found["p"].to_numpy()
        order = np.argsort(hashes)
        yield hashes[order], logs[order]


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts and log_perplexity (per gram) of every row of docs; ``model`` is written."""
    scored, more = None, []
    for part in _ranges(model):
        if scored is None:
            scored = written(_texts_scored(docs, part, True), "rules-scored")
        else:
            more.append(written(_texts_scored(docs, part, False).drop("n_grams"), "rules-more"))
    if more:
        key = ["doc_id", "lang", "same"]
        # Rows that are equal in these have the same sum in a pass.
        each = [rows.groupBy(*key).agg(F.max("log_sum").alias("log_sum")) for rows in more]
        rest = reduce(DataFrame.unionByName, each).groupBy(*key).agg(F.sum("log_sum").alias("rest"))
        rest = rest.select(*(F.col(c).alias(f"of_{c}") for c in key), "rest")
        on = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key]
        scored = scored.join(rest, on).withColumn("log_sum", F.col("log_sum") + F.col("rest"))
    return scored.select("doc_id", "lang", *COUNTS, (-F.col("log_sum") / F.col("n_grams")).alias("log_perplexity"))


def rules(docs: DataFrame, reach: float = 3.0, least_reach: float = 0.1, noise: float = 0.3) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity of every row.

    base_failed: fewer than 20 words, or over 30 % of the words in 8-word windows that
    come twice. Otherwise a document is kept if its log perplexity lies within `reach`
    times its language's interquartile range of the quartiles, at least `least_reach`,
    plus `noise` over the root of its words, as short texts scatter more; the quartiles
    are over the documents that pass the base rules. Null and
    empty texts have no words and fail. A null language is a language of its own.
    Repeated rows and ids are judged one by one; other columns are ignored.
    """
    counts = written(count_grams(docs), "rules-grams")
    scored = score(docs, written(probabilities(counts), "rules-model"))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    scored = scored.withColumn("base_failed", failed)
    quartiles = F.percentile_approx("log_perplexity", F.array(F.lit(0.25), F.lit(0.75)), F.lit(10000))
    bands = scored.where(~F.col("base_failed")).groupBy("lang").agg(quartiles.alias("q"))
    room = F.greatest((F.col("q")[1] - F.col("q")[0]) * reach, F.lit(least_reach))
    bands = written(bands.select(F.col("lang").alias("of"), (F.col("q")[0] - room).alias("low"), (F.col("q")[1] + room).alias("high")), "rules-bands")
    judged = scored.join(bands, F.col("lang").eqNullSafe(F.col("of")), "left")
    slack = F.lit(noise) / F.sqrt(F.greatest("n_words", F.lit(1)))
    within = F.col("log_perplexity").between(F.col("low") - slack, F.col("high") + slack)
    verdict = ~F.col("base_failed") & F.coalesce(within, F.lit(True))
    return judged.select("doc_id", *COUNTS, "base_failed", verdict.alias("kept"), "log_perplexity")
