"""Benchmark decontamination with spaced-seed hashing, in DataFrame expressions only.

A seed is a hash of five words at the places a mask keeps; the words between don't count,
so a seed survives their substitution. Three masks together meet every run of 8 to 13
words of which at least 80 % are equal (checked over all substitutions in the tests). A
shared seed of a document and a benchmark item fixes their alignment; there the words are
compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import few_or_shuffled, fresh, only_ids, without_ids, written

MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
#: Items of fewer words than the longest mask spans are hashed whole and must be held word for word.
LEAST_WORDS = 1 + max(m[-1] for m in MASKS)
#: Letters of scripts that put no space between words: each is a word.
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
#: A wide range that spans them all, quickly searched.
MAYBE_UNSPACED = r"[\u0E00-\u1FFF\u2E80-\x{3FFFF}]"


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text: runs of letters and digits, lower-cased, and single letters of unspaced scripts."""
    apart = F.when(text.rlike(MAYBE_UNSPACED), F.regexp_replace(text, UNSPACED, " $1 ")).otherwise(text)
    runs = F.split(F.lower(F.coalesce(apart, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(runs, ""), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """rows (id, words) with a row per place and mask, and per place and length of a short item: id, seed, place."""
    places = rows.select("id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("place"))
    seeds = [
        F.when(
            F.col("place") + mask[-1] < F.size("words"),
            F.xxhash64(F.lit(number), *(F.get("words", F.col("place") + o) for o in mask)),
        )
        for number, mask in [*enumerate(MASKS), *((-size, range(size)) for size in lengths)]
    ]
    return places.select("id", "place", F.explode(F.array(*seeds)).alias("seed"))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 80) -> DataFrame:
    """doc_id, item_id, item_words, matched, window_matched, place: a row per document and item it holds.

    A document (doc_id, text) holds an item (item_id, text) if, somewhere, `window`
    aligned words in a row (all words of a shorter item) are equal to at least
    `percent`; an item of fewer than LEAST_WORDS words must be there word for word. matched: equal words over the whole item; window_matched: in the best
    window; place: the document's word the item's first is aligned with, which is
    negative if the item's beginning is missing. Null and empty texts hold nothing;
    rows without an id can't be named and are left out; rows that share an id are
    reported together. Other columns are ignored.
    """
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("id"),
                                                          word_hashes(F.col("text").cast("string")).alias("words"))
    items = written(items.where(F.size("words") > 0).distinct(), "leak-items")
    short = F.size("words") < LEAST_WORDS
    lengths = sorted(r[0] for r in items.where(short).select(F.size("words")).distinct().collect())  # LEAST_WORDS - 1 at most
    whole = F.xxhash64(-F.size("words"), *(F.get("words", F.lit(k)) for k in range(LEAST_WORDS - 1)))
    whole = items.where(short).select("id", F.lit(0).alias("place"), whole.alias("seed"))
    probes = _seeds(items.where(~short), []).union(whole).where("seed IS NOT NULL").select("seed", F.col("id").alias("item_id"), F.col("place").alias("item_place"))
    probes = written(probes, "leak-probes")
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = texts.select(F.col("doc_id").alias("id"), word_hashes(F.col("text")).alias("words"))
    hits = _seeds(words.where(F.size("words") >= (lengths or [LEAST_WORDS])[0]), lengths).join(few_or_shuffled(probes), "seed")
    hits = hits.select(F.col("id").alias("doc_id"), "item_id", (F.col("place") - F.col("item_place")).alias("place"))
    hits = written(hits.distinct(), "leak-hits")

    ids = written(hits.select("doc_id").distinct(), "leak-ids")
    held = only_ids(texts, ids, "doc_id").select("doc_id", word_hashes(F.col("text")).alias("words"))
    named = items.select(F.col("id").alias("item_id"), F.col("words").alias("item"))
    aligned = hits.join(named, "item_id").join(held, "doc_id")
    equal = F.transform(
        "item", lambda w, k: (F.coalesce(F.get("words", F.col("place") + k) == w, F.lit(False))).cast("int")
    )
    aligned = aligned.select("doc_id", "item_id", "place", equal.alias("equal"))
    span = F.least(F.lit(window), F.size("equal"))
    in_window = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size("equal") - span + 1),
            lambda at: F.aggregate(F.slice("equal", at, span), F.lit(0), lambda a, x: a + x),
        )
    )
    aligned = aligned.select(
        "doc_id", "item_id", "place", F.size("equal").alias("item_words"), span.alias("span"),
        F.aggregate("equal", F.lit(0), lambda a, x: a + x).alias("matched"), in_window.alias("window_matched"),
    )
    best = F.max(F.struct("window_matched", "matched", (-F.col("place")).alias("place"), "item_words"))
    needed = F.when(F.col("item_words") < LEAST_WORDS, F.lit(100)).otherwise(F.lit(percent))
    found = aligned.where(F.col("window_matched") * 100 >= F.col("span") * needed)
    found = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select("doc_id", "item_id", "b.item_words", "b.matched", "b.window_matched", (-F.col("b.place")).alias("place"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that hold a benchmark item, whatever their id: a row is judged by its text."""
    key, name = F.xxhash64(F.col("text").cast("string")), fresh(docs, "_key")
    ids = leaks(docs.select(key.alias("doc_id"), "text"), benchmark, **options).select(F.col("doc_id").alias(name)).distinct()
    return without_ids(docs.withColumn(name, key), written(ids, "leak-found"), name).select(docs.columns)
