"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts makes each document's set of word shingles (64-bit hashes),
   its MinHash signature, band keys, and two sums that identify the set.
2. Documents with the same set form a class; only its smallest doc_id goes on.
3. Each band bucket links its members to its smallest member: one candidate per member,
   never all pairs.
4. Candidates compare signatures batch by batch; one is dropped as soon as the posterior
   probability of reaching the threshold falls below `miss`.
5. Each document's likeliest survivor is verified on the full sets.
6. What this leaves apart is settled exactly. Surviving candidates between different
   components are verified. In every bucket whose members other than the smallest still
   lie in several components, the members outside its largest one meet the others in
   blocks, under the same Bayesian comparison and then on full sets, within the task;
   only links between components come out. Pairs inside a component need no comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import components, only_ids, without_ids, written
from sensorloom.llm.words import chunks, find_words, mix, seeded, shingle_hashes

BANDS, ROWS = 25, 5
BATCH = 25  # hashes compared before each look at the posterior
BLOCK = 512  # members of a bucket compared at once in the last step, at most
BLOCK_SHINGLES = 1 << 18  # shingles of such a block, about
PACK_SHINGLES = 1 << 19  # shingles of the blocks a task of the last step holds at a time, about


@cache
def least_matches(threshold: float, miss: float, hashes: int, batch: int) -> tuple[int, ...]:
    """After each batch, the fewest matches with P(similarity >= threshold | matches) >= miss (uniform prior).

    The posterior after m matches of n is Beta(m + 1, n - m + 1), whose tail is a sum of
    binomial terms.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def _sets(data, offsets, shingle: int) -> list[np.ndarray]:
    words = find_words(data, offsets)
    hashes, begins = shingle_hashes(words.hashes(), words.first, shingle)
    return [np.unique(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]


def _signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n minima per set, 16 bits each; sets without members get zeros."""
    out = np.zeros((len(sets), n), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    joined = np.concatenate([sets[i] for i in full])
    begins = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
    factors, terms = seeded(n, 11) | np.uint64(1), seeded(n, 12)
    values = np.empty(len(joined), np.uint64)
    for j in range(n):
        np.multiply(joined, factors[j], out=values)
        values += terms[j]
        out[full, j] = mix(np.minimum.reduceat(values, begins)) >> np.uint64(48)
    return out


def features(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n, set_a, set_b, signature, keys of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            sets = _sets(data, offsets, shingle)
            signatures = _signatures(sets, bands * rows)
            keys = np.empty((len(sets), bands), np.uint64)
            for band in range(bands):
                key = np.full(len(sets), band + 1, np.uint64)
                for j in range(band * rows, (band + 1) * rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, j].astype(np.uint64))
                keys[:, band] = key
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column(0),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "set_a": pa.array([int(s.sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                    "set_b": pa.array([int(mix(s).sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                    "signature": pa.array([s.tobytes() for s in signatures], pa.binary()),
                    "keys": pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                }
            )

    schema = "doc_id long, n long, set_a long, set_b long, signature binary, keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _bayes(left: np.ndarray, right: np.ndarray, least: tuple[int, ...], batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows survive all batches, and their matches."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for step, need in enumerate(least):
        at = slice(step * batch, (step + 1) * batch)
        matches[alive] += (left[alive, at] == right[alive, at]).sum(axis=1)
        alive = alive[matches[alive] >= need]
    return alive, matches


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), -1)


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int, label: str) -> DataFrame:
    """doc_id, members (the full set) of the documents in ids, made anew from their texts alone."""
    ids = written(ids, f"{label}-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            sets = [s.view(np.int64) for s in _sets(data, offsets, shingle)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part.column(0), "members": pa.array(sets, pa.list_(pa.int64()))}
            )

    texts = only_ids(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), ids, "doc_id")
    return texts.mapInArrow(run, "doc_id long, members array<long>")


def verified(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int, label: str) -> DataFrame:
    """Pairs (a, b) of doc_ids whose full sets reach the threshold."""
    pairs = written(pairs.select("a", "b").distinct(), f"{label}-pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = written(full_sets(docs, ids, shingle, label), f"{label}-sets")
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("members").alias("of_a")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("members").alias("of_b")), "b")
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    total = F.size("of_a") + F.size("of_b") - shared
    return both.where((shared * 100 >= total * percent) & (total > 0)).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = 1e-6,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text).

    Documents are linked if 100 * shared >= percent * united shingles; component_id is
    the smallest doc_id reachable. Null, empty and wordless texts have no shingles and
    link with nothing; a text of fewer words than a shingle has its whole sequence as
    the only one. Rows of the same doc_id are one document: all get its component. A row
    without doc_id links with nothing: null component, kept. Other columns are ignored.
    """
    least = least_matches(percent / 100, miss, bands * rows // BATCH * BATCH, BATCH)
    docs = docs.select("doc_id", "text")
    made = written(features(docs, shingle, bands, rows), "near-features")
    usable = made.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(
        usable.groupBy("set_a", "set_b", "n").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
            F.first("signature").alias("signature"), F.first("keys").alias("keys"),
        ),
        "near-classes",
    )
    copies = classes.where("copies > 1").select("set_a", "set_b", "n", "rep")
    same = usable.join(copies, ["set_a", "set_b", "n"]).where("doc_id <> rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")
    )

    # Buckets with more than one member, and each one's smallest member.
    members = classes.select("rep", "n", F.explode("keys").alias("key"))
    hubs = members.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    buckets = written(members.join(hubs.select("key", "hub"), "key"), "near-buckets")
    signatures = classes.select("rep", "signature")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                alive, matches = _bayes(_matrix(frame.of_a), _matrix(frame.of_b), least, BATCH)
                yield pd.DataFrame({"a": frame.a.iloc[alive], "b": frame.b.iloc[alive], "matches": matches[alive]})

    first = buckets.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    first = first.join(signatures.select(F.col("rep").alias("a"), F.col("signature").alias("of_a")), "a")
    first = first.join(signatures.select(F.col("rep").alias("b"), F.col("signature").alias("of_b")), "b")
    likely = written(first.mapInPandas(compare, "a long, b long, matches int"), "near-likely")
    best = likely.groupBy("a").agg(F.max(F.struct("matches", (-F.col("b")).alias("b"))).alias("best"))
    best = best.select("a", (-F.col("best.b")).alias("b"))
    linked = written(verified(docs, best, shingle, percent, "near-first"), "near-linked")
    joined = written(components(linked, "near-one"), "near-joined")

    # What is still apart: survivors not yet verified, and buckets that hold several components.
    of_a, of_b = (joined.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
    apart = likely.join(of_a, "a", "left").join(of_b, "b", "left").join(best, ["a", "b"], "left_anti")
    apart = apart.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
    late = verified(docs, apart, shingle, percent, "near-apart")

    placed = buckets.where("rep <> hub").join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
    placed = placed.select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    parts = parts.groupBy("key").agg(
        F.max(F.struct("size", "component", "shingles")).alias("main"), F.sum("size").alias("size"),
        F.sum("shingles").alias("shingles"), F.count("*").alias("parts"),
    ).where("parts > 1")

    def pieces(size, shingles):
        return F.greatest(F.ceil(size / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    main = F.col("main")
    parts = parts.select(
        "key", main["component"].alias("main"), pieces(F.col("size"), F.col("shingles")).alias("all"),
        pieces(F.col("size") - main["size"], F.col("shingles") - main["shingles"]).alias("lights"),
    )
    placed = written(placed.join(parts, "key"), "near-placed")
    sets = full_sets(docs, placed.select(F.col("rep").alias("doc_id")).distinct(), shingle, "near-placed")
    whole = placed.join(sets.withColumnRenamed("doc_id", "rep"), "rep").join(signatures, "rep")
    own = {c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int") for c in ("all", "lights")}
    every = {c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("all", "lights")}
    columns = ["key", "rep", "component", "signature", "members"]
    queries = whole.where("component <> main").select(
        *columns, F.lit(True).alias("light"), own["lights"].alias("row"), every["all"].alias("column")
    )
    others = whole.select(
        *columns, F.lit(False).alias("light"), every["lights"].alias("row"), own["all"].alias("column")
    )
    copies = F.col("lights") + F.when(F.col("component") != F.col("main"), F.col("all")).otherwise(F.lit(0))
    volume = placed.agg(F.sum(F.col("n") * copies)).first()[0] or 0
    packs = volume // PACK_SHINGLES + 1
    meeting = queries.union(others).withColumn("pack", F.pmod(F.xxhash64("key", "row", "column"), F.lit(packs)))

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        """Links between components that light members and blocks of others share."""
        found: list[tuple[int, int]] = []
        frame = frame.sort_values(["key", "row", "column", "light"], ignore_index=True)
        signature = _matrix(frame.signature)
        rep, part, members = frame.rep.to_numpy(), frame.component.to_numpy(), frame.members.to_list()
        light, sizes = frame.light.to_numpy(), np.array([len(m) for m in members])
        place = frame[["key", "row", "column"]].to_numpy()
        cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1), len(frame)]
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            split = start + int(np.count_nonzero(~light[start:end]))
            others = np.arange(start, split)
            for q in range(split, end):
                near = others[
                    (part[others] != part[q])
                    & (np.minimum(sizes[others], sizes[q]) * 100 >= np.maximum(sizes[others], sizes[q]) * percent)
                ]
                own = np.broadcast_to(signature[q], (len(near), signature.shape[1]))
                alive, matches = _bayes(own, signature[near], least, BATCH)
                for other in near[alive[np.argsort(-matches[alive])]]:
                    if root(part[q]) != root(part[other]):
                        shared = len(np.intersect1d(members[q], members[other], assume_unique=True))
                        if shared * 100 >= (sizes[q] + sizes[other] - shared) * percent:
                            top[root(part[q])] = root(part[other])
                            found.append((rep[q], rep[other]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    late = written(late.union(meeting.groupBy("pack").applyInPandas(meet, "a long, b long")), "near-late")

    group = components(linked.union(late).union(same), "near-all")
    return made.join(group.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.expr("doc_id <=> coalesce(component, doc_id)").alias("kept"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group of near-duplicates: the one of the smallest doc_id.

    Of rows that share a doc_id one stays, the first by a hash of its text and then by
    its other columns; rows without an id all stay.
    """
    found = written(near_duplicates(docs, **options), "near-found")
    dropped = written(found.where("NOT kept").select("doc_id").distinct(), "near-dropped")
    repeated = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"))
    repeated = written(repeated.where("rows > 1").select("doc_id"), "near-repeated")
    kept = without_ids(docs, dropped, "doc_id")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), *(c for c in docs.columns if c != "doc_id"))
    single = only_ids(kept, repeated, "doc_id").withColumn("_turn", F.row_number().over(first))
    return without_ids(kept, repeated, "doc_id").unionByName(single.where("_turn = 1").drop("_turn"))
