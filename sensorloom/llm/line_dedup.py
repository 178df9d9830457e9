"""Near-duplicate lines by a segment-partition edit join.

Two lines are linked if their edit distance is at most t, which grows with the longer
line's length (one edit per 10 characters, `edits` at most). If a line is cut into t + 1
segments, t edits leave one of them untouched, so a line within t edits holds that segment
near its old place. Every line is indexed under its segments and probes, for each length it
can match, only the places where a segment can lie given the difference in length and the
edits used up on either side.

Equal lines are one node. Lines that meet under a segment never give all pairs: each meets
the group's smallest indexed line; a group that then still holds several components is
settled in blocks inside tasks, and only links between components come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import components, few_or_shuffled, only_ids, written
from sensorloom.llm.words import _POWERS, chunks, mix

EDITS = 2
PER_EDIT = 10
BLOCK, PACK = 512, 2048


def allowed(length, edits: int):
    """Edits two lines may differ by, the longer of `length` characters."""
    return np.minimum(np.asarray(length) // PER_EDIT, edits)


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance of a and b is at most k.

    Equal ends are cut off. The rest runs through a band of 2k + 1 diagonals whose
    vertical differences are two bit vectors that slide along the main diagonal.
    """
    if abs(len(a) - len(b)) > k:
        return False
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    b, a = sorted((a[start : len(a) - end], b[start : len(b) - end]), key=len)
    if len(a) <= k or not b:
        return len(a) <= k
    if not k:
        return False
    width = 2 * k + 1
    full = (1 << width) - 1
    up, down, score = full & (full << k), 0, k
    top, side = 1 << (width - 1), 1 << (width - 2)
    for i, letter in enumerate(b):
        match, low = 0, i - k
        for bit in range(max(0, -low), min(width, len(a) - low)):
            if a[low + bit] == letter:
                match |= 1 << bit
        zero = ((((match & up) + up) ^ up) | match | down) & full
        right, left = (down | ~(zero | up)) & full, zero & up
        if i < len(a) - k:  # the band's last row is still inside: follow its diagonal
            score += not zero & top
        else:  # along the last row
            score += bool(right & side) - bool(left & side)
            side >>= 1
        shifted = zero >> 1
        up, down = (left | ~(shifted | right)) & full, shifted & right
        if score > 2 * k + len(b) - len(a):
            return False
    return score <= k


def _segments(lengths: np.ndarray, parts: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i of lines cut into `parts` even parts, longer ones last."""
    size, longer = lengths // parts, parts - lengths % parts
    return i * size + np.maximum(i - longer, 0), size + (i >= longer)


def _keys(data: np.ndarray, offsets: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """(row, key, indexed) arrays of a chunk's lines."""
    letters = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    starts = heads[offsets[:-1]]
    lengths = heads[offsets[1:]] - starts
    _POWERS.upto(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(mix(letters + np.uint64(1)) * _POWERS.up[: len(letters)], out=sums[1:])

    def key(rows, of_length, parts, i, at, size):
        a = starts[rows] + at
        label = (of_length * 64 + parts * 8 + i).astype(np.uint64)
        return mix(mix((sums[a + size] - sums[a]) * _POWERS.down[a]) ^ mix(label))

    found, own = [], allowed(lengths, edits)
    for t in range(1, edits + 1):
        rows = np.flatnonzero((own <= t) & (allowed(lengths + edits, edits) >= t) & (lengths > t) | (own == t))
        for i in range(t + 1):
            at, size = _segments(lengths[rows], t + 1, i)
            found.append((rows, key(rows, lengths[rows], t + 1, i, at, size), True))
        for less in range(t + 1):
            rows = np.flatnonzero(own == t)
            rows = rows[lengths[rows] - less > t]
            for i in range(t + 1):
                at, size = _segments(lengths[rows] - less, t + 1, i)
                # Edits before the segment are i at most, those after it t - i.
                for shift in range(max(-i, less - (t - i)), min(i, less + t - i) + 1):
                    if less or shift:
                        fits = (at + shift >= 0) & (at + shift + size <= lengths[rows])
                        r = rows[fits]
                        found.append((r, key(r, lengths[r] - less, t + 1, i, at[fits] + shift, size[fits]), False))
    return found


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, line, id of every line with a word."""
    lines = docs.select(
        F.col("doc_id").cast("long"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line")
    ).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.withColumn("id", F.xxhash64("line", F.length("line")))


def _link(edits: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [
                within(a, b, int(allowed(max(len(a), len(b)), edits)))
                for a, b in zip(frame.line_a, frame.line_b, strict=True)
            ]
            yield frame.loc[keep, ["a", "b"]]

    return run


def near_duplicate_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, line_no, class_id, class_lines, kept of every line with a word in docs (doc_id, text).

    Lines are cut at \\n and compared as they are. A class holds the lines reachable over
    links; class_id is the smallest id (a hash of the line) in it, class_lines the number
    of its lines. The one of the smallest doc_id and line number is kept; a null doc_id
    comes last, and among rows that repeat with the same id and number all are kept.
    Lines without a word, null and empty texts have no rows. Other columns are ignored.
    """
    lines = _lines(docs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, "line"):
            ids = part.column(0).to_numpy()
            _, once = np.unique(ids, return_index=True)
            once = np.isin(np.arange(len(ids)), once)
            for rows, keys, indexed in _keys(data, offsets, edits):
                first = once[rows]
                if first.any():
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": keys[first].view(np.int64), "id": ids[rows[first]],
                            "indexed": pa.array(np.full(int(first.sum()), indexed)),
                        }
                    )

    made = lines.select("id", "line").mapInArrow(emit, "key long, id long, indexed boolean")
    indexed = F.when(F.col("indexed"), F.col("id"))
    groups = made.groupBy("key").agg(F.min(indexed).alias("hub"), F.min("id").alias("low"), F.max("id").alias("high"))
    groups = written(groups.where("hub IS NOT NULL AND low < high").select("key", "hub"), "line-groups")
    members = made.join(few_or_shuffled(groups), "key").groupBy("key", "hub", "id").agg(F.max("indexed").alias("indexed"))
    members = written(members, "line-members")
    involved = written(members.select("id").distinct(), "line-involved")
    texts = only_ids(lines.select("id", "line"), involved, "id").groupBy("id").agg(F.first("line").alias("line"))
    texts = written(texts, "line-texts")

    def named(name: str) -> DataFrame:
        return texts.select(F.col("id").alias(name), F.col("line").alias(f"line_{name}"))

    pairs = members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    pairs = pairs.join(named("a"), "a").join(named("b"), "b")
    links = written(pairs.mapInPandas(_link(edits), "a long, b long"), "line-links")
    joined = written(components(links, "line-one"), "line-joined")

    # Groups whose lines other than the hub still lie in several components, one of them indexed.
    placed = members.where("id <> hub").join(joined.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("key", "id", "indexed", F.coalesce("component", "id").alias("component"))
    parts = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("all"),
        F.count_if("indexed").alias("indexes"),
    ).where("low < high AND indexes > 0")
    placed = written(placed.join(parts.select("key", "all", "indexes"), "key"), "line-placed")
    pieces = {c: F.ceil(F.col(c) / BLOCK).cast("int") for c in ("all", "indexes")}
    own = {c: F.pmod(F.xxhash64("id"), n).cast("int") for c, n in pieces.items()}
    every = {c: F.explode(F.sequence(F.lit(0), n - 1)) for c, n in pieces.items()}
    whole = placed.join(texts, "id")
    columns = ["key", "id", "component", "line"]
    queries = whole.where("indexed").select(*columns, F.lit(True).alias("query"), own["indexes"].alias("row"), every["all"].alias("column"))
    others = whole.select(*columns, F.lit(False).alias("query"), every["indexes"].alias("row"), own["all"].alias("column"))
    packs = max(1, placed.count() // PACK)
    meeting = queries.union(others).withColumn("pack", F.pmod(F.xxhash64("key", "row", "column"), F.lit(packs)))

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        found, seen = [], set()
        for _, group in frame.groupby(["key", "row", "column"], sort=False):
            rest = group[~group["query"]]
            asks = group[group["query"]]
            for a, part, line in zip(asks.id, asks.component, asks.line, strict=True):
                for b, other, text in zip(rest.id, rest.component, rest.line, strict=True):
                    if root(part) != root(other) and (a, b) not in seen:
                        seen.add((a, b))
                        if within(line, text, int(allowed(max(len(line), len(text)), edits))):
                            top[root(part)] = root(other)
                            found.append((a, b))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    late = written(meeting.groupBy("pack").applyInPandas(meet, "a long, b long"), "line-late")
    classes = components(links.union(late), "line-all")
    slim = lines.select("doc_id", F.col("line_no").cast("int"), "id").join(classes.withColumnRenamed("node", "id"), "id", "left")
    slim = written(slim.select("doc_id", "line_no", F.coalesce("component", "id").alias("class_id")), "line-rows")
    place: Column = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no")
    heads = written(slim.groupBy("class_id").agg(F.min(place).alias("head"), F.count("*").alias("class_lines")), "line-heads")
    shared = heads.where("class_lines > 1")
    found = slim.join(shared, "class_id", "left")
    return found.select(
        "doc_id", "line_no", "class_id", F.coalesce("class_lines", F.lit(1)).cast("long").alias("class_lines"),
        (F.col("head").isNull() | (F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.line_no") == F.col("line_no")))).alias("kept"),
    )
