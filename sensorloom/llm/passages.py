"""Near-duplicate passages by compact windows over the min-hashes of word shingles.

For each of a few hash functions, the Cartesian tree over a text's shingle hashes groups
all passages of at least a given length by the place of their smallest hash: one compact
window per tree node, about two per length of text. Passages that share the window's
smallest shingle under a function may be near-duplicates.

1. Equal texts are one unit; windows are made once per unit.
2. Windows are joined on their smallest shingle. A group never gives all pairs: each
   window meets the group's smallest unit, and where its surroundings differ from that
   one's, also the smallest unit with the same shingle 16 places to the left, or to the
   right. An exact passage of the least length has at least one of the two in common.
3. A group of equal surroundings can share less than a passage, and its smallest unit no more.
   Where three or more windows of the first function have the same ones, their units meet again over
   each exact passage of the least length around these places: units that share one all
   have it in common with that group's smallest, so no exact repeat is left apart.
4. Pairs of units that meet in equal surroundings or an exact passage, and those of which windows under enough
   hash functions intersect on both sides (an interval join: one passage can lie in all of them),
   are verified on their words: the two shingle lists are joined, and from each stretch of equal
   shingles along any alignment to each later one the passages' shingle sets are compared.
5. Links are stars, so passages get classes: those of one document that overlap by the least length
   are one, and those that links join have the same class. Units with an exact passage in common are
   both linked by it with the smallest such unit, and so are in a class together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import components, few_or_shuffled, n_words, only_ids, written
from sensorloom.llm.words import chunks, find_words, mix, seeded, shingle_hashes

HASHES, ENOUGH = 4, 2
AROUND = 16
DENSE = 64  # equal pairs per shingle up to which a pair's are joined at once
TOGETHER = 64  # passages compared at once
ONE = (1 << 32) - 1
AHEAD = 512  # places behind a start that are looked at for its bound

_STEP = seeded(1, 23)[0] | np.uint64(1)


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first, place of the smallest value, end) of every Cartesian-tree node that spans at least `least` values.

    Each passage of that length has its smallest value in exactly one of them, which spans it.
    """
    found, todo = [], [(0, len(values))] if len(values) >= max(least, 1) else []
    while todo:
        a, b = todo.pop()
        c = a + int(values[a:b].argmin())
        found.append((a, c, b))
        if c - a >= least:
            todo.append((a, c))
        if b - c > least:
            todo.append((c + 1, b))
    return found


def windows(texts: DataFrame, least: int, width: int, hashes: int) -> DataFrame:
    """key, unit, j, first, c, end, left, right: each compact window's smallest shingle under function j, its extent, place and surroundings."""
    factors, terms = seeded(hashes, 21) | np.uint64(1), seeded(hashes, 22)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            words = find_words(data, offsets)
            shingles, begins = shingle_hashes(words.hashes(), words.first, width)
            begins = begins.tolist()
            units = part.column(0).to_numpy()
            values = [shingles * f + t for f, t in zip(factors, terms, strict=True)]
            spans, owner, function = [], [], []
            for doc in range(len(units)):
                a, b = begins[doc], begins[doc + 1]
                if b - a >= least:
                    for j in range(hashes):
                        found = compact_windows(values[j][a:b], least)
                        spans += found
                        owner += [doc] * len(found)
                        function += [j] * len(found)
            if not spans:
                continue
            spans, owner, function = np.array(spans, np.int32), np.array(owner), np.array(function)
            start, end = np.array(begins)[owner], np.array(begins)[owner + 1]
            place = start + spans[:, 1]
            sides = []
            for step in (-AROUND, AROUND):
                at = place + step
                inside = (at >= start) & (at < end)
                side = (shingles[np.clip(at, 0, len(shingles) - 1)] >> np.uint64(33)).astype(np.int32)
                sides.append(np.where(inside, np.maximum(side, 1), 0).astype(np.int32))
            keys = mix(shingles[place] + function.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": keys.view(np.int64), "unit": units[owner], "j": function.astype(np.int8),
                    "first": spans[:, 0], "c": spans[:, 1], "end": spans[:, 2], "left": sides[0], "right": sides[1],
                }
            )

    return texts.select("unit", "text").mapInArrow(run, "key long, unit long, j byte, first int, c int, end int, left int, right int")


def _sides() -> Column:
    """A row per side of a window: which one, and its surroundings."""
    return F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(s).alias("value")) for s in ("left", "right"))))


def _same_exactly(met: DataFrame, once: DataFrame, least: int, width: int) -> DataFrame:
    """(unit, hub): each unit of an exact passage of `least` shingles and the smallest one, where a window's surroundings are common to three windows."""
    around = met.where("j = 0").select("key", "unit", "first", "c", "end", _sides().alias("s")).where("s.value <> 0")
    around = around.select(F.xxhash64("key", "s.side", "s.value").alias("key"), "unit", "first", "c", "end")
    # In a group of two, one is the hub.
    crowded = around.groupBy("key").agg(F.min("unit").alias("low"), F.max("unit").alias("high"), F.count("*").alias("n"))
    crowded = written(crowded.where("low < high AND n > 2").select("key"), "passage-crowded")
    places = around.join(few_or_shuffled(crowded), "key", "left_semi")
    places = places.groupBy("unit").agg(F.collect_set(F.struct("first", "c", "end")).alias("places"))  # as many as a text has at most
    places = written(places, "passage-places")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            words = find_words(data, offsets)
            shingles, begins = shingle_hashes(words.hashes(), words.first, width)
            rolled = np.zeros(len(shingles) - least + 1, np.uint64)
            for k in range(least):
                rolled = rolled * _STEP + shingles[k : k + len(rolled)]
            lists = part.column("places")
            first, c, end = (lists.flatten().field(k).to_numpy() for k in range(3))
            sizes = lists.value_lengths().to_numpy()
            start = np.repeat(begins[:-1], sizes)
            low, high = start + np.maximum(first, c - least + 1), start + np.minimum(c, end - least)
            counts = high - low + 1
            at = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
            units = np.repeat(np.repeat(part.column("unit").to_numpy(), sizes), counts)
            yield pa.RecordBatch.from_pydict({"key": mix(rolled[at]).view(np.int64), "unit": units})

    some = only_ids(once.select("unit", "text"), places.select("unit"), "unit").join(places, "unit")
    exact = written(some.mapInArrow(spread, "key long, unit long"), "passage-exact")
    heads = exact.groupBy("key").agg(F.min("unit").alias("hub"), F.max("unit").alias("last")).where("hub < last")
    heads = written(heads.select("key", "hub"), "passage-heads")
    return exact.join(heads, "key").where("unit <> hub").select("unit", "hub").distinct()


def intersect(windows: np.ndarray, least: int, enough: int) -> bool:
    """Whether windows of `enough` functions, each shared by two texts, can hold one passage of `least` on both sides.

    A row is (function, first, c, end) and the other text's (first, c, end). The passage lies
    inside all these windows and covers their places c, so the window whose c is leftmost is
    compared with those to its right, in blocks, up to a hit.
    """
    windows = windows[np.argsort(windows[:, 2], kind="stable")]
    function = np.int64(1) << windows[:, 0].astype(np.int64)
    for part in range(0, len(windows), 64):
        one = windows[part : part + 64, None]
        near = int(np.searchsorted(windows[:, 2], one[:, 0, 3].max()))
        seen = function[part : part + 64].copy()
        for block in range(part, near, 4096):
            other = windows[None, block : min(block + 4096, near)]
            fits = np.ones((one.shape[0], other.shape[1]), bool)
            for first, c, end in ((1, 2, 3), (4, 5, 6)):
                fits &= (other[..., first] <= one[..., c]) & (one[..., first] <= other[..., c])
                fits &= (other[..., c] < one[..., end]) & (one[..., c] < other[..., end])
                fits &= np.minimum(one[..., end], other[..., end]) - np.maximum(one[..., first], other[..., first]) >= least
            seen |= np.bitwise_or.reduce(np.where(fits, function[None, block : block + other.shape[1]], 0), axis=1)
            if (np.bitwise_count(seen) >= enough).any():
                return True
    return False


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) spans in order, those that overlap or touch as one."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((start, end))
    return found


def _kinds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The values of a and of b as numbers from 0, equal ones alike; how many there are. Two bytes each if these do, which sort in linear time."""
    values = np.concatenate((a, b))
    order = values.argsort()
    values = values[order]
    number = np.zeros(len(values), np.int64)
    np.cumsum(values[1:] != values[:-1], out=number[1:])
    n = int(number[-1]) + 1
    kinds = np.empty(len(values), np.uint16 if n <= 1 << 16 else np.int64)
    kinds[order] = number
    return kinds[: len(a)], kinds[len(a) :], n


def _runs(a: np.ndarray, b: np.ndarray, times_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in a, start in b and size of every stretch of equal values along any alignment; `times_b`: how often b has each value."""
    counts = times_b[a]
    total = int(counts.sum())
    if total <= DENSE * (len(a) + len(b)):
        if counts.max() <= 1:  # one alignment per place: a stretch's places follow each other
            at = np.empty(len(times_b), np.int64)
            at[b] = np.arange(len(b))
            i = counts.nonzero()[0]
            j = at[a[i]]
        else:
            low = (times_b.cumsum() - times_b)[a]
            i = np.arange(len(a)).repeat(counts)
            j = b.argsort(kind="stable")[(low - counts.cumsum() + counts).repeat(counts) + np.arange(total)]
            shift = j - i + len(a)
            along = (shift.astype(np.uint16) if len(a) + len(b) <= 1 << 16 else shift).argsort(kind="stable")
            i, j = i[along], j[along]
        new = np.ones(total + 1, bool)
        new[1:-1] = (i[1:] - i[:-1] != 1) | (j[1:] - j[:-1] != 1)
        edges = new.nonzero()[0]
        return i[edges[:-1]], j[edges[:-1]], edges[1:] - edges[:-1]
    # Texts that repeat themselves have more equal pairs than is good to hold: alignment by alignment.
    parts = []
    for shift in range(1 - len(a), len(b)):
        first, last = max(0, -shift), min(len(a), len(b) - shift)
        edges = np.flatnonzero(np.diff(a[first:last] == b[first + shift : last + shift], prepend=False, append=False)) + first
        if len(edges):
            parts.append(np.stack([edges[::2], edges[::2] + shift, edges[1::2] - edges[::2]]))
    return tuple(np.concatenate(parts, axis=1))


def _running(marked: np.ndarray) -> np.ndarray:
    """Marked places before each place and the end."""
    found = np.zeros(len(marked) + 1, np.int64)
    marked.cumsum(out=found[1:])
    return found


def _previous(values: np.ndarray) -> np.ndarray:
    """The place of the same value's last occurrence before each place, or -1."""
    order = values.argsort(kind="stable")
    found = np.full(len(values), -1)
    found[order[1:]] = np.where(values[order[1:]] == values[order[:-1]], order[:-1], -1)
    return found


def _ends_within(lacks: np.ndarray, last: np.ndarray, starts: np.ndarray, reach: int, most: int, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Per start a bound on the end of its passages, up to which at most `most` different values are lacking; how many of the first `least` are.

    The bound is 0 where no end up to it leaves `percent` of the side's different values to
    both sides, and the text's end where it lies over AHEAD places behind the start. No end over `reach` behind it is needed.
    """
    width = min(AHEAD, len(lacks), reach)
    bounds, soon = np.full(len(starts), len(lacks)), np.zeros(len(starts), np.int64)
    # Behind the end there are no new values.
    lasts = np.lib.stride_tricks.sliding_window_view(np.concatenate((last, np.full(width, len(lacks)))).astype(np.int32), width)
    absent = np.lib.stride_tricks.sliding_window_view(np.concatenate((lacks, np.zeros(width, bool))), width)
    for part in range(0, len(starts), 256):
        at = starts[part : part + 256]
        new = lasts[at] < at[:, None].astype(np.int32)
        lacking = np.cumsum(new & absent[at], axis=1, dtype=np.uint16)  # 100 times AHEAD fits in
        every = np.cumsum(new, axis=1, dtype=np.uint16)
        over = lacking > most
        ends = np.where(over[:, -1], over.argmax(1), width)  # places that fit
        fits = ((every - lacking) * 100 >= every * percent) & ~over
        fits[:, : least - 1] = False
        bound = np.where(fits.any(1), at + ends, 0)
        bounds[part : part + 256] = np.where(ends < width, bound, len(lacks)) if width == AHEAD else bound
        soon[part : part + 256] = lacking[:, least - 1]
    return bounds, soon


def shared_passages(a: np.ndarray, b: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(start, end) in a and in b of near-duplicate passages of two shingle sequences, along all alignments.

    A passage begins with a stretch of equal shingles and ends with one; to take in the whole
    of either never lowers the similarity, so passages from stretch to stretch cover all others.
    What passages already given cover on both sides isn't given again.
    """
    if not len(a) or not len(b):
        return []
    kind_a, kind_b, n_kinds = _kinds(a, b)
    times_a, times_b = np.bincount(kind_a, minlength=n_kinds), np.bincount(kind_b, minlength=n_kinds)
    x, y, size = _runs(kind_a, kind_b, times_b)
    if len(x) < 2:  # one stretch of equal shingles, the passage itself
        return [(i, i + n, j, j + n) for i, j, n in zip(x.tolist(), y.tolist(), size.tolist(), strict=True) if n >= least]
    # Values that the other side lacks; those that come more than once don't count.
    lacks_a, lacks_b = times_b[kind_a] == 0, times_a[kind_b] == 0
    more_a, more_b = _running(lacks_a & (times_a[kind_a] == 1)), _running(lacks_b & (times_b[kind_b] == 1))

    # At `percent` likeness at least percent of a side's places are in both, so a side's share of lacking ones is bounded.
    reach, back = [], []
    for more, start, end in ((more_a, x, x + size), (more_b, y, y + size)):
        weight = more * 100 - np.arange(len(more)) * (100 - percent)
        lowest = np.minimum.accumulate(weight[::-1])[::-1]
        highest = np.maximum.accumulate(weight)
        reach.append(np.searchsorted(lowest, weight[start], side="right") - 1)  # the farthest end
        back.append(np.searchsorted(highest, weight[end], side="left"))  # the farthest start
    begins = np.flatnonzero((reach[0] - x >= least) & (reach[1] - y >= least))
    ends = np.flatnonzero((x + size - back[0] >= least) & (y + size - back[1] >= least))
    if not len(begins) or not len(ends):
        return []
    begins = begins[np.lexsort((-size[begins], x[begins]))]
    ends = ends[np.argsort(x[ends] + size[ends], kind="stable")]
    end_x, end_y = x[ends] + size[ends], y[ends] + size[ends]
    last_a, last_b = _previous(kind_a), _previous(kind_b)
    # What is lacking can't outnumber (100 - percent) / percent of all that the texts share.
    most = int(np.count_nonzero(times_a.astype(bool) & times_b.astype(bool))) * (100 - percent) // percent
    if len(begins) > 16 and most < AHEAD // 2:
        soon = np.zeros(len(x), np.int64)
        for side, (at, lacks, last) in enumerate(((x, lacks_a, last_a), (y, lacks_b, last_b))):
            starts, which = np.unique(at[begins], return_inverse=True)
            most_reach = int((reach[side][begins] - at[begins]).max(initial=least))
            bounds, lacking = _ends_within(lacks, last, starts, most_reach, most, least, percent)
            reach[side][begins] = np.minimum(reach[side][begins], bounds[which])
            soon[begins] += lacking[which]
            begins = begins[(reach[side][begins] - at[begins] >= least) & (soon[begins] <= most)]
    none = len(b) + 1
    place = np.full(n_kinds, none)
    found: list[tuple[int, int, int, int]] = []
    open_a, open_b = np.arange(len(a) + 1), np.arange(len(b) + 1)  # running number of places not covered yet

    def cover(open_: np.ndarray, start: int, end: int) -> None:
        closed = open_[start : end + 1] - open_[start]
        open_[start : end + 1] -= closed
        open_[end + 1 :] -= closed[-1]

    # A place counts one, and one more in the upper half if both sides have its value.
    held_a, held_b = np.where(lacks_a, 1, ONE + 2), np.where(lacks_b, 1, ONE + 2)
    x, y, reach = x[begins], y[begins], (reach[0][begins], reach[1][begins])
    lows, highs = end_x.searchsorted(x + least, side="left"), end_x.searchsorted(reach[0], side="right")
    for i, j, to_i, to_j, low, high in zip(*(v.tolist() for v in (x, y, *reach, lows, highs)), strict=True):
        if open_a[to_i] == open_a[i] and open_b[to_j] == open_b[j]:
            continue
        u, v = end_x[low:high], end_y[low:high]
        fits = (v >= j + least) & (v <= to_j) & ((open_a[u] > open_a[i]) | (open_b[v] > open_b[j]))
        u, v = u[fits], v[fits]
        if not len(u):
            continue
        # Different values from the start up to each place, and those of them that the other side lacks.
        new_a, new_b = last_a[i : u[-1]] < i, last_b[j : v.max()] < j
        sum_a = (new_a * held_a[i : i + len(new_a)]).cumsum()[u - (i + 1)]
        sum_b = (new_b * held_b[j : j + len(new_b)]).cumsum()[v - (j + 1)]
        both, united = np.minimum(sum_a, sum_b) >> 32, (sum_a & ONE) + (sum_b & ONE)
        fits = both * 100 >= (united - both) * percent
        u, v, united = u[fits], v[fits], united[fits]
        if not len(u):
            continue
        # Where each value that both sides have comes first on either side.
        at_a, at_b = i + new_a.nonzero()[0], j + new_b.nonzero()[0]
        place[kind_b[at_b]] = at_b
        pair_a, pair_b = at_a, place[kind_a[at_a]]
        place[kind_b[at_b]] = none
        pair_a, pair_b = pair_a[pair_b < none], pair_b[pair_b < none]

        for by in (u, v):  # what reaches farthest on either side covers the rest
            order = ((open_a[u] > open_a[i]) | (open_b[v] > open_b[j])).nonzero()[0]
            order = order[(-by[order]).argsort(kind="stable")]
            for part in range(1 - TOGETHER, len(order), TOGETHER):  # mostly the first is one
                at = order[max(part, 0) : part + TOGETHER]
                both = ((pair_a < u[at, None]) & (pair_b < v[at, None])).sum(1)
                alike = at[both * 100 >= (united[at] - both) * percent]
                if len(alike):
                    found.append((i, int(u[alike[0]]), j, int(v[alike[0]])))
                    cover(open_a, i, found[-1][1])
                    cover(open_b, j, found[-1][3])
                    break
            else:
                break
    return found


def repeated_passages(
    docs: DataFrame,
    least_words: int = 50,
    width: int = 5,
    percent: int = 80,
    hashes: int = HASHES,
    enough: int = ENOUGH,
) -> DataFrame:
    """doc_id, start_word, n_words, other_id, class_id: documents' passages that another document has too, a row per passage and other one.

    Passages have at least `least_words` words (space-separated, A-Z lower-cased) and
    share `percent` of their united `width`-word shingles. Overlapping passages that two
    documents share come as one row on each side. Where many documents share a passage, each
    is linked with the group's smallest unit or those that share its surroundings, not with all:
    `class_id` is the same for all of them. A document's passages that overlap by `least_words`
    are in one class; that of equal texts as wholes is one of its own.
    Equal texts are represented by their smallest id: each of them, if of that length, repeats
    as a whole and has that id (the smallest has the next one), and the passages that they
    share with others are given for the smallest alone. Null, empty and shorter texts have no
    passages, rows without an id are left out, and rows that repeat with the same id aren't
    another document. Other columns are ignored.
    """
    least = least_words - width + 1
    text = F.col("text").cast("string")
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = texts.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("unit"), text.alias("text"))
    units = written(texts.select("unit", "doc_id"), "passage-units")
    smallest = units.groupBy("unit").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
    smallest = written(smallest, "passage-smallest")
    copied = smallest.where("doc_id < last").select("unit", F.col("doc_id").alias("kept"))
    extra = written(units.join(copied, "unit").where("doc_id <> kept").select("doc_id", "unit").distinct(), "passage-copies")
    once = texts.join(few_or_shuffled(extra), ["doc_id", "unit"], "left_anti")

    made = written(windows(once, least, width, hashes), "passage-made")
    keys = made.groupBy("key").agg(F.min("unit").alias("hub"), F.max("unit").alias("last")).where("hub < last")
    keys = written(keys.select("key", "hub"), "passage-keys")
    met = written(made.join(keys, "key"), "passage-windows")
    first = Window.partitionBy("key").orderBy("c")
    hub = met.where("unit = hub").withColumn("rank", F.row_number().over(first)).where("rank = 1")
    hub = hub.select("key", *(F.col(c).alias(f"hub_{c}") for c in ("first", "c", "end", "left", "right")))
    hub = written(hub, "passage-hubs")  # a table of its own, so that Spark can split the windows of a common key
    # The hub's further places meet its first like any other unit's: theirs may be the surroundings that others share.
    pairs = met.join(hub, "key").where("unit <> hub OR c <> hub_c")
    same = ((F.col("left") != 0) & (F.col("left") == F.col("hub_left"))) | (
        (F.col("right") != 0) & (F.col("right") == F.col("hub_right"))
    )
    places = ["first", "c", "end", "hub_first", "hub_c", "hub_end"]
    odd = (F.expr(f"nullif({s}, hub_{s})").alias(s) for s in ("left", "right"))
    pairs = written(pairs.select("key", "unit", "hub", "j", *places, *odd, same.alias("same")), "passage-pairs")
    # On a side where a window's surroundings aren't the hub's, it meets those with which it shares them.
    odd = pairs.select("key", "unit", "j", _sides().alias("s")).where("s.value <> 0")
    odd = odd.select(F.xxhash64("key", "s.side", "s.value").alias("key"), "unit", "j")
    heads = odd.groupBy("key").agg(F.min("unit").alias("hub"), F.max("unit").alias("last")).where("hub < last").select("key", "hub")
    more = odd.join(heads, "key").where("unit <> hub")
    columns = ["unit", "hub", "j"]
    more = more.select(*columns).union(_same_exactly(met, once, least, width).select("unit", "hub", F.lit(0).cast("byte").alias("j")))
    every = pairs.where("unit <> hub").select(*columns, "same").union(more.select(*columns, F.lit(True).alias("same")))
    meeting = every.groupBy("unit", "hub").agg(
        F.bool_or("same").alias("same"),
        F.bit_count(F.bit_or(F.expr("shiftleft(1, CAST(j AS int))"))).alias("functions"),
    )
    meeting = written(meeting.where(F.col("same") | (F.col("functions") >= enough)).select("unit", "hub", "same"), "passage-meeting")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("windows")
            values, at = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            rows = np.stack([values.field(k).to_numpy(zero_copy_only=False).astype(np.int32) for k in range(7)], axis=1)
            yield batch.filter(pa.array([intersect(rows[x:y], least, enough) for x, y in zip(at[:-1], at[1:], strict=True)], pa.bool_())).select(columns[:2])

    apart = written(meeting.where("NOT same").select("unit", "hub"), "passage-apart")
    apart = pairs.join(few_or_shuffled(apart), ["unit", "hub"], "left_semi")
    apart = apart.groupBy("unit", "hub").agg(F.collect_list(F.struct("j", *places)).alias("windows"))  # as many as a text has at most
    apart = apart.mapInArrow(joined, "unit long, hub long")
    meeting = written(meeting.where("same").select("unit", "hub").union(apart), "passage-verified")

    involved = written(meeting.select("unit").union(meeting.select("hub")).distinct(), "passage-involved")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches):
            words = find_words(data, offsets)
            short = (words.hashes() >> np.uint64(32)).astype(np.uint32)
            cut = [short[x:y].tobytes() for x, y in zip(words.first[:-1], words.first[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"unit": part.column(0), "words": pa.array(cut, pa.binary())})

    spelled = only_ids(once.select("unit", "text"), involved, "unit").mapInArrow(spell, "unit long, words binary")
    spelled = written(spelled.dropDuplicates(["unit"]), "passage-words")
    both = meeting.join(spelled, "unit")
    both = both.join(spelled.select(F.col("unit").alias("hub"), F.col("words").alias("hub_words")), "hub")

    def shingles_of(words: bytes) -> np.ndarray:
        words = np.frombuffer(words, np.uint32).astype(np.uint64)
        return shingle_hashes(words, np.array([0, len(words)]), width)[0]

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, known = [], None  # a hub's pairs mostly lie side by side
            for unit, other, words, hub_words in zip(frame.unit, frame.hub, frame.words, frame.hub_words, strict=True):
                a = shingles_of(words)
                if known != other:
                    known, b = other, shingles_of(hub_words)
                passages = shared_passages(a, b, least, percent)
                left, right = merged([p[:2] for p in passages]), merged([p[2:] for p in passages])
                for x, y in left:
                    facing = {v for v, w in right for p in passages if x <= p[0] < y and v <= p[2] < w}
                    rows.append((unit, x, y + width - 1, other, sorted(facing)))
                rows += [(other, x, y + width - 1, unit, []) for x, y in right]
            yield pd.DataFrame(rows, columns=["unit", "start", "end", "other", "facing"])

    shape = "unit long, start long, end long, other long, facing array<long>"
    found = written(both.select("unit", "hub", "words", "hub_words").mapInPandas(verify, shape), "passage-found")
    classes = _classes(found, least_words)
    named = smallest.select("unit", "doc_id")
    partly = found.join(classes, ["unit", "start"]).join(named, "unit")
    partly = partly.join(named.select(F.col("unit").alias("other"), F.col("doc_id").alias("other_id")), "other")
    partly = partly.select("doc_id", F.col("start").alias("start_word"), (F.col("end") - F.col("start")).alias("n_words"), "other_id", "class_id")
    return partly.union(_whole_copies(texts, smallest, units, least_words))


def _classes(found: DataFrame, least_words: int) -> DataFrame:
    """(unit, start, class_id) of every passage: one for those that overlap by `least_words` in a unit or are linked."""
    spans = found.groupBy("unit", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("unit").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reach", F.max("end").over(before))
    opened = F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach") - least_words), F.col("start"))
    upto = Window.partitionBy("unit").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    nodes = written(spans.select("unit", "start", F.xxhash64("unit", F.max(opened).over(upto)).alias("node")), "passage-nodes")
    links = found.select("unit", "start", "other", F.explode("facing").alias("at")).join(nodes, ["unit", "start"])
    links = links.select(F.col("node").alias("a"), F.col("other").alias("unit"), F.col("at").alias("start")).join(nodes, ["unit", "start"])
    classes = components(links.select("a", F.col("node").alias("b")), "passage-class")
    return nodes.join(classes, "node").select("unit", "start", F.col("component").alias("class_id"))


def _whole_copies(texts: DataFrame, smallest: DataFrame, units: DataFrame, least_words: int) -> DataFrame:
    """Rows for equal texts: the whole text, with the smallest other id."""
    copied = smallest.where("doc_id < last").select("unit", F.col("doc_id").alias("kept"), "last")
    firsts = texts.select("doc_id", "unit", "text").join(copied, "unit").where("doc_id = kept")
    sizes = firsts.groupBy("unit").agg(F.max(n_words(F.col("text"))).alias("n_words")).where(F.col("n_words") >= least_words)
    second = units.join(copied, "unit").where("doc_id <> kept").groupBy("unit").agg(F.min("doc_id").alias("second"))
    known = written(copied.join(sizes, "unit").join(second, "unit"), "passage-wholes")
    other = F.when(F.col("doc_id") == F.col("kept"), F.col("second")).otherwise(F.col("kept"))
    return units.distinct().join(known, "unit").select("doc_id", F.lit(0).cast("long").alias("start_word"), "n_words", other.alias("other_id"), F.xxhash64("unit", F.lit("whole")).alias("class_id"))
