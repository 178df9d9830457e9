"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken floor(r) times for certain, r = target / size of the
source, and once more with probability r - floor(r). Which ones is drawn so that the
source's totals of words and of documents come out as expected: probabilities move along
the null space of those two constraints until each is 0 or 1 (flight), at most two per
group staying in between. Groups are hashed slices of a source of bounded size; what they
leave is grouped anew and flies on, until one group per source remains, whose last two
land by giving up the document total first and then the word total. Where a landing
misses the words by much, as with one very long document left, the last group is drawn
anew and the nearest draw taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import few_or_shuffled, fresh, n_words, numbered, written

#: Rows of a source that one task flies over, about.
GROUP_ROWS = 8192
WEIGHTS = (3, 1, 2)
POOL = 64  # units that move together
#: Landings are drawn anew, so often at most, while words are off by over this share of the source's target.
LANDINGS, OFF = 32, 0.002
_EDGE = 1e-9


def source_targets(sizes: DataFrame, total: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """source, source_size, target of (source, size) rows; a null source is one of its own.

    Sources in code-point order, null last, weigh 3, 1, 2, repeating. Together they get
    `total` times all sizes by weight; none gets more than `repeats` times its own size,
    and what it can't take is shared by weight among the others. That is the level l with
    target = min(cap, l * weight) and targets summing to the total: with sources ordered
    by cap / weight, l follows from running sums. The windows hold one row per source.
    """
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    stats = stats.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn.cast("int") + 1).cast("double"))
    stats = stats.withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(float(total)) - before) / left
    stats = stats.withColumn("level", level)
    # Up to the first source that isn't capped, levels are above caps; from there on that one's level holds.
    stats = stats.withColumn("place", F.row_number().over(order))
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    target = F.least("cap", F.coalesce(F.min(free).over(everything)["level"], F.col("level")) * F.col("weight"))
    return stats.select("source", "source_size", target.alias("target"))


def _move(p: np.ndarray, at: np.ndarray, u: np.ndarray, draw: float) -> np.ndarray:
    """Move p[at] along u or against it until one reaches 0 or 1; expectations stay. What is still between."""
    q = p[at]
    with np.errstate(divide="ignore", invalid="ignore"):
        ahead = np.where(u > 0, (1 - q) / u, np.where(u < 0, q / -u, np.inf)).min()
        back = np.where(u > 0, q / u, np.where(u < 0, (1 - q) / -u, np.inf)).min()
    q = np.clip(q + (ahead if draw * (ahead + back) < back else -back) * u, 0, 1)
    live = (q > _EDGE) & (q < 1 - _EDGE)
    p[at] = np.where(live, q, np.round(q))
    return at[live]


def fly(x: np.ndarray, p: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Probabilities after the flight, keeping sum(p) and sum(p * x); 0 or 1 but for two at most.

    Units come in the given order into a pool; in it the one of the largest x is moved and
    the others make up for it, by the projection of its direction onto the null space of
    both constraints. land: settle the last two as well.
    """
    p = p.copy()
    waiting = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    settled = np.setdiff1d(np.arange(len(p)), waiting)
    p[settled] = np.round(p[settled])
    live, next_ = waiting[:POOL], POOL
    while len(live) >= 2:
        size = x[live] / max(x[live].max(), 1.0)
        away = size - size.mean()
        spread = float(away @ away)
        pull = away / spread if spread > 1e-18 else np.zeros(len(live))
        free = 1 - 1 / len(live) - away * pull > _EDGE
        if not free.any():
            break
        i = int(np.argmax(np.where(free, size, -1.0)))
        u = -1 / len(live) - away[i] * pull
        u[i] += 1
        live = _move(p, live, u, rng.random())
        if len(live) < POOL and next_ < len(waiting):
            more = waiting[next_ : next_ + POOL - len(live)]
            next_ += len(more)
            live = np.concatenate((live, more))
    if land and len(live) == 2 and x[live].max() > 0:
        live = _move(p, live, np.array([x[live[1]], -x[live[0]]]) / x[live].max(), rng.random())  # words only
    if land:
        p[live] = rng.random(len(live)) < p[live]
    return p


def mix(docs: DataFrame, total: float = 1.5, repeats: float = 2.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, times, source (and `keep`) of every row of docs.

    size: words of the text, null none. times: how often the mix takes the document;
    taken: size * times. Wordless documents count toward the document total only. Equal
    sources, ids and repeated rows are separate units; a null source is one source. The
    draw depends on ids and sizes alone, so reruns agree. An empty table gives no rows.
    """
    units = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"), *keep,
    )
    units = written(units, "mix-units")
    targets = written(source_targets(units, total, repeats), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    same = F.col("u.source").eqNullSafe(F.col("t.source"))
    flying = units.alias("u").join(targets.alias("t"), same).select("u.*", "t.source_size", "t.target", rate.alias("rate"))
    flying = flying.withColumn("times", F.floor("rate").cast("double")).withColumn("p", F.col("rate") - F.floor("rate")).drop("rate")
    schema, done, turn = flying.schema, [], 0
    while True:
        open_rows = F.col("p").between(_EDGE, 1 - _EDGE)
        done.append(flying.where(~open_rows))
        active = flying.where(open_rows)
        most = active.groupBy("source").count().agg(F.max("count")).first()[0]
        if not most:
            break
        groups = -(-most // GROUP_ROWS)
        flying = written(_flight(active, groups, turn, schema), f"mix-flight{turn}")
        turn += 1
    every = done[0]
    for part in done[1:]:
        every = every.union(part)
    times = (F.col("times") + F.round("p")).cast("long")
    return every.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times"), "source", *keep
    )


def mixed(docs: DataFrame, total: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """docs as the mix takes them: each row as often as its own draw says, whatever its id."""
    rows, key = numbered(docs, "mix-rows")
    turns = F.sequence(F.lit(1), F.col("times")).alias(fresh(rows, "_turns"))
    taken = mix(rows.select("doc_id", "source", "text", key), total, repeats, keep=(key,)).where("times > 0").select(key, turns)
    whole = rows.join(few_or_shuffled(written(taken, "mix-taken")), key)
    return whole.select(*docs.columns, F.explode(whole.columns[-1]).alias(fresh(whole, "_turn"))).select(docs.columns)


def _flight(active: DataFrame, groups: int, turn: int, schema) -> DataFrame:
    names = schema.fieldNames()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # Long documents are settled first, so that what is left to land are short ones.
        seed = int(frame.draw.min()) & 0x7FFFFFFF
        frame = frame.sort_values(["size", "draw", "doc_id"], ascending=False, kind="stable").reset_index(drop=True)
        x, p = frame["size"].to_numpy(float), frame["p"].to_numpy(float)
        best = None
        for attempt in range(LANDINGS if groups == 1 else 1):
            q = fly(x, p, np.random.default_rng([turn, seed, attempt]), land=groups == 1)
            off = abs(float((q - p) @ x))
            if best is None or off < best[0]:
                best = (off, q)
            if off <= OFF * frame.target.iloc[0]:
                break
        frame["p"] = best[1]
        return frame[names]

    draw = F.xxhash64(F.lit(turn), "doc_id", "size")
    split = active.withColumn("draw", draw).withColumn("slice", F.pmod("draw", F.lit(groups)))
    return split.groupBy("source", "slice").applyInPandas(run, schema)
