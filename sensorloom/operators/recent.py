"""The newest rows of each key, without collecting a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Slices a key is cut in for the first ranking. A hot key's rows then meet in
# this many tasks, and the second ranking sees at most SLICES * n of them.
SLICES = 64


def _top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def last_n(df: DataFrame, key: str, order: Sequence[Column], n: int, slices: int = SLICES) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, exactly.

    Ranked twice: per (key, slice of input tasks), then per key. The newest n of
    a key are among the newest n of each slice, whatever the slices are. Spark
    plans both filters as group limits, so each task drops all but n rows per
    key before its shuffle; for n over 1000 this takes ``spark_session()``'s settings.
    """
    sliced = df.withColumn("_slice", F.spark_partition_id() % slices)
    candidates = _top(sliced, [key, "_slice"], order, n).drop("_slice")
    return _top(candidates, [key], order, n)


def in_last_days(df: DataFrame, key: str, n: int, day: str = "day") -> DataFrame:
    """Keep only the days that can hold the newest ``n`` rows of some key.

    For tables partitioned by day. Rows are counted per (key, day), a scan of the
    key column alone, and a key needs a day while fewer than n of its rows are
    newer. Exact for silent keys as well: their old days stay needed. The needed
    days prune the second scan; there is at most one row per calendar day of the
    table, and the planner decides from its size how to join it.
    """
    counts = df.groupBy(key, day).agg(F.count("*").alias("_rows"))
    newer = W.partitionBy(key).orderBy(F.desc(day)).rowsBetween(W.unboundedPreceding, -1)
    needed = counts.withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0))).filter(
        F.col("_newer") < n
    )
    return df.join(needed.select(day).distinct(), day, "left_semi")
