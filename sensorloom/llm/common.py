"""Written tables, size-checked broadcasts, and components of a link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import scratch_dir

#: Rows of a key column that may be broadcast after they have been counted (about 16 bytes each).
BROADCAST_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the session's shared folder: later steps read it and never recompute it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df hasn't."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def numbered(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """df as a written table with a key per row, which tells apart rows that share everything else; the key's name."""
    name = fresh(df, "_row")
    return written(df.withColumn(name, F.monotonically_increasing_id()), label), name


def n_words(text: Column) -> Column:
    """Words of a text: runs of anything but space and 0x09-0x0D. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key is in ids (written, distinct)."""
    return df.join(few_or_shuffled(ids), key, "left_semi").select(df.columns)


def few_or_shuffled(df: DataFrame) -> DataFrame:
    """df (written, narrow) to be joined: broadcast if its rows, counted, are few; else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key isn't in ids (written, distinct); null keys stay."""
    return df.join(few_or_shuffled(ids), key, "left_anti").select(df.columns)


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) of every node in links (a, b): the smallest node reachable.

    Each round sends every node to its smallest neighbour and that one's, then keeps
    only links between different targets, so a component at least halves per round.
    Neighbours are only ever reduced by minimum; a node with a third of all links is
    summed up in each task first. Null ends are ignored.
    """
    spark = links.sparkSession
    links = links.select("a", "b").where("a <> b")
    links = written(links.union(links.select("b", "a")).distinct(), f"{label}-links")
    maps: list[DataFrame] = []
    while not links.isEmpty():
        parent = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        parent = written(parent.select("node", F.least("node", "b").alias("to")), f"{label}-parent")
        up = parent.select(F.col("node").alias("to"), F.col("to").alias("top"))
        step = written(parent.join(up, "to").select("node", F.col("top").alias("to")), f"{label}-step")
        a, b = (step.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        moved = links.where("a < b").join(a, "a").join(b, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        climbing = step.join(step.select(F.col("node").alias("to"), F.col("to").alias("top")), "to")
        moved = moved.union(climbing.select(F.col("to").alias("a"), F.col("top").alias("b"))).where("a <> b")
        links = written(moved.union(moved.select("b", "a")).distinct(), f"{label}-links")
        maps.append(step)
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    found = maps[0].withColumnRenamed("to", "component")
    for step in maps[1:]:
        onward = step.select(F.col("node").alias("component"), "to")
        found = found.join(onward, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return found
