"""Sharding along a Hilbert curve over source, language and size, for file pruning.

Each dimension is quantised to 32 steps of near-equal row counts, sources and languages by
their whole values and sizes by 16 codes per doubling. The cells of the
resulting cube are ordered along a three-dimensional Hilbert curve, rows follow their
cells, and the order is cut into runs. Everything is DataFrame expressions.

No window spans all rows: places come from a histogram of cells (32,768 at most), then of
hashed slices within a cell, then of rows within a slice. A cell with a third of all rows
is 4,096 slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import few_or_shuffled, numbered, written

BITS = 5
SLICES = 4096
DIMENSIONS = ("source", "lang", "size")

# Fixed values of the 3-d curve: per octant in Gray order, the octant's place, the corner
# where its part of the curve begins and the axis along which it runs.
PLACE = (0, 1, 3, 2, 7, 6, 4, 5)
CORNER = (0, 0, 0, 3, 3, 6, 6, 5)
AXIS = (0, 1, 1, 2, 2, 1, 1, 0)


def hilbert_index(x: Column, y: Column, z: Column, bits: int = BITS) -> Column:
    """The place along the curve of a cell with integer coordinates below 2**bits.

    From the highest bit down: the octant is turned into the current frame, looked up,
    and the frame is turned on for the next level.
    """

    def pick(values: tuple[int, ...], at: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))

    def turned(value: Column, by: Column, left: bool) -> Column:
        there, back = ("shiftleft", "shiftright") if left else ("shiftright", "shiftleft")
        one, other = F.call_function(there, value, by), F.call_function(back, value, 3 - by)
        return one.bitwiseOR(other).bitwiseAND(F.lit(7))

    def level(state: Column, bit: Column) -> Column:
        def at(c: Column, up: int) -> Column:
            return F.shiftleft(F.call_function("shiftright", c, bit).bitwiseAND(F.lit(1)), up)

        octant = at(z, 2).bitwiseOR(at(y, 1)).bitwiseOR(at(x, 0))
        by = state["axis"] + 1
        place = pick(PLACE, turned(octant.bitwiseXOR(state["corner"]), by, left=False))
        return F.struct(
            F.shiftleft(state["place"], 3).bitwiseOR(place).alias("place"),
            state["corner"].bitwiseXOR(turned(pick(CORNER, place), by, left=True)).alias("corner"),
            F.pmod(state["axis"] + pick(AXIS, place) + 1, F.lit(3)).cast("int").alias("axis"),
        )

    start = F.struct(F.lit(0).alias("place"), F.lit(0).alias("corner"), F.lit(0).alias("axis"))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, level, lambda state: state["place"])


def _size_code(size: Column) -> Column:
    """The number of bits and the four leading bits of a size from 16 on: 16 steps per doubling."""
    bits = F.length(F.bin(size))
    return (bits * 16 + F.call_function("shiftright", size, bits - 4).cast("int")).cast("int")


def placed(docs: DataFrame, shards: int = 40, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, the three steps, the curve's cell, shard and slot of every row.

    Shard sizes in rows are at most one apart (law `rows`); slots count from 0 along the
    curve. size: UTF-8 bytes of the text plus 16; a null text has none and the checksum of
    no bytes, 0. Null sources, languages and ids come first in their order. Equal rows
    are all placed; which of them comes first makes no difference. Columns named in `keep`
    come along, others are ignored.
    """
    text = F.col("text").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")
    slim = docs.select(
        F.col("doc_id").cast("long"), size.alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        *(F.col(c).cast("string").alias(f"{c}_code") for c in ("source", "lang")), *keep,
    )
    slim = written(slim.withColumn("size_code", _size_code(F.col("size"))), "shard-rows")

    # Steps of near-equal counts per dimension; the window has a row per different value.
    rows = slim
    for d in DIMENSIONS:
        code = f"{d}_code"
        counts = written(slim.groupBy(code).agg(F.count("*").alias("rows")), f"shard-{d}")
        before = F.sum("rows").over(Window.orderBy(code)) - F.col("rows")
        step = F.floor(before * (1 << BITS) / F.col("all")).cast("int")
        of = counts.crossJoin(F.broadcast(counts.agg(F.sum("rows").alias("all"))))
        of = written(of.select(F.col(code).alias("code"), step.alias(f"{d}_step")), "shard-steps")
        rows = rows.join(few_or_shuffled(of), F.col(code).eqNullSafe(F.col("code"))).drop(code, "code")
    cell = F.col("source_step") * (1 << 2 * BITS) + F.col("lang_step") * (1 << BITS) + F.col("size_step")
    piece = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLICES)).cast("int")
    rows = rows.withColumn("cell", cell).withColumn("slice", piece)

    slices = written(rows.groupBy("cell", "slice").agg(F.count("*").alias("rows")), "shard-slices")
    part = lambda at: F.call_function("shiftright", F.col("cell"), F.lit(at * BITS)).bitwiseAND(F.lit((1 << BITS) - 1))
    cells = slices.groupBy("cell").agg(F.sum("rows").alias("rows"))
    cells = cells.withColumn("curve", hilbert_index(part(2), part(1), part(0)))
    along = Window.orderBy("curve")  # one row per cell
    cells = cells.select(
        "cell", "curve", (F.sum("rows").over(along) - F.col("rows")).alias("cell_start"),
        F.sum("rows").over(Window.partitionBy()).alias("all"),
    )
    inside = Window.partitionBy("cell").orderBy("slice")
    starts = slices.withColumn("slice_start", F.sum("rows").over(inside) - F.col("rows")).drop("rows")
    starts = starts.join(F.broadcast(cells), "cell")
    starts = starts.select("cell", "slice", "curve", "all", (F.col("cell_start") + F.col("slice_start")).alias("start"))
    own = Window.partitionBy("cell", "slice").orderBy("doc_id", "text_crc32", "size")
    found = rows.join(starts, ["cell", "slice"]).withColumn("place", F.col("start") + F.row_number().over(own) - 1)
    found = found.withColumn("shard", F.expr(f"CAST(place * {shards} DIV `all` AS int)"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"place - (CAST(shard AS bigint) * `all` + {shards - 1}) DIV {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source_step", "lang_step", "size_step", "curve", *keep,
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """docs as Parquet, a folder per shard with its rows in curve order, so readers prune by source, language or size.

    Every row is written once, rows without an id and repeated ones too. Columns of docs named
    shard or slot are replaced.
    """
    rows, key = numbered(docs.drop("shard", "slot"), "shard-texts")
    order = placed(rows.select("doc_id", "source", "lang", "text", key), shards, keep=(key,)).select(key, "shard", "slot")
    whole = rows.join(order, key).drop(key).repartitionByRange(shards * 4, "shard", "slot")
    whole.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
