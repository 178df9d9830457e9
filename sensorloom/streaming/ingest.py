"""Continuous ingest of the topics into the raw tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import utc_day
from ..schemas import KINDS, Kind, stored_schema
from ..session import SETTINGS
from ..sources.folds import fold_batches, folders, named, read_batches, read_days
from ..sources.tables import append_declared, append_raw, table_path
from ..sources.topics import TOPICS, decode, readings, rejects

QUARANTINE, COUNTS = "quarantine", "message_counts"
KEY = ["sensor_id", "timestamp"]
CONFLICT = "conflicting_values"  # a reading of a sensor and time that came before with other values
QUERY_ID = "sql.streaming.queryId"

_STORE = "spark.sql.streaming.stateStore"
#: How the state of seen readings is kept, where the session doesn't say: off the heap, which it outgrows.
STATE = {name: value for name, value in SETTINGS.items() if name.startswith(_STORE)} | {
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",  # costs a look-up per row
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}


class BadMessage(ValueError):
    """Raised in ``on_bad="fail"`` mode."""


def start(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    """Start a stream: on a processing-time trigger, or over what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def query_id(batch: DataFrame) -> str:
    """Identity of the running stream; it belongs to the checkpoint and outlives restarts.

    Batch numbers start again with a new checkpoint. Without the identity a batch
    could replace one of an earlier stream, so there is no default for it.
    """
    found = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if not found:
        raise RuntimeError(f"{QUERY_ID} is not set: call this in a foreachBatch function")
    return found


def with_first_arrivals(decoded: DataFrame, within: str) -> DataFrame:
    """A stream of decoded messages, and with column ``_what`` what its state knows of them.

    ``all`` has every message; ``key`` has the sensors and times that are new, ``reading`` the
    messages that are new with their values. Spark's state of seen keys covers what arrived in
    the last ``within`` of arrival time, so a reading may be as old as it likes. Messages are
    decoded and shuffled once, and one state holds keys and readings. Rows without ``_what`` and
    columns with ``_`` are for the receiver to leave out: Spark would do it before the shuffle,
    which then isn't the same for both sides, and decode twice.
    """
    good = F.col("problem").isNull()
    # 0: a message that is no reading, else twice the place of its topic from 1 on: its key, and one more: its values.
    place = reduce(lambda other, n: F.when(F.col("topic") == TOPICS[n], 2 * n + 2).otherwise(other), range(len(TOPICS)), F.lit(None))
    parts = F.when(good, F.array(place, place + 1)).otherwise(F.array(F.lit(0)))
    # The watermark stands between: Spark would put the decoding into each place that uses its columns.
    came = decoded.withColumn("_at", F.current_timestamp()).withWatermark("_at", within)
    came = came.withColumn("_values", _values(decoded)).withColumn("_part", F.explode(parts))
    is_bad, is_key = F.col("_part") == 0, (F.col("_part") > 0) & (F.col("_part") % 2 == 0)
    # Messages that are no readings have a few keys of their own, so that they are spread and the state doesn't grow by them.
    values = F.when(is_bad, _anywhere()).when(is_key, F.lit(0)).otherwise(F.col("_values"))
    narrow = {c: F.when(~is_key, F.col(c)) for c in decoded.columns if c not in ("topic", "problem", *KEY)}
    narrow |= {c: F.when(~is_bad, F.col(c)) for c in KEY}
    # Four columns: Spark keeps the order of no more, and would shuffle again.
    key = ["_part", *KEY, "_values"]
    spread = came.withColumns({**narrow, "_values": values}).repartition(*key)
    every = F.when(~is_key, "all")
    new = F.when(is_key, "key").when(~is_bad, "reading")
    tagged = [rows.select(what.alias("_what"), *spread.columns) for what, rows in ((every, spread), (new, spread.dropDuplicatesWithinWatermark(key)))]
    return reduce(DataFrame.unionByName, tagged)


def _rest(decoded: DataFrame) -> list[str]:
    """What readings of one sensor and time can differ in."""
    return [c for c in decoded.columns if c[0] != "_" and c not in ("topic", "value", "problem", *KEY)]


def _values(decoded: DataFrame) -> Column:
    """A hash of a reading's values; it passes over nulls, so these are hashed too."""
    return F.xxhash64(*[x for c in _rest(decoded) for x in (F.col(c), F.col(c).isNull())])


def _all_new(decoded: DataFrame) -> DataFrame:
    """A batch of its own as ``with_first_arrivals`` gives it: nothing was seen before."""
    good, key = decoded.where("problem IS NULL"), ["topic", *KEY]
    found = {
        "all": decoded, "key": good.select(*key).distinct(),
        "reading": good.withColumn("_values", _values(decoded)).dropDuplicates([*key, "_values"]).drop("_values"),
    }
    tagged = [rows.withColumn("_what", F.lit(what)) for what, rows in found.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def one_per_key(seen: DataFrame) -> DataFrame:
    """The messages that are no readings, and of the new readings one per sensor and time; others of it have the problem CONFLICT.

    The accepted one is the least by value, if none came in an earlier micro-batch: the
    same whenever a batch is run again.
    """
    bad = F.col("problem").isNotNull()
    # A new key comes before its readings, which differ; the next one is accepted.
    in_order = W.partitionBy("topic", *KEY, "_apart").orderBy("_what", *_rest(seen))
    ranked = seen.where(bad | (F.col("_what") != "all")).withColumn("_apart", F.when(bad, _anywhere()))
    ranked = ranked.withColumn("_before", F.lag("_what").over(in_order))
    problem = F.when(~F.col("_before").eqNullSafe("key"), F.lit(CONFLICT))
    ranked = ranked.where("_what <> 'key'").withColumn("problem", F.coalesce("problem", problem))
    return ranked.select([c for c in seen.columns if c[0] != "_"])


def _anywhere() -> Column:
    """Spreads messages that have no key and may all be alike."""
    return F.pmod(F.pmod(F.xxhash64("value"), F.lit(1024)) + F.spark_partition_id(), F.lit(1024))


def against_stored(
    rows: DataFrame, base: str, kind: Kind, batch: str, days: list[str], since: float | None
) -> tuple[DataFrame, DataFrame | None]:
    """Readings of some days that no batch outside the stream's state has stored, and those it has with other values.

    ``since``: what this stream wrote from then on (milliseconds of the epoch) is in its
    state. If the days of the readings have no other batches, nothing is read.
    """
    spark, path = rows.sparkSession, table_path(base, kind.table)
    stream = batch.rpartition("-")[0]

    def needed(folder: str, changed: int) -> bool:
        name = named(folder, "batch")
        in_state = name.rpartition("-")[0] == stream and since is not None and changed >= since
        return name != batch and not in_state

    stored = read_days(spark, path, stored_schema(kind), days, needed)
    if stored is None:
        return rows, None
    rest = [c for c in kind.columns if c not in KEY]
    stored = stored.select(*KEY, *[F.col(c).alias(f"_{c}") for c in rest])
    known = stored.groupBy(*KEY).agg(F.collect_set(F.struct(*[f"_{c}" for c in rest])).alias("_stored"))
    found = rows.join(known, KEY, "left")
    same = F.exists("_stored", lambda s: reduce(Column.__and__, [F.col(c).eqNullSafe(s[f"_{c}"]) for c in rest]))
    other = found.where(F.col("_stored").isNotNull() & ~same).drop("_stored")
    return found.where(F.col("_stored").isNull()).drop("_stored"), other


def write_batch(
    decoded: DataFrame, base: str, batch: str, on_bad: str = "quarantine", declared: bool = False,
    dedupe: bool = False, since: float | None = None,
) -> None:
    """Route one micro-batch to the three raw tables and the quarantine, and count its messages.

    Each target keeps the rows in partitions named after the batch, so a batch run
    again after a failure replaces what it wrote before. Without ``dedupe`` there is
    no shuffle: tasks write what they read. With it, a decoded batch may come from
    ``with_first_arrivals``; ``since`` is when its state begins.
    """
    if dedupe:
        decoded = decoded if "_what" in decoded.columns else _all_new(decoded)
        decoded = decoded.where("_what IS NOT NULL").drop("_at", "_part", "_values")
    # What several jobs read is kept: the state isn't gone through again for each.
    decoded = decoded.persist()
    new = one_per_key(decoded).persist() if dedupe else decoded
    try:
        every = decoded.where("_what = 'all'") if dedupe else decoded
        if on_bad == "fail":
            first = rejects(every).head()
            if first is not None:
                raise BadMessage(f"{first.problem} on {first.topic}: {first.value}")
        bad = rejects(new)  # not joined with those of every message: Spark finds one side of such a union only among what is kept
        good = {kind.table: readings(new, kind) for kind in KINDS.values()}
        if dedupe:
            day = utc_day(F.col("timestamp")).alias("day")
            days = new.where("problem IS NULL").select("topic", day).distinct().collect()
            for kind in KINDS.values():
                own = new.where((F.col("topic") == kind.topic) & F.col("problem").isNull())
                touched = [str(r.day) for r in days if r.topic == kind.topic]
                fresh, other = against_stored(own, base, kind, batch, touched, since)
                good[kind.table] = fresh.select(*kind.columns)
                if other is not None:
                    bad = bad.unionByName(other.select("topic", "value", F.lit(CONFLICT).alias("problem")))
        counts = every.groupBy("topic", "problem").agg(F.count("*").alias("messages")).coalesce(1)
        writes = [partial(_write_batch_of, counts, base, COUNTS, batch), partial(_write_batch_of, bad, base, QUARANTINE, batch)]
        for kind in KINDS.values():
            if declared:  # goes through a setting of the session
                append_declared(good[kind.table], kind, batch)
            else:
                writes.append(partial(append_raw, good[kind.table], base, kind, batch))
        # The first write decodes; the others find it done and are short.
        writes[0]()
        with ThreadPoolExecutor(len(writes)) as pool:
            for written in [pool.submit(inheritable_thread_target(decoded.sparkSession)(write)) for write in writes[1:]]:
                written.result()
    finally:
        new.unpersist()
        decoded.unpersist()


def _write_batch_of(rows: DataFrame, base: str, table: str, batch: str) -> None:
    (
        rows.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(table_path(base, table))
    )


def ingest(
    messages: DataFrame, base: str, checkpoint: str, every: str | None = None,
    on_bad: str = "quarantine", dedupe: bool = False, declared: bool = False, within: str = "1 day",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run the ingest: a stream of ``topic, value`` into raw tables under ``base``.

    The checkpoint keeps the position in the topics. ``on_bad="fail"`` stops at the
    first micro-batch with a bad message instead of putting it in quarantine.
    ``dedupe`` stores a reading (sensor, time) once however often it is sent; one with
    other values than the first goes to quarantine. What arrived in the last ``within`` is
    known from the stream's state; for older batches, and those of other streams, the days
    that a micro-batch falls on are compared with what is stored. The state is kept in
    ``state_partitions`` (by default ``spark.sql.shuffle.partitions``), which a checkpoint
    keeps for good: each costs every micro-batch a commit, however little it brings.
    ``declared`` writes through the tables ``create_raw_tables`` declared over ``base``.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"on_bad: {on_bad}")
    decoded = decode(messages)

    def each(batch: DataFrame, number: int) -> None:
        since = None
        if dedupe:
            horizon = F.expr(f"unix_millis(current_timestamp() - INTERVAL {within})")
            since = batch.sparkSession.range(1).select(horizon).head()[0]
        write_batch(batch, base, f"{query_id(batch)}-{number}", on_bad, declared, dedupe, since)

    if not dedupe:
        return start(decoded.writeStream.foreachBatch(each), checkpoint, every)
    stream, conf = with_first_arrivals(decoded, within), messages.sparkSession.conf
    own = {name: value for name, value in STATE.items() if conf.get(name, None) is None}
    if state_partitions:
        own["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {name: conf.get(name, None) for name in own}
    # A query takes the settings of its session as they are when it starts.
    for name, value in own.items():
        conf.set(name, value)
    try:
        return start(stream.writeStream.foreachBatch(each), checkpoint, every)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def rows_read(spark: SparkSession, base: str) -> int:
    """Messages read so far, good and bad, over all micro-batches that wrote under ``base``."""
    if not folders(spark, f"{table_path(base, COUNTS)}/batch=*"):
        return 0
    return _kept(spark, base, COUNTS).agg(F.sum("messages")).head()[0] or 0


def _kept(spark: SparkSession, base: str, table: str) -> DataFrame:
    path = table_path(base, table)
    return read_batches(spark, path, spark.read.parquet(path).schema).drop("batch")


def read_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """The messages that were no readings: ``topic, value, problem``."""
    return _kept(spark, base, QUARANTINE)


def compact_messages(spark: SparkSession, base: str) -> None:
    """Fold the batches of the quarantine and of the message counts; readers may run meanwhile."""

    def added_up(counts: DataFrame) -> DataFrame:
        return counts.groupBy("topic", "problem").agg(F.sum("messages").alias("messages"))

    for table, merge in ((QUARANTINE, None), (COUNTS, added_up)):
        path = table_path(base, table)
        if folders(spark, f"{path}/batch=*"):
            fold_batches(spark, path, spark.read.parquet(path).schema, merge=merge)
