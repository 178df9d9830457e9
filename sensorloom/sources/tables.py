"""Raw and model tables as Parquet, partitioned by UTC day."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import is_ntz, moment, shifted, utc_day
from ..schemas import BATCH, DAY, FOLD, KINDS, Kind, stored_schema
from .folds import Fold, current_fold, fold_batches, folders, folds_path, named, read_batches, remove_folder


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def create_raw_tables(spark: SparkSession, base: str) -> None:
    """Declare the raw tables over ``base`` where they do not exist yet.

    Each is a view over two tables, of batches and of what was folded of them; which rows
    it takes from where is in the view alone, so ``compact`` changes both at once.
    """
    for kind in KINDS.values():
        path = table_path(base, kind.table)
        fields = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in kind.schema
        )
        for table, at, own in ((_batches(kind), path, BATCH), (_folds(kind), folds_path(path), FOLD)):
            # An empty append makes the folder of a table nothing was written to yet.
            empty = spark.createDataFrame([], T.StructType([*kind.schema.fields, DAY, own]))
            empty.write.mode("append").partitionBy("day", own.name).parquet(at)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({fields}, day DATE, {own.name} {own.dataType.simpleString()}) "
                f"USING parquet PARTITIONED BY (day, {own.name}) LOCATION '{at}'"
            )
            # Partitions written by a stream since the last call.
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        _declare(spark, kind, current_fold(spark, path))


def _batches(kind: Kind) -> str:
    return f"{kind.table}_batches"


def _folds(kind: Kind) -> str:
    return f"{kind.table}_folds"


def _declare(spark: SparkSession, kind: Kind, fold: Fold) -> None:
    columns = ", ".join(f"`{c}`" for c in [*kind.columns, "day"])
    spark.sql(
        f"CREATE OR REPLACE VIEW {kind.table} AS SELECT {columns}, batch FROM {_batches(kind)} WHERE NOT {fold.condition()} "
        f"UNION ALL SELECT {columns}, CAST(NULL AS STRING) FROM {_folds(kind)} WHERE fold <= {fold.number}"
    )


def drop_raw_tables(spark: SparkSession) -> None:
    """Take back ``create_raw_tables``; files stay."""
    for kind in KINDS.values():
        spark.sql(f"DROP VIEW IF EXISTS {kind.table}")
        for table in (_batches(kind), _folds(kind)):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def _stored(df: DataFrame, kind: Kind, batch: str) -> DataFrame:
    day = utc_day(F.col("timestamp"), is_ntz(df, "timestamp"))
    return df.select(*kind.columns, day.alias("day"), F.lit(batch).alias("batch"))


def _days_in(df: DataFrame) -> set[str]:
    """The distinct days of a frame with a day column: one row per calendar day."""
    return {str(row.day) for row in df.select("day").where("day IS NOT NULL").distinct().toLocalIterator()}


def append_raw(
    df: DataFrame, base: str, kind: Kind, batch: str, rebalance: bool = False, corrected: bool = False
) -> None:
    """Add a batch of readings to a raw table; writing the same batch again replaces it.

    Rows go to ``day=.../batch=...`` from the tasks that hold them. ``rebalance`` is
    for large loads out of time order: it gathers days first, and adaptive
    execution splits the large ones and merges the small ones. Set ``corrected``
    where the batch may have other rows than when it was written before: days it
    no longer touches then lose their old rows too.
    """
    rows = _stored(df, kind, batch)
    if corrected:
        spark, now = df.sparkSession, _days_in(rows)
        for path in folders(spark, f"{table_path(base, kind.table)}/day=*/batch={batch}"):
            if named(path, "day") not in now:
                remove_folder(spark, path)
    if rebalance:
        rows = rows.hint("rebalance", "day")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch")
        .parquet(table_path(base, kind.table))
    )


def append_declared(df: DataFrame, kind: Kind, batch: str) -> None:
    """``append_raw`` through the declared table, so the catalog knows the new partitions.

    Readers of the table then find its days in the catalog, without listing folders.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    # insertInto takes the mode from the session alone.
    spark.conf.set(mode, "dynamic")
    try:
        _stored(df, kind, batch).write.mode("overwrite").insertInto(_batches(kind))
    finally:
        spark.conf.set(mode, before)


def between(
    df: DataFrame, start: Column | datetime | None = None, end: Column | datetime | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Rows with ``start <= ts < end``, with the bounds repeated on ``day``.

    A filter on the timestamp alone reaches the row groups but reads every
    partition; the bound on ``day`` is what skips them.
    """
    ntz = is_ntz(df, ts)
    by_day = "day" in df.columns
    if start is not None:
        start = moment(start, ntz)
        df = df.filter(F.col(ts) >= start)
        df = df.filter(F.col("day") >= utc_day(start, ntz)) if by_day else df
    if end is not None:
        end = moment(end, ntz)
        df = df.filter(F.col(ts) < end)
        # Midnight itself is out of the range, and so is its day.
        last = shifted(end, timedelta(microseconds=-1), ntz)
        df = df.filter(F.col("day") <= utc_day(last, ntz)) if by_day else df
    return df


def read_raw(
    spark: SparkSession, base: str, kind: Kind,
    start: Column | datetime | None = None, end: Column | datetime | None = None,
) -> DataFrame:
    """A raw table, or its readings in ``[start, end)``, with its ``day`` column."""
    stored = read_batches(spark, table_path(base, kind.table), stored_schema(kind))
    return between(stored.drop("batch"), start, end)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Full refresh of a catalog table; returns the saved table.

    Rows are written beside the present ones, then the table's location is set to them:
    who reads meanwhile sees all old rows or all new ones. The files replaced stay until
    the next refresh. A table of other columns is replaced as a whole.
    """
    spark = df.sparkSession
    wanted = [(f.name, f.dataType) for f in df.schema]
    if not spark.catalog.tableExists(name) or [(f.name, f.dataType) for f in spark.table(name).schema] != wanted:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
        return spark.table(name)
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    present = about["Location"]
    earlier = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == REPLACED).head()
    beside = f"{present.partition('__')[0]}__{uuid.uuid4().hex}"
    df.write.parquet(beside)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{beside}'")
    if earlier:
        remove_folder(spark, earlier.value)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{REPLACED}' = '{present}')")
    return spark.table(name)


#: Table property: the files that the last refresh replaced.
REPLACED = "sensorloom.replaced"


def save_view(df: DataFrame, name: str) -> DataFrame:
    """A model that is recomputed on each read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_files(df: DataFrame, base: str, name: str) -> DataFrame:
    """Full refresh of a model kept as files under ``base``; returns the saved model."""
    path = table_path(base, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_days(
    raw: DataFrame, model: Callable[[DataFrame], DataFrame], base: str, name: str,
    start: Column | datetime,
) -> None:
    """Recompute an hourly model from the UTC day of ``start`` on, leaving older days.

    ``raw`` has a ``day`` column. Whole days are read and whole days replaced, so
    the result equals a full refresh as long as older days did not change.
    """
    spark, ntz = raw.sparkSession, is_ntz(raw, "timestamp")
    first = utc_day(moment(start, ntz), ntz)
    write_days(model(raw.filter(F.col("day") >= first)), base, name)
    # Days whose readings are all gone are in no output that could replace them.
    left = _days_in(raw.filter(F.col("day") >= first))
    since = str(spark.range(1).select(first.alias("day")).head().day)
    for path in folders(spark, f"{table_path(base, name)}/day=*"):
        day = named(path, "day")
        if since <= day < "9" and day not in left:
            remove_folder(spark, path)


def write_days(hours: DataFrame, base: str, name: str) -> None:
    """Replace the days of an hourly model that are in ``hours``; few files per day."""
    (
        hours.withColumn("day", utc_day(F.col("hour"), is_ntz(hours, "hour")))
        .hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(table_path(base, name))
    )


#: How compacted readings lie: a sensor's rows are together, and a reader skips files, row groups and pages of others.
CLUSTERED = {"parquet.bloom.filter.enabled#sensor_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def compact(spark: SparkSession, base: str, kind: Kind, before: str, declared: bool = False, **options: str) -> Fold:
    """Fold the batches of all days before ``before`` (yyyy-mm-dd) into a few files per day, in one job.

    The newest batch of a stream may be run again and is left as it is; so are batches
    that no stream wrote. Readers may run meanwhile: they see the same rows before and
    after, see ``folds``. Rows are sorted by sensor and time. ``declared`` does the same
    for the readers of the declared tables. ``options`` are Parquet's.
    """

    def clustered(rows: DataFrame) -> DataFrame:
        order = ["day", "sensor_id", "timestamp"]
        return rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def partitions(paths: list[str], column: str) -> str:
        return ", ".join(f"PARTITION (day = '{named(p, 'day')}', {column} = '{named(p, column)}')" for p in paths)

    def dropped(paths: list[str]) -> None:
        spark.sql(f"ALTER TABLE {_batches(kind)} DROP IF EXISTS {partitions(paths, 'batch')}")

    def visible(fold: Fold) -> None:
        new = folders(spark, f"{folds_path(path)}/day=*/fold={fold.number}")
        if new:
            spark.sql(f"ALTER TABLE {_folds(kind)} ADD IF NOT EXISTS {partitions(new, 'fold').replace(', PARTITION', ' PARTITION')}")
        _declare(spark, kind, fold)

    path = table_path(base, kind.table)
    return fold_batches(
        spark, path, stored_schema(kind), before, visible=visible if declared else None,
        dropped=dropped if declared else None, write=clustered, **(CLUSTERED | options),
    )
