"""Tables of many small batches, folded into few files while they are read.

A table has a folder per batch (``batch=stream-number``, below ``day=`` where it has days).
Folding gathers the batches of a stream that can't be run again into folders of a second
table beside it. Which batches these are, and up to which fold they are read there, is one
pointer; readers take what the pointer names from the folds and the rest from the batches.
A fold is written first and becomes visible when its pointer does, whole and at once. What
it replaced is deleted by the next fold, so a read under way ends on what it began with.

Pointers are small files named by number, put in place by a rename; the highest counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hadoop(spark: SparkSession, path: str):
    """Hadoop's view of a folder: its file system and its path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def folders_changed(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Folders that match a pattern and when they changed; a listing of names, no data is read."""
    files, at = hadoop(spark, pattern)
    found = [status for status in files.globStatus(at) or [] if status.isDirectory()]
    return sorted((status.getPath().toString(), status.getModificationTime()) for status in found)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    return [path for path, _ in folders_changed(spark, pattern)]


def remove_folder(spark: SparkSession, path: str) -> None:
    files, at = hadoop(spark, path)
    files.delete(at, True)


def named(path: str, column: str) -> str:
    return path.rpartition(f"{column}=")[2].partition("/")[0]


@dataclass(frozen=True)
class Fold:
    """Batches up to a number per stream, of days before ``before`` (all days if empty), are in folds up to ``number``."""

    number: int = 0
    before: str = ""
    upto: dict[str, int] = field(default_factory=dict)

    def holds(self, batch: str, day: str = "") -> bool:
        stream, _, number = batch.rpartition("-")
        return self.upto.get(stream, -1) >= int(number if number.isdigit() else "0") >= 0 and number.isdigit() and self._by_day(day)

    def _by_day(self, day: str) -> bool:
        return not self.before or (day[:1].isdigit() and day < self.before)

    def condition(self) -> str:
        """SQL on the partition columns: the batch is read from the folds."""
        streams = [
            f"(batch LIKE '{stream}-%' AND substring_index(batch, '-', -1) RLIKE '^[0-9]+$'"
            f" AND CAST(substring_index(batch, '-', -1) AS BIGINT) <= {number}"
            f" AND length(batch) = {len(stream) + 1} + length(substring_index(batch, '-', -1)))"
            for stream, number in sorted(self.upto.items())
        ]
        by_day = f" AND day < DATE '{self.before}'" if self.before else ""
        return f"coalesce(({' OR '.join(streams) or 'false'}){by_day}, false)"


def folds_path(path: str) -> str:
    return f"{path}_folds"


def _pointers(spark: SparkSession, path: str) -> list[str]:
    files, at = hadoop(spark, f"{folds_path(path)}/_pointers/[0-9]*")
    return sorted(status.getPath().toString() for status in files.globStatus(at) or [])


def current_fold(spark: SparkSession, path: str) -> Fold:
    found = _pointers(spark, path)
    if not found:
        return Fold()
    files, at = hadoop(spark, found[-1])
    stream = files.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Fold(**json.loads(text))


def _point(spark: SparkSession, path: str, fold: Fold) -> None:
    folder = f"{folds_path(path)}/_pointers"
    files, aside = hadoop(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(aside)
    out.write(bytearray(json.dumps({"number": fold.number, "before": fold.before, "upto": fold.upto}).encode()))
    out.close()
    if not files.rename(aside, hadoop(spark, f"{folder}/{fold.number:012d}")[1]):
        raise RuntimeError(f"another fold of {path} is running")


def batch_columns(by_day: bool) -> list[str]:
    return ["day", "batch"] if by_day else ["batch"]


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of batches, folded or not; ``schema`` ends with its partition columns, ``batch`` NULL in folds."""
    fold = current_fold(spark, path)
    rows = spark.read.schema(schema).parquet(path)
    if not fold.number:
        return rows
    inner = T.StructType([*[f for f in schema if f.name != "batch"], T.StructField("fold", T.IntegerType())])
    folded = spark.read.schema(inner).parquet(folds_path(path)).where(F.col("fold") <= fold.number)
    folded = folded.withColumn("batch", F.lit(None).cast("string")).select(schema.fieldNames())
    return rows.where(f"NOT {fold.condition()}").unionByName(folded)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, days: list[str], needed: Callable[[str, int], bool] | None = None
) -> DataFrame | None:
    """``read_batches`` of some days (yyyy-mm-dd): no other day's folders are listed or read; None without any.

    ``needed`` may leave out folders of batches, by path and time of change (milliseconds).
    """
    fold, rows = current_fold(spark, path), None
    for root, column in ((path, "batch"), (folds_path(path), "fold")):
        found = [f for day in days for f in folders_changed(spark, f"{root}/day={day}/{column}=*")]
        if column == "batch":
            kept = [f for f, at in found if not fold.holds(named(f, "batch"), named(f, "day")) and (not needed or needed(f, at))]
        else:
            kept = [f for f, _ in found if int(named(f, "fold")) <= fold.number]
        if kept:
            inner = T.StructType([*[f for f in schema if f.name != "batch"], T.StructField(column, T.StringType())])
            own = spark.read.schema(inner).option("basePath", root).parquet(*kept)
            own = own if column == "batch" else own.withColumn("batch", F.lit(None).cast("string"))
            own = own.select(schema.fieldNames())
            rows = own if rows is None else rows.unionByName(own)
    return rows


def _next(old: Fold, batches: list[tuple[str, str]], before: str) -> Fold:
    """What can be folded: of each stream all but its newest batch, which may be run again."""
    newest: dict[str, int] = {}
    for _, batch in batches:
        stream, _, number = batch.rpartition("-")
        if number.isdigit():
            newest[stream] = max(newest.get(stream, -1), int(number))
    upto = {s: n - 1 for s, n in newest.items() if n > 0}
    merged = {s: max(n, old.upto.get(s, -1)) for s, n in {**old.upto, **upto}.items()}
    return Fold(old.number + 1, max(before, old.before) if before else "", merged)


def fold_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: str = "",
    merge: Callable[[DataFrame], DataFrame] | None = None, visible: Callable[[Fold], None] | None = None,
    dropped: Callable[[list[str]], None] | None = None, write: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> Fold:
    """Fold the finished batches of a table, of days before ``before`` (yyyy-mm-dd) if given; one job for all.

    ``merge`` makes fewer rows of the batches' rows, ``write`` arranges them before they are
    written. ``dropped`` is told the folders of batches before they go, ``visible`` the new
    fold, besides the pointer. A fold that breaks off has no effect; the next one replaces it.
    """
    by_day = "day" in schema.fieldNames()
    old = current_fold(spark, path)
    if old.before and not before and by_day:
        raise ValueError("this table was folded by days before")
    found = [(f, named(f, "day") if by_day else "", named(f, "batch")) for f in folders(spark, f"{path}/{'day=*/' if by_day else ''}batch=*")]
    # What the last fold replaced goes now; nobody reads it any more.
    gone = [f for f, day, batch in found if old.holds(batch, day)]
    if gone and dropped:
        dropped(gone)
    for folder in gone:
        remove_folder(spark, folder)
    found = [(f, day, batch) for f, day, batch in found if not old.holds(batch, day)]
    new = _next(old, [(day, batch) for _, day, batch in found], before)
    chosen = [f for f, day, batch in found if new.holds(batch, day)]
    if not chosen:
        return old
    rows = spark.read.schema(schema).option("basePath", path).parquet(*chosen).drop("batch")
    rows = merge(rows) if merge else rows
    rows = rows.withColumn("fold", F.lit(new.number))
    rows = write(rows) if write else rows.hint("rebalance", *(["day"] if by_day else []))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
    # An earlier attempt may have left folders of this number.
    for left in folders(spark, f"{folds_path(path)}/{'day=*/' if by_day else ''}fold={new.number}"):
        remove_folder(spark, left)
    writer.partitionBy(*(["day"] if by_day else []), "fold").parquet(folds_path(path))
    _point(spark, path, new)
    if visible:
        visible(new)
    return new
