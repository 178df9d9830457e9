"""Rows kept up to date batch by batch, in versions of hash buckets.

A micro-batch reads and rewrites the buckets its keys fall into; the others stay as they
are. It writes a new version beside the old one, so a batch run again starts from the same
rows, and readers see a version only when its batch is marked as done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folds import folders, remove_folder

BUCKETS = 64


def _newest(spark: SparkSession, path: str, upto: int) -> dict[int, list[int]]:
    """Versions of each bucket up to a batch, oldest first; read from folder names."""
    found: dict[int, list[int]] = {}
    for folder in folders(spark, f"{path}/rows/bucket=*/version=*"):
        bucket, version = (int(part.partition("=")[2]) for part in folder.split("/")[-2:])
        if version <= upto:
            found.setdefault(bucket, []).append(version)
    return {bucket: sorted(versions) for bucket, versions in found.items()}


def kept_rows(spark: SparkSession, path: str, schema, upto: int, buckets: list[int] | None = None) -> DataFrame:
    """The rows as of a batch, of all buckets or of some."""
    chosen = [
        f"{path}/rows/bucket={bucket}/version={versions[-1]}"
        for bucket, versions in _newest(spark, path, upto).items()
        if buckets is None or bucket in buckets
    ]
    return spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)


def keep(
    rows: DataFrame, key: str, path: str, number: int, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """Merge a micro-batch into the kept rows: ``merge`` gets kept and new rows of the touched buckets."""
    spark = rows.sparkSession
    own = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    touched = [row.bucket for row in rows.select(own.alias("bucket")).distinct().collect()]
    if touched:
        merged = merge(kept_rows(spark, path, rows.schema, number - 1, touched).unionByName(rows))
        (
            merged.withColumns({"bucket": own, "version": F.lit(number)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "version")
            .parquet(f"{path}/rows")
        )
    _mark(spark, path, number)
    # A version may go when a newer one was readable before this batch.
    for bucket, versions in _newest(spark, path, number - 1).items():
        for version in versions[:-1]:
            remove_folder(spark, f"{path}/rows/bucket={bucket}/version={version}")


def _mark(spark: SparkSession, path: str, number: int) -> None:
    mark = spark.range(1).select(F.lit(number).cast("long").alias("batch"))
    mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/done{number % 2}")


def last_done(spark: SparkSession, path: str) -> int:
    """The last finished micro-batch. Marks may be under replacement, the other one is not."""
    marks = spark.read.option("ignoreMissingFiles", "true").schema("batch bigint")
    return marks.parquet(f"{path}/done*").agg(F.max("batch")).head()[0]
