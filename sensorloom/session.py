"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SESSION_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"

SETTINGS = {
    # Readings are UTC instants; hours and days below are UTC hours and days.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state off the heap, and sessions merged in each task before their shuffle.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A micro-batch writes what it changed, not whole snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    SESSION_MERGE: "true",
    # Group limits below rankings also for the newest n > 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.ui.enabled": "false",
}


def spark_session(app: str = "sensorloom", **settings: str) -> SparkSession:
    """A session with this library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder all executors can reach, for stream checkpoints and tables.

    Lies under the folder the session names in ``spark.checkpoint.dir``. A local
    session may go without that setting and then uses its warehouse folder. All
    folders of a session are deleted when its JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/sensorloom/{context.applicationId}")
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # only a folder that exists is remembered for deletion
    files.deleteOnExit(folder)
    return f"{folder.toString()}/{label}-{uuid.uuid4().hex}"
