"""Session helpers: zone, shared folder, and a local session for tests and benches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# for streams whose state outgrows the heap of an executor
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session; cluster jobs bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("statflow")
    settings = {
        **LOCAL_SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **{key.replace("__", "."): value for key, value in extra.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return name_shared_folder(spark)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Read zone-less timestamps as UTC, whatever the session was started with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and intermediate tables.

    It is named in ``spark.checkpoint.dir``.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def name_shared_folder(spark: SparkSession) -> SparkSession:
    """Gives a session whose only executor is its driver a folder of its own, if it has none."""
    context = spark.sparkContext
    in_process = context.master == "local" or context.master.startswith("local[")
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if in_process and named is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="statflow-"))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/statflow-{label}-{uuid.uuid4().hex}"
