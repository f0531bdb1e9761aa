"""The current row per channel, kept in the state of the stream itself.

A streaming aggregation holds, for each channel, its last row in the wanted order and its first
arrival.  Spark commits that state with each micro-batch, exactly once, on RocksDB: a trigger writes
what the batch changed, a batch that is delivered again changes nothing, a restart goes on
where the checkpoint ends, and old versions are put together and removed by the state store.  There is
no other table beside it.  ``read_state`` reads the state of the last committed batch through Spark's
state reader, one row per channel, while the stream runs or later.

The state grows with the number of channels, not of snapshots; each belongs to one of the shuffle
partitions that the stream was first started with.  Rows combine before the shuffle, so a busy channel
arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statflow.schemas import CHANNEL_STATS_V1, WIRE
from statflow.session import STREAM_SETTINGS
from statflow.streaming.run import TRIGGER
from statflow.streaming.sinks import Handler

KEY = "channel_id"
# arrival first; the other columns make the order total
ARRIVAL = ("kafka_timestamp", "processed_at", *(n for n in WIRE.names if n != "processed_at"))
# what the first arrival decides; all else is the last row's
FIRST = {"published_at": "published_at", "country": "country", "created_at": "processed_at"}


def fold(rows: DataFrame, newer_only: bool = False) -> DataFrame:
    """``channel_id, last, first``: whole rows.  With ``newer_only`` event time decides which is last, not arrival.

    ``rows`` is a stream or a batch; duplicates are gone (``run.snapshots``), because a snapshot that is
    delivered again would count as a new arrival."""
    order = dict.fromkeys(("processed_at", *ARRIVAL)) if newer_only else ARRIVAL
    keyed = rows.where(F.col(KEY).isNotNull())
    return keyed.groupBy(KEY).agg(F.max(F.struct(*order)).alias("last"), F.min(F.struct(*ARRIVAL)).alias("first"))


def state_columns(last: str, first: str) -> list[Column]:
    """The columns of a channel from its last row and its first arrival."""
    return [
        F.col(f"{first}.{FIRST[f.name]}" if f.name in FIRST else f"{last}.{f.name}").cast(f.dataType).alias(f.name)
        for f in CHANNEL_STATS_V1.fields
    ]


def start_state(
    rows: DataFrame,
    checkpoint: str,
    newer_only: bool = False,
    name: str | None = None,
    trigger: str | None = TRIGGER,
    handler: Handler | None = None,
) -> StreamingQuery:
    """Keeps the current state of the stream ``rows`` in ``checkpoint``; without a trigger it stops once all input is read.

    ``handler`` gets the channels that each micro-batch has changed, at least once."""
    spark = rows.sparkSession
    changed = fold(rows, newer_only).select(*state_columns("last", "first"))
    writer = changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    writer = writer.format("noop") if handler is None else writer.foreachBatch(handler)
    before = {key: spark.conf.get(key, None) for key in STREAM_SETTINGS}
    try:  # a query keeps the settings it was started with
        for key, value in STREAM_SETTINGS.items():
            spark.conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per channel, as of the last committed batch; none before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/state/0/_metadata")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return spark.createDataFrame([], CHANNEL_STATS_V1)
    operators = spark.read.format("state-metadata").load(checkpoint)
    # a line per operator: deduplication, and the aggregation of ``fold``
    mine = operators.where(F.col("operatorName") == "stateStoreSave").select("operatorId").distinct().first()[0]
    state = spark.read.format("statestore").option("operatorId", mine).load(checkpoint)
    return state.select(*state_columns("value.max", "value.min"))
