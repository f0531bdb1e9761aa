"""Late rows of the snapshot stream, kept as rows instead of as a number.

A stateful operator drops a row whose event time is not after the watermark, and only reports how many
it dropped.  Here the stream carries each message twice: once through the operator, and once beside it as a
candidate.  Both branches belong to one query with one watermark.  When a micro-batch is handled, the bound
that the operator used is known, and ``split`` keeps just those candidates that it dropped.  All of it is one
frame, so the batch is evaluated and written once; ``on_time`` and ``late`` divide it when it is read.

A late row says by how much it was late.  It may be a snapshot that was stored long ago and is delivered
again; ``lost`` leaves those out, and gives each other snapshot once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.operators.enrich import with_engagement
from statflow.operators.parse import parse_checked, usable
from statflow.streaming.dedup import DELAY, EVENT_TIME, KEY, deduplicate, with_event_time
from statflow.streaming.sinks import Handler

CANDIDATE = "late_candidate"
LATE_MS = "late_ms"
ORDER = ("kafka_timestamp", "total_views")


def snapshots_with_candidates(raw: DataFrame, mode: str = "redelivered", delay: str = DELAY) -> DataFrame:
    """As ``run.snapshots``, and beside those rows all usable messages as candidates for late rows."""
    messages = usable(parse_checked(raw))
    kept = deduplicate(messages, mode, delay).withColumn(CANDIDATE, F.lit(False))
    every = with_event_time(messages, delay).withColumn(CANDIDATE, F.lit(True))
    return with_engagement(kept.unionByName(every))


def late_bound(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds since 1970, by which a batch decides what is late.

    It is the one that the batch before ran with, as noted in the offsets of the checkpoint, so a batch that
    is delivered again after a restart gets the same; 0 for the first batch.
    """
    if batch_id == 0:
        return 0
    noted = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id - 1}", wholetext=True).first()
    # fixed format: a line with the version, one with the settings of the batch, one per source
    return int(json.loads(noted[0].splitlines()[1])["batchWatermarkMs"])


def split(batch: DataFrame, batch_id: int, checkpoint: str) -> DataFrame:
    """Rows on time with a null ``late_ms``, and late rows with their distance to the watermark."""
    bound = late_bound(batch.sparkSession, checkpoint, batch_id)
    late = F.col(EVENT_TIME) <= F.timestamp_millis(F.lit(bound))
    by = F.lit(bound) - F.unix_millis(F.col(EVENT_TIME))
    return batch.where(~F.col(CANDIDATE) | late).withColumn(LATE_MS, F.when(F.col(CANDIDATE), by)).drop(CANDIDATE)


def keeping_late(handler: Handler, checkpoint: str) -> Handler:
    """A handler of ``snapshots_with_candidates`` that hands on rows with ``late_ms``."""
    return lambda batch, batch_id: handler(split(batch, batch_id, checkpoint), batch_id)


def on_time(stored: DataFrame) -> DataFrame:
    return stored.where(F.col(LATE_MS).isNull()).drop(LATE_MS)


def late(stored: DataFrame) -> DataFrame:
    return stored.where(F.col(LATE_MS).isNotNull())


def lost(stored: DataFrame) -> DataFrame:
    """Snapshots that came only late, each once: its first arrival, with ``late_ms`` of that one.

    One grouping by key and event time: rows combine before the shuffle, and there is no join.
    """
    arrival = F.struct(*ORDER, *(name for name in stored.columns if name not in (*ORDER, KEY, EVENT_TIME)))
    seen = stored.groupBy(KEY, EVENT_TIME).agg(
        F.count_if(F.col(LATE_MS).isNull()).alias("__stored"), F.min(arrival).alias("__first")
    )
    rows = seen.where(F.col("__stored") == 0).select(KEY, EVENT_TIME, "__first.*")
    return rows.select(*stored.columns)
