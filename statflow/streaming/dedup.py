"""Duplicates in a stream of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, EVENT_TIME = "channel_id", "processed_at"
DELAY = "10 minutes"


def with_event_time(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """A watermark on the event time.

    Rows without an event time are never late and would stay in the state for ever, so they
    must not get here; a zone-less column is read in the session zone.
    """
    if not isinstance(df.schema[EVENT_TIME].dataType, T.TimestampType):
        df = df.withColumn(EVENT_TIME, F.col(EVENT_TIME).cast("timestamp"))
    return df.where(F.col(EVENT_TIME).isNotNull()).withWatermark(EVENT_TIME, delay)


def redelivered(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """Drops a snapshot that is delivered again; every distinct snapshot passes.

    The default.  State is bounded by the watermark and spread over key and time, so one busy
    channel does not load one task.
    """
    return with_event_time(df, delay).dropDuplicates([KEY, EVENT_TIME])


def within_watermark(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row per channel until its state is evicted.  Loses some distinct snapshots."""
    return with_event_time(df, delay).dropDuplicatesWithinWatermark([KEY])


def first_ever(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """The first snapshot of each channel, and never another one; the state only grows."""
    return with_event_time(df, delay).dropDuplicates([KEY])


MODES = {
    "redelivered": redelivered,
    "within_watermark": within_watermark,
    "first_ever": first_ever,
}


def deduplicate(df: DataFrame, mode: str = "redelivered", delay: str = DELAY) -> DataFrame:
    return MODES[mode](df, delay)
