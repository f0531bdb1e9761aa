"""The measurement queue: seeds, due rows and their order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.instants import instant
from statflow.functions.text import clean_key, playlist_key
from statflow.schemas import BATCH_SIZE
from statflow.plans.numbering import number_rows

DUE_ORDER = ("next_poll_at", "video_id")


def active_seeds(channel_stats: DataFrame) -> DataFrame:
    """Channels with an uploads list; a list id of blanks counts as one."""
    listed = F.col("uploads_playlist_id").isNotNull() & (F.col("uploads_playlist_id") != "")
    return channel_stats.where(listed).select("channel_id", "uploads_playlist_id")


def ordered_seeds(channel_stats: DataFrame) -> DataFrame:
    return active_seeds(channel_stats).orderBy("channel_id")


def clean_seeds(seeds: DataFrame) -> DataFrame:
    """Keys without outer white space and within length, list ids without their address."""
    return seeds.withColumns(
        {
            "channel_id": clean_key(F.col("channel_id")),
            "uploads_playlist_id": playlist_key(F.col("uploads_playlist_id")),
        }
    )


def due_videos(queue: DataFrame, as_of: datetime | str, only_active: bool = False) -> DataFrame:
    """Rows whose time has come, of any status unless told otherwise."""
    due = queue.where(F.col("next_poll_at") <= instant(as_of))
    return due.where(F.col("status") == "active") if only_active else due


def chunk_due(
    due: DataFrame, size: int = BATCH_SIZE, partitions: int | None = None
) -> DataFrame:
    """Due rows in queue order, cut into request batches.

    ``batch_no`` counts from 0, ``pos_in_batch`` from 1.  Only the last batch is short.
    """
    slim = due.select(*DUE_ORDER, "published_at")
    numbered = number_rows(slim, DUE_ORDER, "__n", partitions)
    return numbered.select(
        "video_id",
        "published_at",
        "next_poll_at",
        F.expr(f"__n div {size}").alias("batch_no"),
        (F.col("__n") % size + 1).alias("pos_in_batch"),
    )


def in_key_order(df: DataFrame, key: str = "video_id") -> DataFrame:
    """Rows sorted by key inside each partition, for writers that lock rows."""
    return df.sortWithinPartitions(key)
