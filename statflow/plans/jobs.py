"""The batch flows, as plain functions a scheduler may call.

Each takes the run instant and returns counts.  The stream is in ``statflow.streaming``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions.instants import instant
from statflow.operators import enrich, lookup, merge, parse, quality, queue
from statflow.plans.publish import VersionedTable
from statflow.schemas import DEFAULT_CATEGORY, VIDEO_TRENDS, VIEW_TIMESERIES
from statflow.session import shared_folder
from statflow.sinks.metrics import write_counted
from statflow.sinks.series import append_series, append_trends, read_series, run_name
from statflow.sinks.tables import overwrite_table
from statflow.sources.tables import Database, Split, read_table


def refresh_channels(
    items: DataFrame, table: VersionedTable, as_of: datetime | str, order: Sequence[str]
) -> dict[str, int]:
    """Channel objects into the channel table.

    ``items`` carries, next to the API objects, the ``order`` columns that say which came
    first.  Rows that cannot be stored are left out and counted.
    """
    flat = parse.flatten_channels(items, as_of, *order).drop(parse.BAD_FIELDS)
    typed = parse.typed_times(flat, "published_at", "processed_at")
    stamped = typed.withColumns(
        {
            "created_at": instant(as_of),
            # only the seed load fills these
            "title": F.lit(None).cast("string"),
            "tier_category": F.lit(None).cast("string"),
            "uploads_playlist_id": F.lit(None).cast("string"),
        }
    )
    checked = quality.check_rows(stamped, quality.row_rules("channel_stats")).persist()
    try:
        counts = _clean_and_bad(checked)
        if counts["affected"]:
            batch = quality.clean(checked)
            table.update(batch, lambda rows: merge.upsert_channels(rows, batch, as_of, order))
        return counts
    finally:
        checked.unpersist()


def publish_channels(
    items: DataFrame, as_of: datetime | str, write: Callable[[DataFrame], None]
) -> int:
    """Channel objects as keyed messages; returns how many were handed to ``write``.

    ``write`` gets columns ``key`` and ``value``, as ``messages.send`` takes them.
    """
    flat = parse.readable(parse.flatten_channels(items, as_of))
    return write_counted(parse.wire_frame(flat), write)


def _clean_and_bad(checked: DataFrame) -> dict[str, int]:
    bad = F.size(quality.VIOLATED) > 0
    row = checked.agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad")).first()
    return {"affected": row.good, "quarantined": row.bad}


def enrich_channels(
    spark: SparkSession,
    database: Database,
    source: str,
    target: str,
    split: Split | None = None,
) -> None:
    """Batch enrichment from one database table into another."""
    if source == target:
        raise ValueError("the enriched table must have a name of its own")
    channels = read_table(spark, database, source, split)
    overwrite_table(enrich.with_engagement(channels), database, target)


def ingest_uploads(
    channel_stats: DataFrame,
    uploads: DataFrame,
    table: VersionedTable,
    as_of: datetime | str,
    per_channel: int = 5,
) -> dict[str, int]:
    """Latest uploads of the seeded channels into the queue.

    ``uploads(uploads_playlist_id, position, video_id, published_at)``.  Videos of a channel
    that the channel table lacks are quarantined.
    """
    seeds = queue.clean_seeds(queue.active_seeds(channel_stats))
    page = lookup.first_page(uploads, seeds, per_channel)
    found = seeds.join(page, "uploads_playlist_id").select(
        "channel_id", "position", "video_id", "published_at"
    )
    candidates = found.withColumns(
        {"status": F.lit("active"), "current_interval_hours": F.lit(1), "created_at": instant(as_of)}
    )
    checked = quality.with_all_violations(
        candidates, "videos", parent=("channel_id", channel_stats, "channel_id")
    ).persist()
    try:
        counts = _clean_and_bad(checked)
        if counts["affected"]:
            batch = quality.clean(checked).select(
                "video_id", "channel_id", "published_at", "position"
            )
            order = ("channel_id", "position", "published_at")
            table.update(batch, lambda rows: merge.upsert_queue(rows, batch, as_of, order))
        return counts
    finally:
        checked.unpersist()


def in_chunks(
    client_factory: Callable[[], lookup.Client], size: int = lookup.BATCH_SIZE, senders: int | None = None
) -> Callable[[DataFrame], DataFrame]:
    """A ``measure`` for ``collect_snapshots``: due videos in queue order, ``size`` of them in each request.

    The order is that of the whole queue, so only the very last request is short.  Videos whose request
    failed have no answer and stay due."""
    counters = T.StructType([f for f in VIEW_TIMESERIES.fields if f.name not in ("video_id", "scraped_at")])

    def measure(due: DataFrame) -> DataFrame:
        chunks = queue.chunk_due(due, size)
        return lookup.enrich_chunks(chunks, "video_id", client_factory, counters, senders).where("ok")

    return measure


def collect_snapshots(
    table: VersionedTable,
    measure: Callable[[DataFrame], DataFrame],
    series_path: str,
    as_of: datetime | str,
    only_active: bool = False,
) -> int:
    """Measures the due videos, stores the snapshots, and sets the next poll times.

    ``measure`` takes the due rows (video id, publication and poll time; see ``in_chunks``) and returns video id and counters of those it could read.
    Its answers are landed as they come, below a name that belongs to the series and the run.
    A run that is repeated asks only for what has no answer yet, writes the series of the run
    from all answers, those of earlier attempts included, and moves the videos in it: nothing is
    asked for twice, no snapshot is lost or doubled, and a video that was not measured stays due.
    The queue is updated as it is then; what other jobs wrote meanwhile stays.  Returns the number
    of snapshots that the run has stored.
    """
    waiting = table.read()
    spark = waiting.sparkSession
    landing = _Landing(spark, series_path, as_of)
    earlier = read_series(spark, series_path, VIEW_TIMESERIES, as_of).select(*VIEW_TIMESERIES.names)
    if not landing.attempts() and not earlier.isEmpty():
        landing.add(earlier)  # the run ended well before; its folder is going to be replaced
    due = queue.due_videos(waiting, as_of, only_active).select("video_id", "published_at", "next_poll_at")
    known = landing.answers()
    asked = due.join(known.select("video_id").distinct(), "video_id", "left_anti")
    counters = (F.col(name).cast("bigint").alias(name) for name in VIEW_TIMESERIES.names[2:])
    landing.add(measure(asked).select("video_id", instant(as_of).alias("scraped_at"), *counters))
    answers = landing.answers()
    stored = append_series(answers, series_path, as_of) if not answers.isEmpty() else 0
    if stored:
        written = read_series(spark, series_path, VIEW_TIMESERIES, as_of).select("video_id").distinct()

        def moved(rows: DataFrame) -> DataFrame:
            # as it is now: another job may have made a video due again, or known
            measured = queue.due_videos(rows, as_of, only_active).select("video_id", "published_at")
            return merge.apply_cadence(rows, measured.join(written, "video_id", "left_semi"), as_of)

        # those that are due as the table is now: a repeated run has moved its videos before
        still = queue.due_videos(table.read(), as_of, only_active)
        table.update(still.join(written, "video_id", "left_semi"), moved)
    landing.remove()
    return stored


class _Landing:
    """Answers of one run, a folder per attempt; an attempt counts once it is complete."""

    def __init__(self, spark: SparkSession, series_path: str, as_of: datetime | str) -> None:
        name = hashlib.sha256(series_path.rstrip("/").encode()).hexdigest()[:24]
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/statflow-measured-{name}-{run_name(as_of)}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(self.root).getFileSystem(conf)

    def attempts(self) -> list[str]:
        if not self._fs.exists(self._path(self.root)):
            return []
        found = [status.getPath().toString() for status in self._fs.listStatus(self._path(self.root))]
        return sorted(path for path in found if self._fs.exists(self._path(f"{path}/_SUCCESS")))

    def add(self, answers: DataFrame) -> None:
        answers.write.parquet(f"{self.root}/{uuid.uuid4().hex}")

    def answers(self) -> DataFrame:
        attempts = self.attempts()
        if not attempts:
            return self.spark.createDataFrame([], VIEW_TIMESERIES)
        return self.spark.read.schema(VIEW_TIMESERIES).parquet(*attempts)

    def remove(self) -> None:
        self._fs.delete(self._path(self.root), True)


def collect_trends(
    ids: DataFrame,
    channels: DataFrame,
    uploads: DataFrame,
    items: DataFrame,
    path: str,
    as_of: datetime | str,
    category: str = DEFAULT_CATEGORY,
) -> dict[str, object]:
    """Details of the latest uploads of the given channels as new trend rows.

    Only items that are asked for are flattened and checked.
    """
    asked = ids.select("channel_id").join(channels.select("channel_id", "uploads_playlist_id"), "channel_id")
    page = lookup.first_page(uploads.select("uploads_playlist_id", "position", "video_id"), asked)
    wanted = asked.join(page, "uploads_playlist_id")
    named = wanted.select(F.col("video_id").alias("id")).distinct()
    details = parse.flatten_videos(items.join(named, "id", "left_semi"), as_of, category)
    checked = quality.check_rows(details, quality.row_rules("video_trends"))
    rows = wanted.join(quality.clean(parse.readable(checked)), "video_id")
    return append_trends(rows.select(*VIDEO_TRENDS.names), path, as_of)
