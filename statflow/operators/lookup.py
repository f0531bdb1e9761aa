"""Lookup chain channel -> uploads list -> video ids -> details, and request batching."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import chain, groupby, islice
from typing import Any, Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from statflow.operators.skew import heavy_keys, join_unique
from statflow.schemas import BATCH_SIZE


def first_per_key(
    df: DataFrame, key: str, order: Sequence[str | Column], limit: int = BATCH_SIZE
) -> DataFrame:
    """The first ``limit`` rows of each key.

    The rank filter becomes a group limit on both sides of the shuffle, so a task passes on
    at most ``limit`` rows of a key however many it reads.
    """
    window = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") <= limit).drop("__rank")


def latest_videos(videos: DataFrame, limit: int = BATCH_SIZE) -> DataFrame:
    order = [F.col("published_at").desc_nulls_last(), F.col("video_id")]
    return first_per_key(videos, "channel_id", order, limit)


def lookup_chain(
    ids: DataFrame,
    channels: DataFrame,
    uploads: DataFrame,
    details: DataFrame,
    per_channel: int = BATCH_SIZE,
) -> DataFrame:
    """Details of the first page of uploads of each requested channel.

    ``ids(channel_id, ...)``; ``channels(channel_id, uploads_playlist_id)``;
    ``uploads(uploads_playlist_id, position, video_id)``; ``details(video_id, ...)``.
    A channel asked for twice is looked up twice; keys without a match fall out.
    """
    asked = ids.join(channels, "channel_id")
    page = first_page(uploads, asked, per_channel)
    return asked.join(page, "uploads_playlist_id").join(details, "video_id")


def first_page(uploads: DataFrame, asked: DataFrame, limit: int = BATCH_SIZE) -> DataFrame:
    """The first ``limit`` uploads of the lists in ``asked``; other lists are not ranked.

    A long list is dealt over many tasks, each of which passes on at most ``limit`` of its rows."""
    key = "uploads_playlist_id"
    lists = asked.select(key).distinct()
    wanted = join_unique(uploads, key, lists, key, "left_semi", heavy_keys(uploads, key))
    return first_per_key(wanted, "uploads_playlist_id", ["position", "video_id"], limit)


def dropped_keys(
    ids: DataFrame,
    channels: DataFrame,
    uploads: DataFrame,
    details: DataFrame,
    per_channel: int = BATCH_SIZE,
) -> DataFrame:
    """What ``lookup_chain`` leaves out, and at which step."""
    asked = ids.select("channel_id")
    found = asked.join(channels, "channel_id")
    page = first_page(uploads, found, per_channel)
    steps = [
        asked.join(channels, "channel_id", "left_anti").select(
            F.lit("channel_not_found").alias("reason"), "channel_id", F.lit(None).alias("video_id")
        ),
        found.join(page, "uploads_playlist_id", "left_anti").select(
            F.lit("no_uploads").alias("reason"), "channel_id", F.lit(None).alias("video_id")
        ),
        found.join(page, "uploads_playlist_id")
        .join(details.select("video_id"), "video_id", "left_anti")
        .select(F.lit("no_details").alias("reason"), "channel_id", "video_id"),
    ]
    return reduce(DataFrame.unionByName, steps)


class RequestError(Exception):
    """A request that fails however often it is repeated."""


class TransientError(RequestError):
    """A request that may succeed when repeated."""


class QuotaExhausted(Exception):
    """No key is left; further requests of this task are pointless."""


class Client(Protocol):
    def fetch(self, keys: list[str]) -> list[dict[str, Any]]:
        """Details for at most one batch of keys; keys without details are left out."""


# Attempts per batch, and bounds on the doubling pause in seconds
ATTEMPTS = 5
PAUSE_FROM, PAUSE_TO = 4.0, 60.0
# answers handed back to Spark at a time
_ROWS_PER_ARROW_BATCH = 5_000


def pause_after(attempt: int) -> float:
    """Seconds to wait after a failed attempt, counted from 1."""
    return min(max(2.0 ** (attempt - 1), PAUSE_FROM), PAUSE_TO)


def _fetch_with_retry(
    client: Client, keys: list[str], sleep: Callable[[float], None]
) -> list[dict[str, Any]]:
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return client.fetch(keys)
        except TransientError:
            if attempt == ATTEMPTS:
                raise
            sleep(pause_after(attempt))
    raise AssertionError("unreachable")


def enrich_batches(
    df: DataFrame,
    key: str,
    client_factory: Callable[[], Client],
    result: T.StructType,
    batch: int = BATCH_SIZE,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Details for each key from an outside service, ``batch`` keys per request.

    One client per partition, whose last request may be short.  A batch that is refused or keeps failing is
    skipped: its keys come back with ``ok`` false and the error.  Keys the service does not know give no row.
    """

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
        keys = chain.from_iterable(b.column(0).to_pylist() for b in batches)
        while chunk := list(islice(keys, batch)):
            yield chunk

    return _asked(df.select(F.col(key).cast("string")), key, requests, client_factory, result, sleep)


def enrich_chunks(
    chunks: DataFrame,
    key: str,
    client_factory: Callable[[], Client],
    result: T.StructType,
    senders: int | None = None,
    number: str = "batch_no",
    place: str = "pos_in_batch",
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Details for numbered chunks (``queue.chunk_due``), one request for each, in their order.

    The number of a chunk names its task, so every chunk is sent whole, by one of ``senders`` tasks with a
    client each, and every task begins with its earliest chunk: if keys run out, what is left unasked is
    what was due last.  Refused and unknown keys are as in ``enrich_batches``.  A task that Spark
    repeats asks again for its chunks.
    """
    senders = senders or int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = F.pmod(F.col(number), F.lit(senders)).cast("int")
    dealt = chunks.repartitionById(senders, task).sortWithinPartitions(number, place)

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
        rows = chain.from_iterable(zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
        for _, chunk in groupby(rows, key=lambda row: row[1]):
            yield [name for name, _ in chunk]

    return _asked(dealt.select(F.col(key).cast("string"), number), key, requests, client_factory, result, sleep)


def _asked(
    df: DataFrame,
    key: str,
    requests: Callable[[Iterator[pa.RecordBatch]], Iterator[list[str]]],
    client_factory: Callable[[], Client],
    result: T.StructType,
    sleep: Callable[[float], None],
) -> DataFrame:
    fields = [T.StructField(key, T.StringType()), *(f for f in result.fields if f.name != key)]
    out = T.StructType(
        [*fields, T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())]
    )
    arrow = to_arrow_schema(out)

    def failed(keys: list[str], error: str) -> list[dict[str, Any]]:
        return [{key: k, "ok": False, "error": error} for k in keys]

    def answers(chunks: Iterator[list[str]]) -> Iterator[list[dict[str, Any]]]:
        client: Client | None = None
        spent: str | None = None
        for chunk in chunks:
            client = client or client_factory()
            if spent is not None:
                yield failed(chunk, spent)
                continue
            try:
                found = _fetch_with_retry(client, chunk, sleep)
                yield [{**row, "ok": True, "error": None} for row in found]
            except RequestError as error:  # also one that was repeated in vain
                yield failed(chunk, str(error))
            except QuotaExhausted as error:
                spent = str(error)
                yield failed(chunk, spent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict[str, Any]] = []
        for answer in answers(requests(batches)):
            rows += answer
            if len(rows) >= _ROWS_PER_ARROW_BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    # sent with the task, so that executors need no copy of this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        return df.mapInArrow(run, out)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
