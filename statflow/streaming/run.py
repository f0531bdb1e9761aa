"""Wiring of the snapshot stream.  Batch runs use the same transforms."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from statflow.operators.enrich import with_engagement
from statflow.operators.parse import parse_checked, usable
from statflow.streaming.dedup import DELAY, deduplicate
from statflow.streaming.sinks import Handler

TRIGGER = "30 seconds"


def snapshots(raw: DataFrame, mode: str = "redelivered", delay: str = DELAY) -> DataFrame:
    """Messages to distinct, enriched snapshots.  ``raw`` is a batch or a stream.

    Unusable messages are left out (``parse.rejected`` keeps them); duplicates go before the
    ratios are computed.
    """
    return with_engagement(deduplicate(usable(parse_checked(raw)), mode, delay))


def start(
    df: DataFrame,
    handler: Handler,
    checkpoint: str,
    name: str | None = None,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Runs the stream into ``handler``; without a trigger it stops once all input is read.

    ``checkpoint`` must outlive the container, on a file system that all nodes share.
    """
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = (
        writer.trigger(availableNow=True)
        if trigger is None
        else writer.trigger(processingTime=trigger)
    )
    return writer.foreachBatch(handler).start()


def state_rows(progress: Iterable[Any]) -> int:
    """Rows the stateful operators hold, by the last report."""
    last = list(progress)[-1]
    return sum(op["numRowsTotal"] for op in last["stateOperators"])


def late_rows(progress: Iterable[Any]) -> int:
    """Rows that stateful operators dropped as too late, over the given reports."""
    return sum(
        op["numRowsDroppedByWatermark"] for report in progress for op in report["stateOperators"]
    )
