"""Snapshots over time: latest value and growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.instants import MICROS_PER_HOUR
from statflow.operators.merge import fold_batch
from statflow.plans.numbering import with_previous

COUNTERS = ("view_count", "like_count", "comment_count")
SNAPSHOT_ORDER = ("scraped_at", *COUNTERS)


def latest_snapshot(
    snapshots: DataFrame, key: str = "video_id", order: Sequence[str] = SNAPSHOT_ORDER
) -> DataFrame:
    rest = [name for name in snapshots.columns if name != key]
    return fold_batch(snapshots, key, order, last=rest)


def growth(
    snapshots: DataFrame,
    order: Sequence[str] = SNAPSHOT_ORDER,
    partitions: int | None = None,
) -> DataFrame:
    """Change of each counter since the snapshot before, the hours between, and views per hour.

    The first snapshot has nulls; no time between two snapshots gives a null rate.  A counter
    may fall.
    """
    linked = with_previous(snapshots, "video_id", order, ("scraped_at", *COUNTERS), partitions)
    micros = F.unix_micros("scraped_at") - F.unix_micros("prev_scraped_at")
    deltas = {f"{name}_delta": F.col(name) - F.col(f"prev_{name}") for name in COUNTERS}
    timed = linked.withColumns({**deltas, "hours": micros / F.lit(float(MICROS_PER_HOUR))})
    return timed.withColumn(
        "views_per_hour", F.when(F.col("hours") > 0, F.col("view_count_delta") / F.col("hours"))
    ).drop(*(f"prev_{name}" for name in ("scraped_at", *COUNTERS)))
