"""Keyed merges under per-column policies.

The order of the rows inside a batch is an explicit total order, so that results do
not depend on how Spark partitions the batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions.instants import hours_later, instant, poll_interval_hours
from statflow.schemas import FIRST_POLL_HOURS

_TARGET, _SOURCE = "__in_target", "__in_source"


@dataclass(frozen=True)
class Policy:
    """What a merge does to each column.

    ``first``: taken from the first row of the batch, on insert only.
    ``last``: taken from the last row of the batch, on insert and update, nulls included.
    ``on_insert`` / ``on_update``: constants.  Any other target column is kept.
    """

    key: str
    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    on_insert: Mapping[str, Any] = field(default_factory=dict)
    on_update: Mapping[str, Any] = field(default_factory=dict)


def fold_batch(
    batch: DataFrame,
    key: str,
    order: Sequence[str],
    first: Sequence[str] = (),
    last: Sequence[str] = (),
    last_order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: ``last`` columns of the last row, ``first`` columns of the first.

    Each side travels as one struct, so the columns of a row stay together and a null in
    the winning row survives.  Both aggregates combine before the shuffle.  ``last_order``
    replaces ``order`` for the ``last`` side.
    """
    sides: list[Column] = []
    if last:
        place = F.struct(*(last_order or order))
        sides.append(F.max_by(F.struct(*last), place).alias("__last"))
    if first:
        sides.append(F.min_by(F.struct(*first), F.struct(*order)).alias("__first"))
    folded = batch.groupBy(key).agg(*sides)
    return folded.select(
        key,
        *(F.col(f"__last.{name}").alias(name) for name in last),
        *(F.col(f"__first.{name}").alias(name) for name in first),
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    policy: Policy,
    order: Sequence[str],
    newer_by: str | None = None,
) -> DataFrame:
    """Target after the batch.  With ``newer_by`` an older row does not update a newer one.

    Rows without a key are not stored, so that a repeated batch changes nothing; the callers
    set them aside before, as rows that break the primary key.
    """
    last_order = (newer_by, *order) if newer_by is not None else order
    keyed = batch.where(F.col(policy.key).isNotNull())
    folded = fold_batch(keyed, policy.key, order, policy.first, policy.last, last_order)
    left = target.withColumn(_TARGET, F.lit(True)).alias("t")
    right = folded.withColumn(_SOURCE, F.lit(True)).alias("s")
    joined = left.join(right, F.col(f"t.{policy.key}") == F.col(f"s.{policy.key}"), "full_outer")

    known, seen = F.col(f"t.{_TARGET}").isNotNull(), F.col(f"s.{_SOURCE}").isNotNull()
    update = known & seen
    if newer_by is not None:
        older = F.col(f"s.{newer_by}") < F.col(f"t.{newer_by}")
        update = update & ~F.coalesce(older, F.lit(False))

    def resolve(name: str, kind: Any) -> Column:
        old = F.col(f"t.{name}")
        if name == policy.key:
            return F.coalesce(old, F.col(f"s.{name}"))
        inserted: Column = F.lit(None)
        updated = old
        if name in policy.last:
            inserted = updated = F.col(f"s.{name}")
        elif name in policy.first:
            inserted = F.col(f"s.{name}")
        if name in policy.on_insert:
            inserted = _constant(policy.on_insert[name])
        if name in policy.on_update:
            updated = _constant(policy.on_update[name])
        return F.when(~known, inserted).when(update, updated).otherwise(old).cast(kind)

    return joined.select(
        *(resolve(f.name, f.dataType).alias(f.name) for f in target.schema.fields)
    )


def _constant(value: Any) -> Column:
    return instant(value) if isinstance(value, datetime) else F.lit(value)


def _moment(as_of: datetime | str) -> datetime:
    return datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def channel_policy(as_of: datetime | str) -> Policy:
    return Policy(
        key="channel_id",
        first=("published_at", "country"),
        last=(
            "channel_title",
            "channel_description",
            "total_views",
            "subscriber_count",
            "video_count",
            "processed_at",
        ),
        on_insert={"created_at": _moment(as_of)},
    )


def queue_policy(as_of: datetime | str) -> Policy:
    """A video seen again is active and due at once, but keeps its interval."""
    seen = {"status": "active", "last_polled_at": _moment(as_of), "next_poll_at": _moment(as_of)}
    return Policy(
        key="video_id",
        last=("channel_id", "published_at"),
        on_insert={
            **seen,
            "current_interval_hours": FIRST_POLL_HOURS,
            "created_at": _moment(as_of),
        },
        on_update=seen,
    )


def upsert_channels(
    target: DataFrame,
    batch: DataFrame,
    as_of: datetime | str,
    order: Sequence[str],
    newer_only: bool = False,
) -> DataFrame:
    newer_by = "processed_at" if newer_only else None
    return upsert(target, batch, channel_policy(as_of), order, newer_by)


def upsert_queue(
    target: DataFrame, batch: DataFrame, as_of: datetime | str, order: Sequence[str]
) -> DataFrame:
    return upsert(target, batch, queue_policy(as_of), order)


def keyed_update(
    target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Set ``columns`` where the key matches; keys without a row change nothing.

    ``updates`` holds one row per key.  A null in it is written like any other value.
    """
    left = target.alias("t")
    right = updates.select(key, *columns).withColumn(_SOURCE, F.lit(True)).alias("s")
    joined = left.join(right, F.col(f"t.{key}") == F.col(f"s.{key}"), "left_outer")
    matched = F.col(f"s.{_SOURCE}").isNotNull()
    return joined.select(
        *(
            F.when(matched, F.col(f"s.{f.name}"))
            .otherwise(F.col(f"t.{f.name}"))
            .cast(f.dataType)
            .alias(f.name)
            if f.name in columns
            else F.col(f"t.{f.name}")
            for f in target.schema.fields
        )
    )


def poll_updates(
    measured: DataFrame, as_of: datetime | str, order: Sequence[str] = ("published_at",)
) -> DataFrame:
    """New poll times and interval for each measured video.

    A video without a publication time has no age, so it stays as it is, and due.
    """
    now = instant(as_of)
    aged = measured.where(F.col("published_at").isNotNull())
    latest = fold_batch(aged, "video_id", order, last=("published_at",))
    interval = poll_interval_hours(F.col("published_at"), now)
    return latest.select(
        "video_id",
        now.alias("last_polled_at"),
        hours_later(now, interval).alias("next_poll_at"),
        interval.alias("current_interval_hours"),
    )


def apply_cadence(
    queue: DataFrame,
    measured: DataFrame,
    as_of: datetime | str,
    order: Sequence[str] = ("published_at",),
) -> DataFrame:
    """The queue after a measurement run; unmeasured videos are untouched."""
    return keyed_update(
        queue,
        poll_updates(measured, as_of, order),
        "video_id",
        ("last_polled_at", "next_poll_at", "current_interval_hours"),
    )
