"""Positions and neighbours in a total order, without gathering rows in one task.

A window without partition columns, or with a hot key, ends in a single task.  Here the
rows are dealt by ranges of the whole order instead and sorted in place, whatever the keys
look like.  Numbered rows are written to the shared folder together with their place.  What crosses
ranges is one row for each: a count, or the last row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.session import scratch_path

_PART, _ROW = "__part", "__row"
# a partition number fills the bits above this one in monotonically_increasing_id
_ROW_BITS = 33


def _partitions(df: DataFrame, wanted: int | None) -> int:
    return wanted or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in global order with their partition and place, fixed by writing them.

    Range bounds are sampled, so two evaluations may cut differently; the written rows make
    every later pass see the same cut, also after the loss of an executor.
    """
    placed = (
        df.repartitionByRange(_partitions(df, partitions), *order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    numbered = placed.select(
        *df.columns,
        F.shiftright("__id", _ROW_BITS).cast("int").alias(_PART),
        F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(_ROW),
    )
    return _stored(numbered, "ranged")


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None
) -> DataFrame:
    """Adds the 0-based position of each row in the total order."""
    rows = ranged(df, order, partitions)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, so the window and the broadcast are small by construction
    starts = (
        rows.groupBy(_PART)
        .agg(F.count("*").alias("__size"))
        .select(_PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    )
    return (
        rows.join(F.broadcast(starts), _PART)
        .withColumn(name, F.col("__start") + F.col(_ROW))
        .drop(_PART, _ROW, "__start")
    )


# rows sampled for each range
_SAMPLES = 30


def _bounds(df: DataFrame, order: Sequence[str], ranges: int) -> Column:
    """Upper ends of all ranges but the last, in order, as one scalar: rows drawn from the whole table.

    A value that many rows share is drawn often, so it takes up several bounds."""
    count = df.count()
    drawn = df if count <= _SAMPLES * ranges else df.where(F.rand(17) < _SAMPLES * ranges / count)
    held = drawn.agg(F.sort_array(F.collect_list(F.struct(*order))).alias("rows"))
    every = F.sequence(F.lit(1), F.lit(ranges - 1)) if ranges > 1 else F.array().cast("array<int>")
    place = lambda n: F.ceil(n * F.size("rows") / F.lit(float(ranges))).cast("int")
    cut = F.transform(every, lambda n: F.element_at("rows", F.greatest(place(n), F.lit(1))))
    return held.select(F.when(F.size("rows") > 0, cut).otherwise(F.slice("rows", 1, 0)).alias("bounds")).scalar()


def _below(bounds: Column, row: Column, ranges: int, equal: bool) -> Column:
    """How many bounds lie below a row, with equal ones or without, by binary search."""
    widths = [1 << n for n in reversed(range((ranges - 1).bit_length()))]

    def step(found: Column, width: Column) -> Column:
        there = F.try_element_at(bounds, found + width)
        return F.when((there <= row) if equal else (there < row), found + width).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), step) if widths else F.lit(0)


def dealt(df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """Rows dealt to tasks by ranges of a total order, with the number of the range.

    Every row of a range is before those of the next.  Rows that are equal in all of ``order`` may
    lie in any of the ranges whose bounds they are, so one value never has to fit in one task."""
    ranges = _partitions(df, partitions)
    bounds, row, top = F.col("__bounds"), F.col("__row"), F.col("__top")
    placed = df.withColumn("__bounds", _bounds(df, order, ranges)).withColumn("__row", F.struct(*order))
    placed = placed.withColumn("__top", _below(bounds, row, ranges, True))
    bound = lambda back: F.try_element_at(bounds, F.greatest(top - back, F.lit(1)))
    many = (top > 1) & (bound(0) == row) & (bound(1) == row)
    placed = placed.withColumn("__low", F.when(many, _below(bounds, row, ranges, False)).otherwise(top))
    spread = F.pmod(F.monotonically_increasing_id(), top - F.col("__low") + 1).cast("int")
    placed = placed.withColumn(name, F.col("__low") + spread)
    return placed.drop("__bounds", "__row", "__top", "__low").repartitionById(ranges, F.col(name))


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Adds ``prev_<column>`` from the row before, within the key.

    ``order`` should be total up to rows that are equal in all columns.  Rows are dealt once, by ranges of
    key, order and all other columns, whatever the keys look like; a window within each range takes the row
    before, and the first row of a range takes it from the last row of a range before.
    """
    rest = [name for name in df.columns if name != key and name not in order]
    whole = [key, *order, *rest]
    rows = dealt(df, whole, _PART, partitions)
    carried = [key, *columns]
    own = Window.partitionBy(_PART).orderBy(*whole)
    linked = rows.withColumn("__before", F.lag(F.struct(*carried)).over(own))
    # one row per range, so the window and the broadcast are small by construction
    last = rows.groupBy(_PART).agg(F.max(F.struct(*whole)).alias("__last"))
    across = F.lag("__last").over(Window.orderBy(_PART))
    borders = last.select(_PART, F.struct(*(across[name].alias(name) for name in carried)).alias("__border"))
    joined = linked.join(F.broadcast(borders), _PART, "left")
    before = F.coalesce("__before", "__border")
    same = before[key].eqNullSafe(F.col(key))  # before the very first row everything is null
    found = [F.when(same, before[name]).alias(f"prev_{name}") for name in columns]
    return joined.select(*df.columns, *found)
