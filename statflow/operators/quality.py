"""Declared constraints as table operators: checks, reports and clean/quarantine splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.operators.skew import heavy_keys, join_unique
from statflow.schemas import DOMAIN, LOWER_BOUND, MAX_LENGTH, NOT_NULL

VIOLATED = "violated"


def _named(condition: Column, rule: str) -> Column:
    return F.when(condition, F.lit(rule))


def _ranges(table: str) -> dict[str, Column]:
    """A null passes, as in a SQL CHECK."""
    return {f"{c}:range": F.col(c) < bound for c, bound in LOWER_BOUND.get(table, {}).items()}


def _domains(table: str) -> dict[str, Column]:
    return {f"{c}:domain": ~F.col(c).isin(*values) for c, values in DOMAIN.get(table, {}).items()}


def _nulls(table: str) -> dict[str, Column]:
    return {f"{c}:not_null": F.col(c).isNull() for c in NOT_NULL.get(table, ())}


def _lengths(table: str) -> dict[str, Column]:
    return {f"{c}:length": F.char_length(c) > limit for c, limit in MAX_LENGTH.get(table, {}).items()}


def row_conditions(table: str) -> dict[str, Column]:
    """When a row breaks which rule."""
    return {**_ranges(table), **_domains(table), **_nulls(table), **_lengths(table)}


def _rules(conditions: dict[str, Column]) -> list[Column]:
    return [_named(condition, rule) for rule, condition in conditions.items()]


def range_rules(table: str) -> list[Column]:
    return _rules(_ranges(table))


def domain_rules(table: str) -> list[Column]:
    return _rules(_domains(table))


def null_rules(table: str) -> list[Column]:
    return _rules(_nulls(table))


def length_rules(table: str) -> list[Column]:
    return _rules(_lengths(table))


def row_rules(table: str) -> list[Column]:
    return _rules(row_conditions(table))


def check_rows(df: DataFrame, rules: Sequence[Column]) -> DataFrame:
    """Adds the names of the rules each row breaks; one pass, no shuffle."""
    return df.withColumn(VIOLATED, F.array_compact(F.array(*rules)))


def violations(df: DataFrame, key: str, rules: Sequence[Column]) -> DataFrame:
    """One row per broken rule and row."""
    return check_rows(df, rules).select(F.explode(VIOLATED).alias("rule"), F.col(key).alias("key"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that point to no parent; a null points nowhere and passes."""
    parents = parent.select(F.col(parent_key).alias("__parent"))
    return child.where(F.col(column).isNotNull()).join(
        parents, F.col(column) == F.col("__parent"), "left_anti"
    )


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Missing parents with their number of child rows, counted before the join."""
    counted = child.groupBy(column).agg(F.count("*").alias("n"))
    return orphans(counted, column, parent, parent_key)


def cascade_delete(rows: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """Rows left once those pointing to a deleted key are gone."""
    gone = deleted.select(F.col(key).alias("__gone")).distinct()
    return rows.join(gone, F.col(column) == F.col("__gone"), "left_anti")


def cascade_channels(
    deleted: DataFrame, channels: DataFrame, videos: DataFrame, snapshots: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Channels, videos and snapshots after deleting channels with all that hangs on them."""
    gone = deleted.select("channel_id").distinct()
    lost_videos = videos.join(gone, "channel_id", "left_semi").select("video_id")
    return (
        cascade_delete(channels, "channel_id", gone, "channel_id"),
        cascade_delete(videos, "channel_id", gone, "channel_id"),
        cascade_delete(snapshots, "video_id", lost_videos, "video_id"),
    )


def violation_report(
    df: DataFrame,
    table: str,
    key: str,
    unique: bool = False,
    parent: tuple[str, DataFrame, str] | None = None,
) -> DataFrame:
    """Rule, key and number of rows, over row rules, key uniqueness and the foreign key.

    Keys and child columns are counted in their own types, with nothing beside them in the shuffle; only
    rows that break a row rule become texts.  Both counts combine before the shuffle, and the second one
    before the parents are looked up.  Each of the three parts reads just the columns it needs.

    ``parent`` is (child column, parent table, parent key).
    """
    column, parents, parent_key = parent or (key, None, key)
    same = df.schema[key].dataType == df.schema[column].dataType

    def told(rule: Column, name: str) -> list[Column]:
        value = F.col(name) if same else F.col(name).cast("string")
        return [rule.alias("rule"), value.alias("key"), F.col("n")]

    rules = row_rules(table)
    broken = df.where(F.coalesce(*rules).isNotNull())
    broken = violations(broken, key, rules).groupBy("rule", F.col("key").alias(key)).agg(F.count("*").alias("n"))
    report = broken.select(*told(F.col("rule"), key))
    if unique:
        repeated = duplicate_keys(df.where(F.col(key).isNotNull()), key)
        report = report.union(repeated.select(*told(F.lit(f"{key}:unique"), key)))
    if parents is not None:
        missing = orphan_counts(df.where(F.col(column).isNotNull()), column, parents, parent_key)
        report = report.union(missing.select(*told(F.lit(f"{column}:parent"), column)))
    return report


def with_all_violations(
    df: DataFrame,
    table: str,
    key: str | None = None,
    order: Sequence[str] = (),
    parent: tuple[str, DataFrame, str] | None = None,
) -> DataFrame:
    """Adds every broken rule.  With ``key`` and a total ``order`` a repeated key is a
    violation of all rows but the first that is otherwise clean."""
    checked = check_rows(df, row_rules(table))
    if parent is not None:
        column, table_df, parent_key = parent
        parents = table_df.select(F.col(parent_key).alias("__parent")).distinct()
        parents = parents.withColumn("__found", F.lit(True))
        checked = checked.join(parents, F.col(column) == F.col("__parent"), "left_outer")
        missing = F.col(column).isNotNull() & F.col("__found").isNull()
        checked = _add_violation(checked, missing, f"{column}:parent").drop("__parent", "__found")
    if key is not None:
        place = F.struct(*order)
        holders = (
            checked.where(F.size(VIOLATED) == 0)
            .groupBy(F.col(key).alias("__held"))
            .agg(F.min(place).alias("__holder"), F.count("*").alias("__n"))
            .where("__n > 1")
            .drop("__n")
        )
        checked = join_unique(checked, key, holders, "__held", "left_outer", heavy_keys(df, key))
        later = (F.size(VIOLATED) == 0) & F.coalesce(place > F.col("__holder"), F.lit(False))
        checked = _add_violation(checked, later, f"{key}:unique").drop("__holder")
    return checked


def _add_violation(df: DataFrame, condition: Column, rule: str) -> DataFrame:
    extended = F.array_append(VIOLATED, F.lit(rule))
    return df.withColumn(VIOLATED, F.when(condition, extended).otherwise(F.col(VIOLATED)))


def clean(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(VIOLATED) == 0).drop(VIOLATED)


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(VIOLATED) > 0)
