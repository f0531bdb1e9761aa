"""Insert defaults, schema evolution and flattening of batches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions.instants import instant
from statflow.schemas import AS_OF, INSERT_DEFAULTS, TABLES


def fill_defaults(df: DataFrame, table: str, as_of: datetime | str) -> DataFrame:
    """All table columns in order: absent ones take their default, nulls stay null."""
    defaults = INSERT_DEFAULTS[table]

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            filled = F.col(field.name)
        else:
            default = defaults.get(field.name)
            filled = instant(as_of) if default is AS_OF else F.lit(default)
        return filled.cast(field.dataType).alias(field.name)

    return df.select(*(column(field) for field in TABLES[table].fields))


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns the frame lacks are added as nulls; existing ones are left as they are."""
    missing = {
        field.name: F.lit(None).cast(field.dataType)
        for field in schema.fields
        if field.name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def backfill(df: DataFrame, column: str, source: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(column, source))


def union_versions(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames written under different versions of a schema."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def flatten_batches(df: DataFrame, batch: str) -> DataFrame:
    """One row per element of a list-of-structs column; repeats stay."""
    return df.select(F.explode(batch).alias("element")).select("element.*")


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """A surrogate key: unique, not dense, and not stable between runs."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")
