"""Registry of checked queries, and the test tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.session import name_shared_folder, pin_utc

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The Parquet tables of one test data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = name_shared_folder(pin_utc(spark)), folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, source: str, expressions: list[str]) -> DataFrame:
        """A projection of a table; zone-less times become instants (UTC)."""
        return with_instants(self.raw(source).selectExpr(*expressions))


def with_instants(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in times}) if times else df


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as plain UTC times, which is what the SQL twin returns."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    zoneless = {name: F.col(name).cast("timestamp_ntz") for name in times}
    return df.withColumns(zoneless) if times else df


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(tables)`` under ``name``, with its SQL twin if there is one."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return without_zone(fn(Tables(spark, folder)))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
