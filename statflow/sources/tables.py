"""Database tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    # opened at once by a writer, whatever the number of partitions
    connections: int = 32

    def options(self, table: str) -> dict[str, str]:
        given = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
        }
        return {key: value for key, value in given.items() if value is not None}


@dataclass(frozen=True)
class Split:
    """How a scan is cut into ranges of one numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table scan; with a ``Split`` every range is one task and one connection."""
    options = {**database.options(table), "fetchsize": str(fetch_size)}
    if split is not None:
        options.update(split.options())
    return spark.read.format("jdbc").options(**options).load()
