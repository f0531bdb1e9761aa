"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from statflow.schemas import PAGE_SIZE
from statflow.sources.tables import Database


def write_options(database: Database, table: str, page: int = PAGE_SIZE) -> dict[str, str]:
    return {
        **database.options(table),
        "batchsize": str(page),
        "numPartitions": str(database.connections),
    }


def append_table(df: DataFrame, database: Database, table: str, page: int = PAGE_SIZE) -> None:
    df.write.format("jdbc").options(**write_options(database, table, page)).mode("append").save()


def overwrite_table(
    df: DataFrame, database: Database, table: str, page: int = PAGE_SIZE, truncate: bool = True
) -> None:
    """Replaces all rows.  ``truncate`` keeps the table definition, its keys and its grants."""
    options = {**write_options(database, table, page), "truncate": str(truncate).lower()}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
