"""What the operators share: reading tables, tables in the shared folder, bounded blocks of rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from statflow.session import name_shared_folder, scratch_path, shared_folder

__all__ = ["blocks", "pass_through", "schema_with", "scratch_path", "shared_folder", "small_batches", "stored", "table"]

#: Rows of one Arrow batch sent to a Python worker; texts may be long, so batches stay small.
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a test data folder; also sets small Arrow batches for the session."""
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bounds what a Python worker holds at once: few rows, however long their texts.

    A session inside one process that names no shared folder, as in tests, gets one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return name_shared_folder(spark)


def stored(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` written below the shared folder and read back: later steps no longer depend on its lineage.

    ``by``: columns that get a folder for each of their few values."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Slices of consecutive rows whose sizes add up to about ``limit``; a larger row is alone."""
    start = total = 0
    end = -1
    for end, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, end
            start, total = end, 0
        total += size + 1
    if end >= start:
        yield start, end + 1


def pass_through(batch: pa.RecordBatch, names: list[str], **columns) -> pa.RecordBatch:
    """The named columns of ``batch``, then new ones."""
    arrays = [batch.column(batch.schema.get_field_index(name)) for name in names]
    arrays += [value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value) for value in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, [*names, *columns])


def schema_with(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` and the columns of a DDL string."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])
