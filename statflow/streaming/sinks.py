"""Sinks for micro-batches that may be delivered more than once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.sinks.metrics import write_counted
from statflow.sinks.tables import append_table
from statflow.sources.tables import Database, read_table

Handler = Callable[[DataFrame, int], None]
LEDGER = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


class UnknownCheckpoint(RuntimeError):
    """A stream goes on with another checkpoint than the one its target was written with.

    Batch numbers of the two say nothing about each other: going on would skip rows or store
    them twice.  Give the stream a new name, or its old checkpoint back.
    """


def checkpoint_of(batch: DataFrame) -> str:
    """The id that Spark keeps in the checkpoint of the running stream, '' outside of one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


class Store(Protocol):
    """Tables that can be appended to and read."""

    def append(self, df: DataFrame, table: str) -> None: ...

    def read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame: ...


@dataclass(frozen=True)
class DatabaseStore:
    """Tables of a database; the tables exist."""

    database: Database

    def append(self, df: DataFrame, table: str) -> None:
        append_table(df, self.database, table)

    def read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        return read_table(spark, self.database, table).select(*schema.names)


@dataclass(frozen=True)
class FolderStore:
    """Tables as Parquet folders below a shared path."""

    root: str

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(f"{self.root}/{table}")

    def read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{table}"
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(jpath):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class AppendSink:
    """Appends each micro-batch exactly once, on stores that can only append.

    Rows carry the batch and the attempt that wrote them.  The attempt counts once its line
    is in the ledger; readers take rows of such attempts only.  A batch that is delivered
    again finds its line and stores nothing; the rows of an attempt that died are never seen.
    """

    store: Store
    table: str
    stream: str
    # last batch of this process; only the first one after a start can be in the ledger already
    _seen: dict[str, int] = field(default_factory=dict)

    @property
    def ledger(self) -> str:
        return f"{self.table}_commits"

    def committed(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark, self.ledger, LEDGER).where(F.col("stream") == self.stream)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, checkpoint = batch.sparkSession, checkpoint_of(batch)
        if self._was_written(spark, checkpoint, batch_id):
            # evaluated all the same: a stateful stream must commit its state for this batch
            batch.write.format("noop").mode("overwrite").save()
            return
        attempt = uuid.uuid4().hex
        tagged = batch.withColumns(
            {
                "stream": F.lit(self.stream),
                "batch_id": F.lit(batch_id).cast("bigint"),
                "attempt": F.lit(attempt),
            }
        )
        # counted while written: the batch, with its stateful part, is evaluated once
        rows = write_counted(tagged, lambda df: self.store.append(df, self.table))
        if rows:
            line = spark.createDataFrame([(self.stream, checkpoint, batch_id, attempt, rows)], LEDGER)
            self.store.append(line.coalesce(1), self.ledger)
        self._seen[checkpoint] = batch_id

    def _was_written(self, spark: SparkSession, checkpoint: str, batch_id: int) -> bool:
        if checkpoint in self._seen:
            return batch_id <= self._seen[checkpoint]
        lines = self.committed(spark)
        if not lines.where(F.col("checkpoint") != checkpoint).isEmpty():
            raise UnknownCheckpoint(f"{self.stream} in {self.table}")
        return not lines.where(F.col("batch_id") == batch_id).isEmpty()

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Rows of finished attempts."""
        tags = [f for f in LEDGER.fields if f.name in ("stream", "batch_id", "attempt")]
        rows = self.store.read(spark, self.table, T.StructType([*schema.fields, *tags]))
        done = self.committed(spark).select("stream", "batch_id", "attempt")
        return rows.join(done, ["stream", "batch_id", "attempt"], "left_semi").select(
            *schema.names
        )
