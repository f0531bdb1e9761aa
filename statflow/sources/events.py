"""Stream of keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STREAM_FRAME = "key binary, value binary, timestamp timestamp"


def broker_options(
    servers: str, topic: str, group: str, per_trigger: int | None = None
) -> dict[str, str]:
    """``per_trigger`` bounds the messages of a micro-batch; without it a trigger takes all there are."""
    limit = {} if per_trigger is None else {"maxOffsetsPerTrigger": str(per_trigger)}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.group.id": group,
        **limit,
    }


def read_events(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages from a broker; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("key", "value", "timestamp")


def read_event_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same frame from Parquet files, picked up as they arrive."""
    reader = spark.readStream.schema(STREAM_FRAME)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def as_event_frame(df: DataFrame, key: str, value: str, timestamp: str) -> DataFrame:
    """Any batch of texts in the shape of the stream."""
    return df.select(
        F.col(key).cast("binary").alias("key"),
        F.col(value).cast("binary").alias("value"),
        F.col(timestamp).cast("timestamp").alias("timestamp"),
    )
