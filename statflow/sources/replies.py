"""Landing zone of raw API replies, one JSON document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.schemas import PLAYLIST_ITEM, UPLOADS_LOOKUP_ITEM, reply_of


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def items_of(replies: DataFrame, *carry: str) -> DataFrame:
    """One row per item; a reply without a list of items has none."""
    return replies.select(*carry, F.explode("items").alias("item")).select(*carry, "item.*")


def read_items(
    spark: SparkSession, path: str, item: T.StructType, extra: T.StructType | None = None
) -> DataFrame:
    """Items of all replies below ``path``; ``extra`` columns of the reply are carried."""
    schema = reply_of(item)
    carry = extra.fieldNames() if extra is not None else []
    if extra is not None:
        schema = T.StructType(extra.fields + schema.fields)
    return items_of(read_raw(spark, path, schema), *carry)


def parse_replies(df: DataFrame, column: str, item: T.StructType, *carry: str) -> DataFrame:
    """Items of replies that are held as text in a column."""
    replies = df.select(*carry, F.from_json(column, reply_of(item)).alias("reply"))
    return items_of(replies.select(*carry, "reply.items"), *carry)


def uploads_lists(df: DataFrame, column: str, *carry: str) -> DataFrame:
    """``uploads_playlist_id`` from channel detail replies: that of the first item.

    A reply without items, or whose first item names no list, gives no row.
    """
    replies = df.select(*carry, F.from_json(column, reply_of(UPLOADS_LOOKUP_ITEM)).alias("reply"))
    first = F.get(F.col("reply.items"), 0)
    named = first["contentDetails"]["relatedPlaylists"]["uploads"].alias("uploads_playlist_id")
    return replies.select(*carry, named).where("uploads_playlist_id is not null")


def uploads_positions(df: DataFrame, column: str, *carry: str) -> DataFrame:
    """``position, video_id`` from replies that list uploads; the order of the list is the position."""
    replies = df.select(*carry, F.from_json(column, reply_of(PLAYLIST_ITEM)).alias("reply"))
    items = replies.select(*carry, F.posexplode("reply.items").alias("position", "item"))
    video = F.col("item.contentDetails.videoId").alias("video_id")
    return items.select(*carry, "position", video).where("video_id is not null")
