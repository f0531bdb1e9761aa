"""Messages and API objects to typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions import bags
from statflow.functions.instants import instant, iso_text, parse_instant
from statflow.schemas import DEFAULT_CATEGORY, WIRE

CORRUPT = "_corrupt_record"
REASON = "reject_reason"
BAD_FIELDS = "bad_fields"
_WIRE_TIMES = ("processed_at", "published_at")
_WIRE_OR_CORRUPT = T.StructType([*WIRE.fields, T.StructField(CORRUPT, T.StringType())])


def typed_times(df: DataFrame, *columns: str) -> DataFrame:
    """ISO text columns to timestamps; '' and unreadable text become null."""
    return df.withColumns({name: parse_instant(F.col(name)) for name in columns})


def parse_messages(raw: DataFrame, *carry: str) -> DataFrame:
    """Message bytes to typed columns; unusable messages give rows of nulls.

    ``carry`` columns of the message, such as its key, come first."""
    record = F.from_json(F.col("value").cast("string"), WIRE)
    flat = raw.select(*carry, F.col("timestamp").alias("kafka_timestamp"), _once(record))
    return typed_times(flat, *_WIRE_TIMES)


def _once(record: Column) -> Column:
    """The fields of a parsed record as columns.

    A filter on a field stays above ``inline``.  Above a plain projection it would be pushed
    below it, and the text would be parsed again for each use in the filter.
    """
    return F.inline(F.array(record))


def parse_checked(raw: DataFrame, require_time: bool = True) -> DataFrame:
    """As ``parse_messages``, plus the message text and why it cannot be used, if so."""
    message = F.col("value").cast("string")
    record = F.from_json(message, _WIRE_OR_CORRUPT, {"columnNameOfCorruptRecord": CORRUPT})
    flat = raw.select(
        F.col("timestamp").alias("kafka_timestamp"),
        message.alias("message"),
        _once(record),
    )
    typed = typed_times(flat, *_WIRE_TIMES)
    reason = (
        F.when(F.col("message").isNull(), F.lit("no_value"))
        .when(F.col(CORRUPT).isNotNull(), F.lit("corrupt"))
        .when(F.col("channel_id").isNull(), F.lit("no_key"))
    )
    if require_time:
        reason = reason.when(F.col("processed_at").isNull(), F.lit("no_event_time"))
    return typed.withColumn(REASON, reason).drop(CORRUPT)


def usable(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON, "message")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull()).select("kafka_timestamp", REASON, "message")


def wire_frame(df: DataFrame, key: str = "channel_id", carry: Sequence[Column] = ()) -> DataFrame:
    """Rows as keyed JSON messages.  Nulls are written out; an empty key is no key.

    ``carry`` columns come last, beside the message."""
    columns: list[Column] = [
        iso_text(F.col(field.name)).alias(field.name)
        if isinstance(field.dataType, T.TimestampType)
        else F.col(field.name)
        for field in df.schema.fields
    ]
    return df.select(
        F.nullif(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"),
        *carry,
    )


# Counter column -> key in the API object
CHANNEL_COUNTERS = {
    "total_views": "viewCount",
    "subscriber_count": "subscriberCount",
    "video_count": "videoCount",
}
VIDEO_COUNTERS = {
    "view_count": "viewCount",
    "like_count": "likeCount",
    "comment_count": "commentCount",
}


def flatten_channels(items: DataFrame, as_of: datetime | str, *carry: str) -> DataFrame:
    """Channel objects to wire records; ``bad_fields`` names unreadable counters.

    ``carry`` columns of the input come first, unchanged.
    """
    snippet, statistics = F.col("snippet"), F.col("statistics")
    counters = [bags.count(statistics, key).alias(name) for name, key in CHANNEL_COUNTERS.items()]
    return items.select(
        *carry,
        F.coalesce("id", F.lit("")).alias("channel_id"),
        bags.text(snippet, "title", "").alias("channel_title"),
        bags.text(snippet, "description", "").alias("channel_description"),
        bags.text(snippet, "publishedAt", "").alias("published_at"),
        bags.text(snippet, "country", "").alias("country"),
        *counters,
        iso_text(instant(as_of)).alias("processed_at"),
        bags.unreadable_counts(statistics, CHANNEL_COUNTERS).alias(BAD_FIELDS),
    )


def flatten_videos(
    items: DataFrame, as_of: datetime | str, category: str = DEFAULT_CATEGORY, *carry: str
) -> DataFrame:
    """Video objects to the 25 trend columns; ``bad_fields`` names unreadable counters."""
    snippet, statistics, content, status, topics = (
        F.col(name)
        for name in ("snippet", "statistics", "contentDetails", "status", "topicDetails")
    )
    counters = [bags.count(statistics, key).alias(name) for name, key in VIDEO_COUNTERS.items()]
    return items.select(
        *carry,
        F.col("id").alias("video_id"),
        bags.text(snippet, "channelTitle", "").alias("channel_title"),
        F.lit(category).alias("project_category"),
        bags.text(snippet, "title", "").alias("title"),
        bags.text(snippet, "description", "").alias("description"),
        parse_instant(bags.value(snippet, "publishedAt")).alias("published_at"),
        bags.thumbnail_url(snippet).alias("thumbnail_url"),
        bags.texts(snippet, "tags").alias("tags"),
        bags.value(snippet, "categoryId").alias("youtube_category_id"),
        bags.text(snippet, "liveBroadcastContent", "none").alias("live_broadcast_content"),
        *counters,
        bags.text(content, "duration", "").alias("duration"),
        bags.text(content, "dimension", "").alias("dimension"),
        bags.text(content, "definition", "").alias("definition"),
        bags.text(content, "caption", "").alias("caption"),
        bags.flag(content, "licensedContent", False).alias("licensed_content"),
        bags.text(content, "projection", "").alias("projection"),
        bags.texts(topics, "topicCategories").alias("topic_categories"),
        bags.text(status, "uploadStatus", "").alias("upload_status"),
        bags.text(status, "privacyStatus", "").alias("privacy_status"),
        bags.flag(status, "embeddable", True).alias("embeddable"),
        bags.flag(status, "publicStatsViewable", True).alias("public_stats_viewable"),
        instant(as_of).alias("captured_at"),
        bags.unreadable_counts(statistics, VIDEO_COUNTERS).alias(BAD_FIELDS),
    )


def readable(flat: DataFrame) -> DataFrame:
    return flat.where(F.size(BAD_FIELDS) == 0).drop(BAD_FIELDS)


def unreadable(flat: DataFrame) -> DataFrame:
    return flat.where(F.size(BAD_FIELDS) > 0)
