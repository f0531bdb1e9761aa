"""Engagement figures per channel."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions import ratios
from statflow.functions.instants import elapsed_days, instant
from statflow.schemas import CHANNEL_STATS_V1


def engagement_columns(rounded: bool) -> dict[str, Column]:
    views, subscribers, videos = (
        F.col(name) for name in ("total_views", "subscriber_count", "video_count")
    )
    return {
        "avg_views_per_video": ratios.avg_views_per_video(views, videos, rounded),
        "views_per_subscriber": ratios.views_per_subscriber(views, subscribers, rounded),
        "engagement_ratio": ratios.engagement_ratio(subscribers, views, rounded),
        "size_tier": ratios.size_tier(subscribers),
    }


def with_engagement(df: DataFrame, rounded: bool = False) -> DataFrame:
    """All columns plus three ratios and the size tier; works on batches and streams."""
    return df.withColumns(engagement_columns(rounded))


def enriched_view(channel_stats: DataFrame, as_of: datetime | str) -> DataFrame:
    """The reporting view: ten stored and five derived columns, ratios rounded."""
    derived = {
        **engagement_columns(rounded=True),
        "channel_age_days": elapsed_days(F.col("published_at"), instant(as_of)),
    }
    return channel_stats.select(
        *CHANNEL_STATS_V1.names, *(column.alias(name) for name, column in derived.items())
    )
