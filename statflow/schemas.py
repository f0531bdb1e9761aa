"""Declared schemas, defaults and constraints of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, lengths, defaults and labels are part of the data
# contract with the producers and readers of these tables.
# ---------------------------------------------------------------------------

KEY_LENGTH = 64
BATCH_SIZE = 50
PAGE_SIZE = 200
DAILY_QUOTA_UNITS = 10_000
QUOTA_ZONE = "America/Los_Angeles"
QUOTA_STATUS = 403
QUOTA_REASONS = ("quotaexceeded", "dailylimitexceeded", "ratelimitexceeded")
DEFAULT_CATEGORY = "Data Science & AI"
VIDEO_STATUSES = ("active", "archived", "deleted")

# (lower bound on subscribers, label); below the last bound the floor label holds
SIZE_TIERS = (
    (1_000_000, "Mega (1M+)"),
    (100_000, "Large (100K–1M)"),
    (10_000, "Mid (10K–100K)"),
    (1_000, "Small (1K–10K)"),
)
FLOOR_TIER = "Micro (<1K)"

# (exclusive upper bound on age in hours, polling interval in hours)
POLL_CADENCE = ((24, 1), (7 * 24, 6), (30 * 24, 24))
SLOWEST_POLL_HOURS = 168
FIRST_POLL_HOURS = 1


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _LONG, _INT, _TIME, _FLAG = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampType(),
    T.BooleanType(),
)
_TEXTS = T.ArrayType(_TEXT)
_BAG = T.MapType(_TEXT, _TEXT)

# JSON record on the wire: times travel as ISO-8601 text
WIRE = _struct(
    channel_id=_TEXT,
    channel_title=_TEXT,
    channel_description=_TEXT,
    published_at=_TEXT,
    country=_TEXT,
    total_views=_LONG,
    subscriber_count=_LONG,
    video_count=_LONG,
    processed_at=_TEXT,
)

CHANNEL_STATS_V1 = _struct(
    channel_id=_TEXT,
    channel_title=_TEXT,
    channel_description=_TEXT,
    published_at=_TIME,
    country=_TEXT,
    total_views=_LONG,
    subscriber_count=_LONG,
    video_count=_LONG,
    processed_at=_TIME,
    created_at=_TIME,
)

CHANNEL_STATS = T.StructType(
    CHANNEL_STATS_V1.fields
    + _struct(
        title=_TEXT,
        tier_category=_TEXT,
        uploads_playlist_id=_TEXT,
        last_checked_at=_TIME,
    ).fields
)

CHANNEL_SEED = _struct(
    channel_id=_TEXT,
    channel_title=_TEXT,
    country=_TEXT,
    subscriber_count=_LONG,
    total_views=_LONG,
    uploads_playlist_id=_TEXT,
)

VIDEOS = _struct(
    video_id=_TEXT,
    channel_id=_TEXT,
    published_at=_TIME,
    status=_TEXT,
    last_polled_at=_TIME,
    next_poll_at=_TIME,
    current_interval_hours=_INT,
    created_at=_TIME,
)

VIEW_TIMESERIES = _struct(
    video_id=_TEXT,
    scraped_at=_TIME,
    view_count=_LONG,
    like_count=_LONG,
    comment_count=_LONG,
)

VIDEO_TRENDS = _struct(
    video_id=_TEXT,
    channel_title=_TEXT,
    project_category=_TEXT,
    title=_TEXT,
    description=_TEXT,
    published_at=_TIME,
    thumbnail_url=_TEXT,
    tags=_TEXTS,
    youtube_category_id=_TEXT,
    live_broadcast_content=_TEXT,
    view_count=_LONG,
    like_count=_LONG,
    comment_count=_LONG,
    duration=_TEXT,
    dimension=_TEXT,
    definition=_TEXT,
    caption=_TEXT,
    licensed_content=_FLAG,
    projection=_TEXT,
    topic_categories=_TEXTS,
    upload_status=_TEXT,
    privacy_status=_TEXT,
    embeddable=_FLAG,
    public_stats_viewable=_FLAG,
    captured_at=_TIME,
)

REQUEST_LOG = _struct(ts=_TIME, api_key=_TEXT, status=_INT, message=_TEXT, units=_INT)

# Nested API replies.  The objects are read as maps, since a struct cannot tell a
# missing key (which takes a default) from an explicit null (which stays null).
CHANNEL_ITEM = _struct(id=_TEXT, snippet=_BAG, statistics=_BAG)
VIDEO_ITEM = _struct(
    id=_TEXT,
    snippet=_BAG,
    statistics=_BAG,
    contentDetails=_BAG,
    status=_BAG,
    topicDetails=_BAG,
)
UPLOADS_LOOKUP_ITEM = _struct(
    contentDetails=_struct(relatedPlaylists=_struct(uploads=_TEXT)),
)
PLAYLIST_ITEM = _struct(contentDetails=_struct(videoId=_TEXT))


def reply_of(item: T.StructType) -> T.StructType:
    """Schema of an API reply holding a list of ``item``."""
    return _struct(items=T.ArrayType(item))


# Values a column takes when an insert leaves the column out.  AS_OF stands for the
# run instant.  A column that is present but null keeps its null.
AS_OF = object()
INSERT_DEFAULTS = {
    "channel_stats": {
        "total_views": 0,
        "subscriber_count": 0,
        "video_count": 0,
        "processed_at": AS_OF,
        "created_at": AS_OF,
    },
    "videos": {
        "status": "active",
        "current_interval_hours": 6,
        "created_at": AS_OF,
    },
    "view_timeseries": {
        "scraped_at": AS_OF,
        "view_count": 0,
        "like_count": 0,
        "comment_count": 0,
    },
    "video_trends": {
        "view_count": 0,
        "like_count": 0,
        "comment_count": 0,
        "captured_at": AS_OF,
    },
}

TABLES = {
    "channel_stats": CHANNEL_STATS,
    "videos": VIDEOS,
    "view_timeseries": VIEW_TIMESERIES,
    "video_trends": VIDEO_TRENDS,
}
PRIMARY_KEYS = {"channel_stats": "channel_id", "videos": "video_id"}
# child table -> (column, parent table)
FOREIGN_KEYS = {
    "videos": ("channel_id", "channel_stats"),
    "view_timeseries": ("video_id", "videos"),
}

NOT_NULL = {
    "channel_stats": (
        "channel_id",
        "channel_title",
        "total_views",
        "subscriber_count",
        "video_count",
        "processed_at",
        "created_at",
    ),
    "videos": (
        "video_id",
        "channel_id",
        "published_at",
        "status",
        "current_interval_hours",
        "created_at",
    ),
    "view_timeseries": (
        "video_id",
        "scraped_at",
        "view_count",
        "like_count",
        "comment_count",
    ),
    "video_trends": ("video_id", "channel_title", "title", "published_at", "captured_at"),
}

MAX_LENGTH = {
    "channel_stats": {
        "channel_id": 64,
        "channel_title": 255,
        "country": 10,
        "title": 255,
        "tier_category": 64,
        "uploads_playlist_id": 64,
    },
    "videos": {"video_id": 64, "channel_id": 64, "status": 16},
    "view_timeseries": {"video_id": 64},
    "video_trends": {
        "video_id": 64,
        "channel_title": 255,
        "project_category": 100,
        "youtube_category_id": 10,
        "live_broadcast_content": 50,
        "duration": 50,
        "dimension": 10,
        "definition": 10,
        "caption": 10,
        "projection": 20,
        "upload_status": 50,
        "privacy_status": 50,
    },
}

# column -> smallest allowed value; null passes, as in a SQL CHECK
LOWER_BOUND = {
    "channel_stats": {"total_views": 0, "subscriber_count": 0, "video_count": 0},
    "videos": {"current_interval_hours": 1},
    "view_timeseries": {"view_count": 0, "like_count": 0, "comment_count": 0},
    "video_trends": {},
}
DOMAIN = {"videos": {"status": VIDEO_STATUSES}}
