"""Ratios, tiers, ages, leaderboards and selections."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from statflow.catalog.fixtures import OBSERVED, OBSERVED_SQL, RUN, RUN_SQL, cte, fixture
from statflow.catalog.registry import Tables, query
from statflow.functions import ratios
from statflow.functions.instants import elapsed_days, instant
from statflow.operators import boards, enrich
from statflow.operators.merge import fold_batch

TIER_SQL = """case when subscriber_count >= 1000000 then 'Mega (1M+)'
  when subscriber_count >= 100000 then 'Large (100K–1M)'
  when subscriber_count >= 10000 then 'Mid (10K–100K)'
  when subscriber_count >= 1000 then 'Small (1K–10K)' else 'Micro (<1K)' end"""

PLAIN_SQL = f"""
  case when video_count > 0 then total_views::double / video_count else 0.0 end::double as avg_views_per_video,
  case when subscriber_count > 0 then total_views::double / subscriber_count else 0.0 end::double as views_per_subscriber,
  case when total_views > 0 then subscriber_count::double / total_views * 100 else 0.0 end::double as engagement_ratio,
  {TIER_SQL} as size_tier"""

ROUNDED_SQL = f"""
  case when video_count > 0 then round(total_views::double / video_count, 2) else 0.0 end::double as avg_views_per_video,
  case when subscriber_count > 0 then round(total_views::double / subscriber_count, 4) else 0.0 end::double as views_per_subscriber,
  case when total_views > 0 then round(subscriber_count::double / total_views * 100, 6) else 0.0 end::double as engagement_ratio,
  {TIER_SQL} as size_tier"""

NEWEST_SQL = """newest as (select * exclude (nth) from (
  select *, row_number() over (partition by channel_id order by event_id desc) as nth
  from channel_obs) where nth = 1)
"""


def _ratio_sql(name: str, top: str, bottom: str, factor: int, digits: int) -> str:
    ratio = f"{top}::double / {bottom} * {factor}"
    return cte("channel_obs") + f"""select event_id,
      case when {bottom} > 0 then {ratio} else 0 end::double as {name},
      case when {bottom} > 0 then round({ratio}, {digits}) else 0 end::double as {name}_rounded
    from channel_obs"""


def _ratio(t: Tables, name: str, function, top: str, bottom: str):
    top, bottom = F.col(top), F.col(bottom)
    return fixture(t, "channel_obs").select(
        "event_id",
        function(top, bottom).alias(name),
        function(top, bottom, rounded=True).alias(f"{name}_rounded"),
    )


@query(
    "p10_avg_views_per_video",
    _ratio_sql("avg_views_per_video", "total_views", "video_count", 1, 2),
)
def avg_views_per_video(t: Tables):
    function = ratios.avg_views_per_video
    return _ratio(t, "avg_views_per_video", function, "total_views", "video_count")


@query(
    "p11_views_per_subscriber",
    _ratio_sql("views_per_subscriber", "total_views", "subscriber_count", 1, 4),
)
def views_per_subscriber(t: Tables):
    function = ratios.views_per_subscriber
    return _ratio(t, "views_per_subscriber", function, "total_views", "subscriber_count")


@query(
    "p12_engagement_ratio",
    _ratio_sql("engagement_ratio", "subscriber_count", "total_views", 100, 6),
)
def engagement_ratio(t: Tables):
    function = ratios.engagement_ratio
    return _ratio(t, "engagement_ratio", function, "subscriber_count", "total_views")


@query(
    "p13_size_tier",
    cte("channels") + f"select channel_id, {TIER_SQL} as size_tier from channels",
)
def size_tier(t: Tables):
    return fixture(t, "channels").select(
        "channel_id", ratios.size_tier(F.col("subscriber_count")).alias("size_tier")
    )


@query(
    "p14_channel_age_days",
    cte("channel_obs")
    + f"""select event_id, cast(datesub('day', published_at, {OBSERVED_SQL}) as int) as age,
      cast(datesub('day', {OBSERVED_SQL}, published_at) as int) as age_before,
      cast(datesub('day', processed_at, timestamp '2024-01-15 11:00:00') as int) as age_mixed
    from channel_obs""",
)
def channel_age(t: Tables):
    """Ages long after, before, and around the run instant."""
    at = instant(OBSERVED)
    return fixture(t, "channel_obs").select(
        "event_id",
        elapsed_days(F.col("published_at"), at).alias("age"),
        elapsed_days(at, F.col("published_at")).alias("age_before"),
        elapsed_days(F.col("processed_at"), instant("2024-01-15T11:00:00")).alias("age_mixed"),
    )


@query(
    "p18_enriched_view",
    cte("channels")
    + f"""select channel_id, channel_title, channel_description, published_at, country,
      total_views, subscriber_count, video_count, processed_at, created_at, {ROUNDED_SQL},
      cast(datesub('day', published_at, {RUN_SQL}) as int) as channel_age_days
    from channels""",
)
def enriched_view(t: Tables):
    return enrich.enriched_view(fixture(t, "channels"), RUN)


@query(
    "p18_engagement_stream_form",
    cte("channel_obs")
    + f"""select event_id, channel_id, channel_title, channel_description, published_at, country,
      total_views, subscriber_count, video_count, processed_at, {PLAIN_SQL} from channel_obs""",
)
def engagement(t: Tables):
    """The unrounded figures, as the streaming job and the batch enrichment give them."""
    return enrich.with_engagement(fixture(t, "channel_obs"))


def newest_per_channel(t: Tables):
    observed = fixture(t, "channel_obs")
    rest = [name for name in observed.columns if name != "channel_id"]
    return fold_batch(observed, "channel_id", ("event_id",), last=rest)


@query(
    "q1_leaderboard",
    cte("channel_obs")
    + ","
    + NEWEST_SQL
    + f"""select channel_id, channel_title, subscriber_count, engagement_ratio, size_tier
    from (select channel_id, channel_title, subscriber_count, {ROUNDED_SQL} from newest)
    order by subscriber_count desc nulls last, channel_id limit 10""",
)
def top_channels(t: Tables):
    """Ten largest channels by subscribers, from the newest snapshot of each."""
    current = newest_per_channel(t).withColumn("created_at", F.col("processed_at"))
    view = enrich.enriched_view(current, OBSERVED)
    return boards.leaderboard(view, "subscriber_count").select(
        "channel_id", "channel_title", "subscriber_count", "engagement_ratio", "size_tier"
    )


@query(
    "q2_views_leaderboard",
    cte("channels")
    + """select channel_id, channel_title, total_views from channels
    order by total_views desc nulls last, channel_id limit 25""",
)
def top_by_views(t: Tables):
    return boards.leaderboard(fixture(t, "channels"), "total_views", 25).select(
        "channel_id", "channel_title", "total_views"
    )


@query(
    "q2_most_recent",
    cte("channels")
    + """select channel_id, processed_at from channels
    order by processed_at desc nulls last, channel_id limit 25""",
)
def most_recent(t: Tables):
    return boards.leaderboard(fixture(t, "channels"), "processed_at", 25).select(
        "channel_id", "processed_at"
    )


@query(
    "f3_country",
    cte("channel_obs") + "select event_id, channel_id from channel_obs where country = 'click'",
)
def one_country(t: Tables):
    return boards.in_country(fixture(t, "channel_obs"), "click").select("event_id", "channel_id")


@query(
    "f4_stale",
    cte("channels")
    + """select channel_id, processed_at from channels
    where processed_at < timestamp '2001-06-01 12:00:00' - interval '6' hour""",
)
def stale_channels(t: Tables):
    channels = fixture(t, "channels")
    return boards.stale(channels, "2001-06-01T12:00:00", timedelta(hours=6)).select(
        "channel_id", "processed_at"
    )
