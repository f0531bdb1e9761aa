"""Constraints: checks, reports, orphans, cascades."""

from __future__ import annotations

from pyspark.sql import functions as F

from statflow.catalog.fixtures import RUN, cte, fixture
from statflow.catalog.registry import Tables, query
from statflow.operators import quality, shaping
from statflow.schemas import CHANNEL_SEED
from statflow.session import scratch_path
from statflow.sources.seeds import read_seeds

_DIRTY_CHANNELS = [
    "case when c_custkey % 50 = 7 then null else cast(c_custkey as string) end as channel_id",
    "case when c_custkey % 9 = 0 then null when c_custkey % 9 = 1 then repeat(c_name, 15)"
    " when c_custkey % 9 = 2 then repeat('ü', 255) else c_name end as channel_title",
    "case when c_custkey % 4 = 0 then null else concat(c_mktsegment, 'x') end as country",
    "case when c_custkey % 12 = 5 then null"
    " else cast(floor(c_acctbal * 100) as bigint) end as total_views",
    "cast(floor(c_acctbal) + 500 as bigint) as subscriber_count",
    "cast(c_custkey % 10 - 1 as bigint) as video_count",
    "timestamp '2001-08-01 12:00:00' as processed_at",
    "timestamp '2001-08-01 12:00:00' as created_at",
    "c_name as title",
    "cast(null as string) as tier_category",
    "repeat('u', cast(c_custkey % 80 as int)) as uploads_playlist_id",
]
_DIRTY_CHANNELS_CTE = f"with dirty as (select {', '.join(_DIRTY_CHANNELS)}, c_custkey from customer)\n"

# a third of the rows share one key
_DIRTY_VIDEOS = [
    "o_orderkey",
    "case when o_orderkey % 3 = 0 then 'hot' else cast(o_orderkey as string) end as video_id",
    "case when o_orderkey % 101 = 0 then null else cast(o_custkey as string) end as channel_id",
    "case when o_orderkey % 77 = 0 then null else o_orderdate end as published_at",
    "case o_orderstatus when 'O' then 'active' when 'F' then 'archived' else 'pending' end as status",
    "cast(o_orderkey % 40 - 1 as int) as current_interval_hours",
    "o_orderdate as created_at",
]
_DIRTY_VIDEOS_CTE = f"with dirty as (select {', '.join(_DIRTY_VIDEOS)} from orders)"
_PARENTS = ["cast(s_suppkey * 3 as string) as channel_id"]
_PARENTS_CTE = f", parents as (select {', '.join(_PARENTS)} from supplier)\n"


def dirty_channels(t: Tables):
    return t.view("customer", [*_DIRTY_CHANNELS, "c_custkey"])


def dirty_videos(t: Tables):
    return t.view("orders", _DIRTY_VIDEOS)


_RANGE_SQL = """select 'total_views:range' as rule, c_custkey as key from dirty where total_views < 0
  union all select 'subscriber_count:range', c_custkey from dirty where subscriber_count < 0
  union all select 'video_count:range', c_custkey from dirty where video_count < 0"""
_NULL_LENGTH_SQL = """select 'channel_id:not_null' as rule, c_custkey as key from dirty where channel_id is null
  union all select 'channel_title:not_null', c_custkey from dirty where channel_title is null
  union all select 'total_views:not_null', c_custkey from dirty where total_views is null
  union all select 'channel_title:length', c_custkey from dirty where length(channel_title) > 255
  union all select 'country:length', c_custkey from dirty where length(country) > 10
  union all select 'uploads_playlist_id:length', c_custkey from dirty where length(uploads_playlist_id) > 64"""


@query("v1_range_checks", _DIRTY_CHANNELS_CTE + _RANGE_SQL)
def range_checks(t: Tables):
    rules = quality.range_rules("channel_stats")
    return quality.violations(dirty_channels(t), "c_custkey", rules)


@query(
    "v1_interval_check",
    _DIRTY_VIDEOS_CTE
    + """ select 'current_interval_hours:range' as rule, o_orderkey as key from dirty
    where current_interval_hours <= 0""",
)
def interval_check(t: Tables):
    return quality.violations(dirty_videos(t), "o_orderkey", quality.range_rules("videos"))


@query(
    "v2_status_domain",
    _DIRTY_VIDEOS_CTE
    + """ select 'status:domain' as rule, o_orderkey as key from dirty
    where status not in ('active', 'archived', 'deleted')""",
)
def status_domain(t: Tables):
    return quality.violations(dirty_videos(t), "o_orderkey", quality.domain_rules("videos"))


@query("v3_nulls_and_lengths", _DIRTY_CHANNELS_CTE + _NULL_LENGTH_SQL)
def nulls_and_lengths(t: Tables):
    """Length counts characters, not bytes."""
    rules = [*quality.null_rules("channel_stats"), *quality.length_rules("channel_stats")]
    return quality.violations(dirty_channels(t), "c_custkey", rules)


_VIDEO_RULES_SQL = """rules as (
  select 'video_id:not_null' as rule, video_id as key from dirty where video_id is null
  union all select 'channel_id:not_null', video_id from dirty where channel_id is null
  union all select 'published_at:not_null', video_id from dirty where published_at is null
  union all select 'status:domain', video_id from dirty where status not in ('active', 'archived', 'deleted')
  union all select 'current_interval_hours:range', video_id from dirty where current_interval_hours < 1)
"""


@query(
    "v4_violation_report",
    _DIRTY_VIDEOS_CTE
    + _PARENTS_CTE
    + ", "
    + _VIDEO_RULES_SQL
    + """select rule, key, count(*) as n from rules group by rule, key
    union all select 'video_id:unique', video_id, count(*) from dirty group by video_id having count(*) > 1
    union all select 'channel_id:parent', channel_id, count(*) from dirty
      where channel_id is not null and channel_id not in (select channel_id from parents) group by channel_id""",
)
def violation_report(t: Tables):
    parents = t.view("supplier", _PARENTS)
    return quality.violation_report(
        dirty_videos(t),
        "videos",
        "video_id",
        unique=True,
        parent=("channel_id", parents, "channel_id"),
    )


_CLEAN_SQL = (
    _DIRTY_VIDEOS_CTE
    + _PARENTS_CTE
    + """, sound as (select * from dirty where video_id is not null and channel_id is not null
      and published_at is not null and status in ('active', 'archived', 'deleted')
      and current_interval_hours > 0 and channel_id in (select channel_id from parents)),
    held as (select video_id, min(o_orderkey) as first from sound group by video_id)
"""
)


@query(
    "v4_clean_rows",
    _CLEAN_SQL
    + """select s.* from sound s join held h on s.video_id = h.video_id and s.o_orderkey = h.first""",
)
def clean_rows(t: Tables):
    return quality.clean(_split(t))


@query(
    "v4_quarantined_rows",
    _CLEAN_SQL
    + """select d.*, case when d.o_orderkey in (select o_orderkey from sound) then 'video_id:unique' else 'row' end as why
    from dirty d where o_orderkey not in (select first from held)""",
)
def quarantined_rows(t: Tables):
    repeated = F.array_contains(quality.VIOLATED, "video_id:unique")
    why = F.when(repeated, F.lit("video_id:unique")).otherwise(F.lit("row"))
    return quality.quarantined(_split(t)).withColumn("why", why).drop(quality.VIOLATED)


def _split(t: Tables):
    parents = t.view("supplier", _PARENTS)
    return quality.with_all_violations(
        dirty_videos(t),
        "videos",
        key="video_id",
        order=("o_orderkey",),
        parent=("channel_id", parents, "channel_id"),
    )


@query(
    "a2_duplicate_keys",
    _DIRTY_VIDEOS_CTE
    + " select video_id, count(*) as n from dirty group by video_id having count(*) > 1",
)
def duplicate_keys(t: Tables):
    return quality.duplicate_keys(dirty_videos(t), "video_id")


@query(
    "a2_duplicate_snapshots",
    """select l_orderkey, count(*) as n from lineitem group by l_orderkey having count(*) > 1""",
)
def duplicate_snapshots(t: Tables):
    return quality.duplicate_keys(t.raw("lineitem"), "l_orderkey")


@query(
    "j3_fk_orphans",
    _DIRTY_VIDEOS_CTE
    + _PARENTS_CTE
    + """select o_orderkey, video_id, channel_id from dirty
    where channel_id is not null and channel_id not in (select channel_id from parents)""",
)
def fk_orphans(t: Tables):
    parents = t.view("supplier", _PARENTS)
    rows = dirty_videos(t).select("o_orderkey", "video_id", "channel_id")
    return quality.orphans(rows, "channel_id", parents, "channel_id")


@query(
    "j3_orphan_snapshots",
    """select cast(l_orderkey as string) as video_id, count(*) as n from lineitem
    where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
    group by l_orderkey""",
)
def orphan_snapshots(t: Tables):
    """Snapshots of videos that the queue no longer holds, counted per video."""
    videos = t.raw("orders").where("o_orderstatus <> 'P'")
    kept = videos.select(F.col("o_orderkey").cast("string").alias("video_id"))
    return quality.orphan_counts(fixture(t, "snapshots"), "video_id", kept, "video_id")


def _after_cascade(t: Tables):
    gone = t.raw("supplier").select((F.col("s_suppkey") * 2).cast("string").alias("channel_id"))
    channels = t.raw("customer").select(F.col("c_custkey").cast("string").alias("channel_id"))
    return quality.cascade_channels(
        gone, channels, fixture(t, "videos"), fixture(t, "snapshots")
    )


_GONE = "select cast(s_suppkey * 2 as string) from supplier"


@query(
    "j4_cascade_channels",
    f"""select cast(c_custkey as string) as channel_id from customer
    where cast(c_custkey as string) not in ({_GONE})""",
)
def cascade_channels(t: Tables):
    return _after_cascade(t)[0]


@query(
    "j4_cascade_videos",
    cte("videos") + f"select * from videos where channel_id not in ({_GONE})",
)
def cascade_videos(t: Tables):
    return _after_cascade(t)[1]


@query(
    "j4_cascade_snapshots",
    cte("videos", "snapshots")
    + f"""select * from snapshots
    where video_id not in (select video_id from videos where channel_id in ({_GONE}))""",
)
def cascade_snapshots(t: Tables):
    """Snapshots without a video stay; those of a deleted one go."""
    return _after_cascade(t)[2]


_SEED_CTE = cte("seeds")


def _read_back(t: Tables):
    path = scratch_path(t.spark, "seeds")
    rows = fixture(t, "seeds").select(*CHANNEL_SEED.names)
    (
        rows.write.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    filled = shaping.fill_defaults(read_seeds(t.spark, path), "channel_stats", RUN)
    return quality.check_rows(filled, quality.row_rules("channel_stats"))


@query(
    "s3_csv_seed",
    _SEED_CTE
    + """select channel_id, channel_title, country, total_views, subscriber_count,
      cast(0 as bigint) as video_count, uploads_playlist_id,
      timestamp '2001-08-01 12:00:00' as processed_at from seeds
    where subscriber_count is not null
      and (uploads_playlist_id is null or length(uploads_playlist_id) <= 64)""",
)
def csv_seed(t: Tables):
    """Seeds through a CSV file; an empty counter is null and breaks NOT NULL."""
    return quality.clean(_read_back(t)).select(
        "channel_id",
        "channel_title",
        "country",
        "total_views",
        "subscriber_count",
        "video_count",
        "uploads_playlist_id",
        "processed_at",
    )


@query(
    "s3_csv_rejects",
    _SEED_CTE
    + """select channel_id, 'subscriber_count:not_null' as rule from seeds where subscriber_count is null""",
)
def csv_rejects(t: Tables):
    rejected = quality.quarantined(_read_back(t))
    return rejected.select("channel_id", F.explode(quality.VIOLATED).alias("rule"))
