"""Upserts, folds, keyed updates, defaults and schema versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from statflow.catalog.fixtures import OBSERVED, OBSERVED_SQL, RUN, RUN_SQL, cte, fixture
from statflow.catalog.registry import ORACLES, Tables, query
from statflow.operators import merge, queue, shaping
from statflow.plans.publish import VersionedTable
from statflow.schemas import CHANNEL_STATS, CHANNEL_STATS_V1, VIDEOS
from statflow.session import scratch_path

_FOLDED_SQL = """folded as (select distinct channel_id,
    first_value(published_at) over w as published_at, first_value(country) over w as country,
    last_value(channel_title) over w as channel_title,
    last_value(channel_description) over w as channel_description,
    last_value(total_views) over w as total_views,
    last_value(subscriber_count) over w as subscriber_count,
    last_value(video_count) over w as video_count, last_value(processed_at) over w as processed_at
  from channel_obs window w as (partition by channel_id order by event_id
    rows between unbounded preceding and unbounded following))
"""


@query(
    "m4_fold_batch",
    cte("channel_obs") + "," + _FOLDED_SQL + "select * from folded",
)
def fold_batch(t: Tables):
    policy = merge.channel_policy(OBSERVED)
    return merge.fold_batch(
        fixture(t, "channel_obs"), "channel_id", ("event_id",), policy.first, policy.last
    )


def _upserted_sql(condition: str) -> str:
    return (
        cte("channel_obs", "channels")
        + ","
        + _FOLDED_SQL
        + f"""select coalesce(t.channel_id, s.channel_id) as channel_id,
      case when {condition} then s.channel_title else t.channel_title end as channel_title,
      case when {condition} then s.channel_description else t.channel_description end as channel_description,
      case when t.channel_id is null then s.published_at else t.published_at end as published_at,
      case when t.channel_id is null then s.country else t.country end as country,
      case when {condition} then s.total_views else t.total_views end as total_views,
      case when {condition} then s.subscriber_count else t.subscriber_count end as subscriber_count,
      case when {condition} then s.video_count else t.video_count end as video_count,
      case when {condition} then s.processed_at else t.processed_at end as processed_at,
      case when t.channel_id is null then {OBSERVED_SQL} else t.created_at end as created_at
    from channels t full join folded s on t.channel_id = s.channel_id"""
    )


@query("m1_upsert_channels", _upserted_sql("s.channel_id is not null"))
def upsert_channels(t: Tables):
    """Known channels keep country and publication; repeated keys fold by arrival."""
    return merge.upsert_channels(
        fixture(t, "channels"), fixture(t, "channel_obs"), OBSERVED, ("event_id",)
    )


@query(
    "m1_upsert_newer_only",
    cte("channel_obs")
    + """, target as (select channel_id, channel_title, timestamp '2024-01-15 12:00:00' as processed_at
      from (select *, row_number() over (partition by channel_id order by event_id) as nth from channel_obs)
      where nth = 1),
    batch as (select * from (select *, row_number() over (partition by channel_id
        order by processed_at desc, event_id * 7919 % 100003 desc) as nth
      from channel_obs where processed_at < timestamp '2024-01-15 00:00:00'
        or country is null) where nth = 1)
    select t.channel_id,
      case when s.processed_at >= t.processed_at then s.channel_title else t.channel_title end as channel_title,
      case when s.processed_at >= t.processed_at then s.processed_at else t.processed_at end as processed_at
    from target t left join batch s on t.channel_id = s.channel_id""",
)
def upsert_newer_only(t: Tables):
    """A batch of old snapshots, and new ones for channels without a country, in shuffled arrival."""
    observed = fixture(t, "channel_obs")
    oldest = merge.fold_batch(observed, "channel_id", ("event_id",), first=("channel_title",))
    target = oldest.withColumn("processed_at", F.lit("2024-01-15 12:00:00").cast("timestamp"))
    old = F.col("processed_at") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    return merge.upsert_channels(
        target,
        observed.where(old | F.col("country").isNull()).withColumn("arrival", F.col("event_id") * 7919 % 100003),
        OBSERVED,
        ("arrival",),
        newer_only=True,
    )


_CANDIDATES = [
    "cast(case when l_linenumber % 2 = 0 then l_orderkey else 1000000 + l_partkey end as string) as video_id",
    "cast(l_suppkey as string) as channel_id",
    "l_shipdate as published_at",
]


@query(
    "m2_upsert_queue",
    cte("videos")
    + f""", batch as (select video_id, channel_id, published_at from (
      select *, row_number() over (partition by video_id order by published_at desc, channel_id desc) as nth
      from (select {', '.join(_CANDIDATES)} from lineitem)) where nth = 1)
    select coalesce(t.video_id, s.video_id) as video_id,
      case when s.video_id is null then t.channel_id else s.channel_id end as channel_id,
      case when s.video_id is null then t.published_at else s.published_at end as published_at,
      case when s.video_id is null then t.status else 'active' end as status,
      case when s.video_id is null then t.last_polled_at else {RUN_SQL} end as last_polled_at,
      case when s.video_id is null then t.next_poll_at else {RUN_SQL} end as next_poll_at,
      cast(case when t.video_id is null then 1 else t.current_interval_hours end as int) as current_interval_hours,
      case when t.video_id is null then {RUN_SQL} else t.created_at end as created_at
    from videos t full join batch s on t.video_id = s.video_id""",
)
def upsert_queue(t: Tables):
    """Known videos wake up with their interval; new ones start hourly."""
    batch = t.view("lineitem", _CANDIDATES)
    return merge.upsert_queue(fixture(t, "videos"), batch, RUN, ("published_at", "channel_id"))


_MEASURED = [
    "cast(l_orderkey * 2 as string) as video_id",
    "l_shipdate + interval '40' hour as published_at",
]
_INTERVAL_SQL = f"""cast(case when epoch_us({RUN_SQL}) - epoch_us(published_at) < 24 * 3600000000 then 1
  when epoch_us({RUN_SQL}) - epoch_us(published_at) < 168 * 3600000000 then 6
  when epoch_us({RUN_SQL}) - epoch_us(published_at) < 720 * 3600000000 then 24
  else 168 end as int)"""


@query(
    "m3_apply_cadence",
    cte("videos")
    + f""", measured as (select video_id, max(published_at) as published_at
      from (select {', '.join(_MEASURED)} from lineitem) group by video_id),
    polls as (select video_id, {_INTERVAL_SQL} as hours from measured)
    select v.video_id, channel_id, published_at, status,
      case when p.video_id is null then last_polled_at else {RUN_SQL} end as last_polled_at,
      case when p.video_id is null then next_poll_at else {RUN_SQL} + to_hours(hours) end as next_poll_at,
      case when p.video_id is null then current_interval_hours else hours end as current_interval_hours,
      created_at
    from videos v left join polls p on v.video_id = p.video_id""",
)
def apply_cadence(t: Tables):
    """Half of the measured keys are in the queue; the others change nothing."""
    return merge.apply_cadence(fixture(t, "videos"), t.view("lineitem", _MEASURED), RUN)


@query(
    "j5_keyed_update",
    cte("videos")
    + """, updates as (select cast(l_orderkey as string) as video_id,
        case when max(l_linenumber) = 7 then null else 'archived' end as status
      from lineitem group by l_orderkey)
    select v.video_id, v.channel_id, v.published_at,
      case when u.video_id is null then v.status else u.status end as status,
      v.last_polled_at, v.next_poll_at, v.current_interval_hours, v.created_at
    from videos v left join updates u on v.video_id = u.video_id""",
)
def keyed_update(t: Tables):
    """A null in the update is written too."""
    updates = (
        t.raw("lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("video_id"))
        .agg(F.max("l_linenumber").alias("most"))
        .select("video_id", F.when(F.col("most") != 7, F.lit("archived")).alias("status"))
    )
    return merge.keyed_update(fixture(t, "videos"), updates, "video_id", ["status"])


def _published(t: Tables, name: str, schema, key: str) -> VersionedTable:
    table = VersionedTable(t.spark, scratch_path(t.spark, name), schema, key, 8)
    table.publish(fixture(t, name))
    return table


@query("m1_bucketed_channels", _upserted_sql("s.channel_id is not null"))
def bucketed_channels(t: Tables):
    """The same upsert into a published table, bucket by bucket."""
    table, batch = _published(t, "channels", CHANNEL_STATS_V1, "channel_id"), fixture(t, "channel_obs")
    table.update(batch, lambda rows: merge.upsert_channels(rows, batch, OBSERVED, ("event_id",)))
    return table.read()


@query("m2_bucketed_queue", ORACLES["m2_upsert_queue"])
def bucketed_queue(t: Tables):
    table, batch = _published(t, "videos", VIDEOS, "video_id"), t.view("lineitem", _CANDIDATES)
    table.update(batch, lambda rows: merge.upsert_queue(rows, batch, RUN, ("published_at", "channel_id")))
    return table.read()


@query("m3_bucketed_cadence", ORACLES["m3_apply_cadence"])
def bucketed_cadence(t: Tables):
    table, measured = _published(t, "videos", VIDEOS, "video_id"), t.view("lineitem", _MEASURED)
    table.update(measured, lambda rows: merge.apply_cadence(rows, measured, RUN))
    return table.read()


@query(
    "m3_few_buckets",
    cte("videos")
    + f""", changed as (select video_id from videos where video_id in ('1', '2', '3', '5', '7'))
    select video_id, channel_id, published_at, case when video_id in (select * from changed) then 'deleted' else status end as status,
      last_polled_at, next_poll_at, current_interval_hours, created_at from videos""",
)
def few_buckets(t: Tables):
    """Five keys at most: other buckets stay the files they are."""
    table = _published(t, "videos", VIDEOS, "video_id")
    keys = fixture(t, "videos").where(F.col("video_id").isin("1", "2", "3", "5", "7")).select("video_id")
    gone = keys.withColumn("status", F.lit("deleted"))
    before = table.current()
    after = table.update(keys, lambda rows: merge.keyed_update(rows, gone, "video_id", ["status"]))
    same = sum(after.folders[n] == folder for n, folder in before.folders.items())
    if same < len(before.folders) - 5:
        raise AssertionError(f"only {same} of {len(before.folders)} buckets were left alone")
    return table.read()


@query(
    "m5_publish",
    cte("videos")
    + f"""select video_id, channel_id, published_at, status, last_polled_at, next_poll_at,
      cast(case when next_poll_at <= {RUN_SQL} then 168 else current_interval_hours end as int)
        as current_interval_hours, created_at from videos""",
)
def publish(t: Tables):
    """A table is published, changed from its own published version, and published again."""
    table = _published(t, "videos", VIDEOS, "video_id")
    before = table.read()
    interval = F.when(F.col("next_poll_at") <= F.lit(RUN), F.lit(168))
    table.publish(
        before.withColumn(
            "current_interval_hours", interval.otherwise(F.col("current_interval_hours"))
        )
    )
    return table.read()


@query(
    "w6_insert_defaults",
    cte("seeds")
    + f"""select channel_id, channel_title, cast(null as varchar) as channel_description,
      cast(null as timestamp) as published_at, country, total_views, subscriber_count,
      cast(0 as bigint) as video_count, {RUN_SQL} as processed_at, {RUN_SQL} as created_at,
      cast(null as varchar) as title, cast(null as varchar) as tier_category, uploads_playlist_id,
      cast(null as timestamp) as last_checked_at from seeds""",
)
def insert_defaults(t: Tables):
    """Absent columns take their default; a null that is present stays."""
    return shaping.fill_defaults(fixture(t, "seeds"), "channel_stats", RUN)


@query(
    "w6_queue_defaults",
    cte("videos")
    + f"""select video_id, channel_id, published_at, 'active' as status,
      cast(null as timestamp) as last_polled_at, next_poll_at, cast(6 as int) as current_interval_hours,
      {RUN_SQL} as created_at from videos""",
)
def queue_defaults(t: Tables):
    given = fixture(t, "videos").select("video_id", "channel_id", "published_at", "next_poll_at")
    return shaping.fill_defaults(given, "videos", RUN)


@query(
    "w7_evolve_backfill",
    cte("channels", "seeds")
    + """select channel_id, channel_title, published_at, total_views, channel_title as title,
      cast(null as varchar) as tier_category, cast(null as varchar) as uploads_playlist_id,
      cast(null as timestamp) as last_checked_at from channels
    union all
    select concat('S', channel_id), channel_title, cast(null as timestamp), total_views,
      cast(null as varchar), cast(null as varchar), uploads_playlist_id, cast(null as timestamp) from seeds""",
)
def evolve_backfill(t: Tables):
    """Old rows gain four columns and a title once; rows that come later keep theirs null."""
    old = fixture(t, "channels").select(*CHANNEL_STATS_V1.names)
    stored = shaping.backfill(
        shaping.add_missing_columns(old, CHANNEL_STATS), "title", "channel_title"
    )
    later = fixture(t, "seeds").withColumn("channel_id", F.concat(F.lit("S"), "channel_id"))
    return shaping.union_versions([stored, later]).select(
        "channel_id",
        "channel_title",
        "published_at",
        "total_views",
        "title",
        "tier_category",
        "uploads_playlist_id",
        "last_checked_at",
    )


@query(
    "x2_union_versions",
    """select o_custkey as id, o_totalprice as amount, cast(null as int) as lines, o_orderpriority as note from orders
    union all select l_orderkey, l_extendedprice, l_linenumber, cast(null as varchar) from lineitem
    union all select c_custkey, cast(null as double), cast(null as int), c_name from customer""",
)
def union_versions(t: Tables):
    return shaping.union_versions(
        [
            t.raw("orders").selectExpr(
                "o_custkey as id", "o_totalprice as amount", "o_orderpriority as note"
            ),
            t.raw("lineitem").selectExpr(
                "l_linenumber as lines", "l_orderkey as id", "l_extendedprice as amount"
            ),
            t.raw("customer").selectExpr("c_name as note", "c_custkey as id"),
        ]
    )


@query(
    "x1_flatten_batches",
    cte("uploads")
    + """select uploads_playlist_id, video_id, published_at from uploads
    union all select uploads_playlist_id, video_id, published_at from uploads where position % 2 = 0""",
)
def flatten_batches(t: Tables):
    """Lists of at most fifty rows, even places twice, back to rows."""
    rows = fixture(t, "uploads")
    element = F.struct("uploads_playlist_id", "video_id", "published_at")
    twice = F.when(F.col("position") % 2 == 0, F.array(element, element)).otherwise(
        F.array(element)
    )
    batches = (
        rows.withColumn("twice", twice)
        .groupBy(F.expr("cast(video_id as bigint) div 50"))
        .agg(F.flatten(F.collect_list("twice")).alias("batch"))
    )
    return shaping.flatten_batches(batches, "batch")


@query(
    "q5_key_order_within_tasks",
    cte("videos") + "select video_id, status from videos",
)
def key_order(t: Tables):
    """Layout only: the rows are the same."""
    return queue.in_key_order(fixture(t, "videos").select("video_id", "status"))
