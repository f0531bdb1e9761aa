"""Written tables and streams, read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.catalog.figures import PLAIN_SQL
from statflow.catalog.fixtures import OBSERVED, OBSERVED_SQL, RUN, RUN_SQL, cte, fixture
from statflow.catalog.parsing import messages
from statflow.catalog.registry import Tables, query
from statflow.functions.instants import instant
from statflow.operators.merge import upsert_queue
from statflow.operators.parse import wire_frame
from statflow.plans.jobs import collect_snapshots, collect_trends, in_chunks, refresh_channels
from statflow.plans.publish import VersionedTable
from statflow.schemas import CHANNEL_STATS, CHANNEL_STATS_V1, VIDEO_TRENDS, VIDEOS, VIEW_TIMESERIES
from statflow.session import scratch_path
from statflow.sinks.series import TREND_DATE, append_series, read_series
from statflow.sources import landing
from statflow.sources.events import as_event_frame, read_event_files
from statflow.streaming import late, run
from statflow.streaming.sinks import AppendSink, FolderStore
from statflow.streaming.state import read_state, start_state


@query(
    "w4_append_series",
    cte("snapshots") + "select * from snapshots",
)
def series(t: Tables):
    """The series laid out by day and key; writing the run again adds nothing."""
    path = scratch_path(t.spark, "series")
    rows = fixture(t, "snapshots")
    for _ in range(2):
        append_series(rows, path, RUN)
    return read_series(t.spark, path, VIEW_TIMESERIES, RUN).select(*VIEW_TIMESERIES.names)


@query(
    "w5_collect_trends",
    cte("channel_lists", "uploads")
    + """select v.* from channel_lists c
    join (select *, row_number() over (partition by uploads_playlist_id order by position, video_id) as nth
      from uploads) u on c.uploads_playlist_id = u.uploads_playlist_id and u.nth <= 50
    join (select cast(p_partkey as varchar) as video_id, p_brand as channel_title, 'Data Science & AI' as project_category,
      p_name as title, p_type as description, timestamp '2001-01-01 00:00:00' as published_at,
      '' as thumbnail_url, cast([] as varchar[]) as tags, cast(null as varchar) as youtube_category_id, 'none' as live_broadcast_content,
      cast(p_size * 1000 as bigint) as view_count, cast(p_partkey as bigint) as like_count, cast(0 as bigint) as comment_count,
      'PT' || cast(p_size as varchar) || 'S' as duration, '' as dimension, p_brand as definition, '' as caption,
      p_partkey % 2 = 0 as licensed_content, '' as projection, cast([] as varchar[]) as topic_categories,
      'processed' as upload_status, '' as privacy_status, true as embeddable, p_partkey % 4 = 1 as public_stats_viewable,
      timestamp '2001-08-01 12:00:00' as captured_at from part where p_partkey % 9 <> 0) v on u.video_id = v.video_id""",
)
def trend_rows(t: Tables):
    """Channel lists to trend rows; items without a publication time are quarantined."""
    items = t.raw("part").selectExpr(
        "cast(p_partkey as string) as id",
        "map('title', p_name, 'channelTitle', p_brand, 'description', p_type, 'publishedAt',"
        " case when p_partkey % 9 = 0 then '' else '2001-01-01T00:00:00Z' end) as snippet",
        "map('viewCount', cast(p_size * 1000 as string), 'likeCount', cast(p_partkey as string)) as statistics",
        "map('duration', concat('PT', cast(p_size as string), 'S'), 'definition', p_brand,"
        " 'licensedContent', cast(p_partkey % 2 = 0 as string)) as contentDetails",
        "map('uploadStatus', 'processed', 'publicStatsViewable', cast(p_partkey % 4 = 1 as string)) as status",
        "cast(map() as map<string,string>) as topicDetails",
    )
    lists = fixture(t, "channel_lists")
    path = scratch_path(t.spark, "trends")
    collect_trends(lists, lists, fixture(t, "uploads"), items, path, RUN)
    return read_series(t.spark, path, VIDEO_TRENDS, RUN, TREND_DATE).select(*VIDEO_TRENDS.names)


@query(
    "flow2_refresh",
    f"""with items as (select *, case when c_custkey % 2 = 0 then 'hot' else cast(c_custkey as varchar) end as id
      from customer),
    good as (select * from items where c_custkey % 8 <> 3),
    folded as (select distinct id, first_value(substring(c_mktsegment, 1, 10)) over w as country,
      last_value(c_name) over w as channel_title,
      last_value(cast(c_custkey * 1000 as bigint)) over w as total_views
      from good window w as (partition by id order by c_custkey
        rows between unbounded preceding and unbounded following))
    select id as channel_id, channel_title, '' as channel_description, cast(null as timestamp) as published_at, country,
      total_views, cast(0 as bigint) as subscriber_count, cast(0 as bigint) as video_count,
      {OBSERVED_SQL} as processed_at, {OBSERVED_SQL} as created_at, cast(null as varchar) as title,
      cast(null as varchar) as tier_category, cast(null as varchar) as uploads_playlist_id,
      cast(null as timestamp) as last_checked_at from folded""",
)
def refresh(t: Tables):
    """API objects into an empty channel table; an unreadable counter is quarantined."""
    items = t.raw("customer").selectExpr(
        "c_custkey as arrival",
        "case when c_custkey % 2 = 0 then 'hot' else cast(c_custkey as string) end as id",
        "map('title', c_name, 'country', substring(c_mktsegment, 1, 10)) as snippet",
        "map('viewCount', case when c_custkey % 8 = 3 then 'many'"
        " else cast(c_custkey * 1000 as string) end) as statistics",
    )
    table = VersionedTable(t.spark, scratch_path(t.spark, "channels"), CHANNEL_STATS, "channel_id", 8)
    refresh_channels(items, table, OBSERVED, ("arrival",))
    return table.read()


_MEASURED = "cast(v.video_id as bigint) % 13 <> 0"


def _counters(due, factor: int):
    number = F.col("video_id").cast("bigint")
    return due.select(
        "video_id",
        (number * factor).alias("view_count"),
        (number * 3).alias("like_count"),
        number.alias("comment_count"),
    )


def _video_queue(t: Tables) -> VersionedTable:
    table = VersionedTable(t.spark, scratch_path(t.spark, "queue"), VIDEOS, "video_id", 8)
    table.publish(fixture(t, "videos"))
    return table


def _collected(t: Tables):
    table, path = _video_queue(t), scratch_path(t.spark, "series")
    number = F.col("video_id").cast("bigint")
    collect_snapshots(table, lambda due: _counters(due.where(number % 13 != 0), 25), path, RUN)
    return table, path


def _collected_again(t: Tables):
    """A run that answers in parts: the second attempt gives other counters, for what is left."""
    table, path = _video_queue(t), scratch_path(t.spark, "series")
    number = F.col("video_id").cast("bigint")
    collect_snapshots(table, lambda due: _counters(due.where(number % 5 != 0), 25), path, RUN)
    collect_snapshots(table, lambda due: _counters(due.where(number % 13 != 0), 40), path, RUN)
    return table, path


@query(
    "flow3_collect_series",
    cte("videos")
    + f"""select video_id, {RUN_SQL} as scraped_at, cast(video_id as bigint) * 25 as view_count,
      cast(video_id as bigint) * 3 as like_count, cast(video_id as bigint) as comment_count
    from videos v where next_poll_at <= {RUN_SQL} and {_MEASURED}""",
)
def collected_series(t: Tables):
    _, path = _collected(t)
    return read_series(t.spark, path, VIEW_TIMESERIES, RUN).select(*VIEW_TIMESERIES.names)


_HOURS_SQL = f"""cast(case when epoch_us({RUN_SQL}) - epoch_us(published_at) < 24 * 3600000000 then 1
  when epoch_us({RUN_SQL}) - epoch_us(published_at) < 168 * 3600000000 then 6
  when epoch_us({RUN_SQL}) - epoch_us(published_at) < 720 * 3600000000 then 24 else 168 end as int)"""


def _moved_sql(measured: str) -> str:
    """The queue after a run that measured the due videos of a condition."""
    return f""", polled as (select *, coalesce(next_poll_at <= {RUN_SQL} and {measured}, false) as hit, {_HOURS_SQL} as hours from videos v)
    select video_id, channel_id, published_at, status, case when hit then {RUN_SQL} else last_polled_at end as last_polled_at,
      case when hit then {RUN_SQL} + to_hours(hours) else next_poll_at end as next_poll_at,
      case when hit then hours else current_interval_hours end as current_interval_hours, created_at
    from polled"""


@query("flow3_collect_queue", cte("videos") + _moved_sql(_MEASURED))
def collected_queue(t: Tables):
    """Measured videos move on; due ones that could not be read stay due."""
    table, _ = _collected(t)
    return table.read()


@query(
    "flow3_collect_chunks",
    cte("videos")
    + f""", due as (select video_id, (row_number() over (order by next_poll_at, video_id) - 1) // 50 as chunk,
        next_poll_at from videos where next_poll_at <= {RUN_SQL}),
    asked as (select video_id, count(*) over w as size, first_value(video_id) over (partition by chunk order by next_poll_at, video_id) as head
      from due window w as (partition by chunk))
    select video_id, {RUN_SQL} as scraped_at, size as view_count, cast(head as bigint) as like_count,
      cast(video_id as bigint) as comment_count
    from asked v where {_MEASURED}""",
)
def collected_chunks(t: Tables):
    """Requests of fifty in due order; each answer says how many were asked with it, and which came first."""

    class Counting:
        def fetch(self, keys):
            return [
                {"video_id": key, "view_count": len(keys), "like_count": int(keys[0]), "comment_count": int(key)}
                for key in keys
                if int(key) % 13
            ]

    table, path = _video_queue(t), scratch_path(t.spark, "series")
    collect_snapshots(table, in_chunks(Counting, senders=5), path, RUN)
    return read_series(t.spark, path, VIEW_TIMESERIES, RUN).select(*VIEW_TIMESERIES.names)


_ANSWERED = "(cast(v.video_id as bigint) % 5 <> 0 or cast(v.video_id as bigint) % 13 <> 0)"


@query(
    "flow3_collect_repeated_series",
    cte("videos")
    + f"""select video_id, {RUN_SQL} as scraped_at,
      cast(video_id as bigint) * case when cast(video_id as bigint) % 5 <> 0 then 25 else 40 end as view_count,
      cast(video_id as bigint) * 3 as like_count, cast(video_id as bigint) as comment_count
    from videos v where next_poll_at <= {RUN_SQL} and {_ANSWERED}""",
)
def repeated_series(t: Tables):
    _, path = _collected_again(t)
    return read_series(t.spark, path, VIEW_TIMESERIES, RUN).select(*VIEW_TIMESERIES.names)


@query("flow3_collect_repeated_queue", cte("videos") + _moved_sql(_ANSWERED))
def repeated_queue(t: Tables):
    table, _ = _collected_again(t)
    return table.read()


@query(
    "m5_concurrent_merge",
    cte("videos")
    + _moved_sql(_MEASURED)
    + f"""
    union all
    select video_id, channel_id, published_at, 'active', {RUN_SQL}, {RUN_SQL}, cast(1 as int), {RUN_SQL} from (
      select *, row_number() over (partition by video_id order by published_at desc, channel_id desc) as nth
      from (select concat('n', cast(l_partkey as varchar)) as video_id, cast(l_suppkey as varchar) as channel_id,
        l_shipdate as published_at from lineitem)) where nth = 1""",
)
def concurrent_merge(t: Tables):
    """Uploads are ingested while a collection measures: both effects stay."""
    table, path = _video_queue(t), scratch_path(t.spark, "series")
    names = ("concat('n', cast(l_partkey as string)) as video_id", "cast(l_suppkey as string) as channel_id", "l_shipdate as published_at")
    found = t.view("lineitem", list(names))

    def measure(due):
        table.update(found, lambda rows: upsert_queue(rows, found, RUN, ("published_at", "channel_id")))
        return _counters(due.where(F.col("video_id").cast("bigint") % 13 != 0), 25)

    collect_snapshots(table, measure, path, RUN)
    return table.read()


def _land(t: Tables, frame, label: str) -> str:
    path = scratch_path(t.spark, label)
    frame.write.parquet(path)
    return path


def _dealt(t: Tables):
    """The observations dealt over all tasks, as a topic deals messages over its partitions.

    The table is ordered by time: without this a delivery, which is a span of time, is written and then read
    by the few tasks that hold its days."""
    return fixture(t, "channel_obs").repartition("event_id")


def _sent(t: Tables):
    """Messages with their time beside them, so that a delivery writes the JSON of its own rows only."""
    return wire_frame(_dealt(t).drop("event_id"), carry=[F.col("processed_at").alias("at")])


def _delivered_twice(t: Tables):
    """Every snapshot of the source, those of some channels delivered again later."""
    sent = _sent(t)
    again = sent.where(F.col("key").like("%1")).withColumn("at", F.expr("at + interval 2 hours"))
    return as_event_frame(sent.unionByName(again), "key", "value", "at")


@query(
    "t4_stream_snapshots",
    cte("channel_obs")
    + f"""select channel_id, channel_title, country, total_views, processed_at, {PLAIN_SQL}
    from channel_obs""",
)
def stream_snapshots(t: Tables):
    """Messages, some delivered twice, through the streaming job into an append-only sink."""
    source, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "checkpoint")
    store = FolderStore(scratch_path(t.spark, "sink"))
    sink = AppendSink(store, "channel_stats_stream", "snapshots")
    frame = _delivered_twice(t)
    at = F.dayofmonth(F.get_json_object(F.col("value").cast("string"), "$.processed_at").cast("timestamp"))
    for third in (at <= 10, (at > 10) & (at <= 20), at > 20):
        frame.where(third).write.mode("append").parquet(source)
        enriched = run.snapshots(read_event_files(t.spark, source))
        run.start(enriched, sink, checkpoint, trigger=None).awaitTermination()
    return sink.read(t.spark, enriched.schema).select(
        "channel_id",
        "channel_title",
        "country",
        "total_views",
        "processed_at",
        "avg_views_per_video",
        "views_per_subscriber",
        "engagement_ratio",
        "size_tier",
    )


@query(
    "t4_batch_twin",
    cte("channel_obs")
    + f"""select channel_id, channel_title, country, total_views, processed_at, {PLAIN_SQL}
    from channel_obs""",
)
def batch_snapshots(t: Tables):
    """The same transforms on the same messages, as one batch."""
    return run.snapshots(_delivered_twice(t)).select(
        "channel_id",
        "channel_title",
        "country",
        "total_views",
        "processed_at",
        "avg_views_per_video",
        "views_per_subscriber",
        "engagement_ratio",
        "size_tier",
    )


_STATE_SQL = """, usable as (select * from channel_obs where event_id % 10 in (0, 1, 2, 9)),
folded as (select distinct channel_id,
    first_value(published_at) over w as published_at, first_value(country) over w as country,
    last_value(channel_title) over w as channel_title,
    last_value(channel_description) over w as channel_description,
    last_value(total_views) over w as total_views,
    last_value(subscriber_count) over w as subscriber_count,
    last_value(video_count) over w as video_count, last_value(processed_at) over w as processed_at
  from usable window w as (partition by channel_id order by processed_at
    rows between unbounded preceding and unbounded following))
select * from folded"""


@query("t5_stream_state", cte("channel_obs") + _STATE_SQL)
def stream_state(t: Tables):
    """Messages in three deliveries, good and broken, each by a new start from the checkpoint."""
    rows = messages(_dealt(t)).withColumn("day", F.dayofmonth("timestamp"))
    source, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "checkpoint")
    day = F.col("day")
    for third in (day <= 10, (day > 10) & (day <= 20), day > 20):
        rows.where(third).drop("day").write.mode("append").parquet(source)
        distinct = run.snapshots(read_event_files(t.spark, source))
        start_state(distinct, checkpoint, trigger=None).awaitTermination()
    return read_state(t.spark, checkpoint).drop("created_at")


_FIRSTS = [
    "concat('c', cast(s_suppkey as string)) as channel_id",
    "s_name as channel_title",
    "cast(null as string) as channel_description",
    "cast(null as timestamp) as published_at",
    "substring(s_name, 1, 2) as country",
    "cast(s_suppkey * 100 as bigint) as total_views",
    "cast(s_suppkey as bigint) as subscriber_count",
    "cast(s_nationkey as bigint) as video_count",
    "timestamp '2024-01-01 00:00:00' + interval '1' second * (s_suppkey % 50) as processed_at",
]


def _distinct_channels(t: Tables, mode: str):
    """A first delivery with one snapshot per channel, then newer ones of the same channels."""
    source, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "checkpoint")
    sink = AppendSink(FolderStore(scratch_path(t.spark, "sink")), "firsts", mode)
    first = t.raw("supplier").selectExpr(*_FIRSTS)
    newer = first.withColumns({"channel_title": F.lit("newer"), "processed_at": F.expr("processed_at + interval 60 seconds")})
    for rows in (first, newer):
        sent = wire_frame(rows).withColumn("at", F.get_json_object("value", "$.processed_at").cast("timestamp"))
        as_event_frame(sent, "key", "value", "at").write.mode("append").parquet(source)
        kept = run.snapshots(read_event_files(t.spark, source), mode)
        run.start(kept, sink, checkpoint, trigger=None).awaitTermination()
    return sink.read(t.spark, kept.schema).select(*CHANNEL_STATS_V1.names[:-1])


_CHANNELS_SEEN = f"select {', '.join(_FIRSTS)} from supplier".replace("as string", "as varchar")


@query("t2_stream_first_ever", _CHANNELS_SEEN)
def stream_first_ever(t: Tables):
    """One snapshot per channel, whatever follows."""
    return _distinct_channels(t, "first_ever")


@query("t3_stream_within_watermark", _CHANNELS_SEEN)
def stream_within_watermark(t: Tables):
    """One snapshot per channel while its state is held."""
    return _distinct_channels(t, "within_watermark")


@query(
    "t6_stream_late_rows",
    cte("channel_obs")
    + """select channel_id, processed_at,
      (select count(*) from channel_obs where dayofmonth(processed_at) <= 15) as late
    from channel_obs where dayofmonth(processed_at) > 15""",
)
def stream_late_rows(t: Tables):
    """The second half of the month arrives first; what comes later is dropped, and counted."""
    frame = as_event_frame(_sent(t), "key", "value", "at")
    source, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "checkpoint")
    sink = AppendSink(FolderStore(scratch_path(t.spark, "sink")), "snapshots", "late")
    dropped = 0
    for half in (F.dayofmonth("timestamp") > 15, F.dayofmonth("timestamp") <= 15):
        frame.where(half).write.mode("append").parquet(source)
        distinct = run.snapshots(read_event_files(t.spark, source))
        started = run.start(distinct, sink, checkpoint, trigger=None)
        started.awaitTermination()
        dropped += run.late_rows(json.loads(p.json) for p in started.recentProgress)
    stored = sink.read(t.spark, distinct.schema).select("channel_id", "processed_at")
    return stored.withColumn("late", F.lit(dropped).cast("bigint"))


_FIRST_HALF_LATE = """select channel_id, processed_at, total_views,
      (select epoch_us(max(processed_at)) // 1000 - 600000 from channel_obs where dayofmonth(processed_at) > 15)
        - epoch_us(processed_at) // 1000 as late_ms
    from channel_obs where dayofmonth(processed_at) <= 15"""


def _halves(t: Tables):
    """The second half of the month first, then all of it: half of that is late, half is delivered again."""
    frame = as_event_frame(_sent(t), "key", "value", "at")
    source, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "checkpoint")
    sink = AppendSink(FolderStore(scratch_path(t.spark, "sink")), "snapshots", "halves")
    for delivery in (F.dayofmonth("timestamp") > 15, F.lit(True)):
        frame.where(delivery).write.mode("append").parquet(source)
        rows = late.snapshots_with_candidates(read_event_files(t.spark, source))
        run.start(rows, late.keeping_late(sink, checkpoint), checkpoint, trigger=None).awaitTermination()
    kept = T.StructType([f for f in rows.schema.fields if f.name != late.CANDIDATE])
    return sink.read(t.spark, kept.add(late.LATE_MS, T.LongType()))


@query("t6_late_table", cte("channel_obs") + _FIRST_HALF_LATE)
def late_table(t: Tables):
    """Every late snapshot with its distance to the watermark of its batch; redelivered ones are not among them."""
    return late.lost(_halves(t)).select("channel_id", "processed_at", "total_views", late.LATE_MS)


@query(
    "t6_late_completed",
    cte("channel_obs") + "select channel_id, processed_at, total_views from channel_obs",
)
def late_completed(t: Tables):
    """What came on time and what came only late are the whole series."""
    stored = _halves(t)
    columns = ("channel_id", "processed_at", "total_views")
    return late.on_time(stored).select(*columns).unionByName(late.lost(stored).select(*columns))


# the API object of an order, and what the second delivery adds to it
_OBJECT = "'id', o_orderkey, 'snippet', named_struct('title', concat('Ü ', o_orderstatus), 'publishedAt', cast(o_orderdate as string){more})"
_ADDED = ", 'audience', named_struct('paid', o_totalprice, 'segment', o_orderpriority)"


def _landed(t: Tables):
    """Replies of one customer each, in two deliveries; the second has one more object in each snippet."""
    zone, checkpoint = scratch_path(t.spark, "landing"), scratch_path(t.spark, "checkpoint")
    sink = AppendSink(FolderStore(scratch_path(t.spark, "sink")), "items", "landing")
    orders = t.raw("orders")
    for odd in (0, 1):
        made = f"named_struct({_OBJECT.format(more=_ADDED if odd else '')})"
        items = orders.where(F.col("o_orderkey") % 2 == odd).groupBy("o_custkey").agg(F.collect_list(F.expr(made)).alias("items"))
        replies = items.select(F.to_json(F.struct("items")).alias("value"))
        broken = items.where("o_custkey % 10 = 0").select(F.concat(F.lit('{"items": ['), F.col("o_custkey").cast("string")))
        replies.union(broken).write.mode("append").text(zone)
        landed = landing.landed_items(landing.stream_replies(t.spark, zone))
        run.start(landed, sink, checkpoint, trigger=None).awaitTermination()
    return sink.read(t.spark, landing.LANDED)


@query(
    "s4_landed_items",
    """select cast(o_orderkey as varchar) as id, concat('Ü ', o_orderstatus) as title, cast(o_orderdate as date) as day,
      case when o_orderkey % 2 = 1 then o_totalprice end as paid,
      case when o_orderkey % 2 = 1 then o_orderpriority end as segment
    from orders""",
)
def landed_fields(t: Tables):
    """Each object once, with fields that only the second delivery has."""
    fields = {
        "title": ("$.snippet.title", "string"),
        "day": ("$.snippet.publishedAt", "date"),
        "paid": ("$.snippet.audience.paid", "double"),
        "segment": ("$.snippet.audience.segment", "string"),
    }
    return landing.typed(_landed(t), fields).drop(landing.FILE)


@query(
    "s4_landed_field_names",
    """select 'title' as name, count(*) as n from orders union all select 'publishedAt', count(*) from orders
    union all select 'audience', count(*) from orders where o_orderkey % 2 = 1 having count(*) > 0""",
)
def landed_field_names(t: Tables):
    return landing.field_names(_landed(t), "$.snippet").select("name", "n")
