"""Lookup chain, latest rows, growth, ledger, run metrics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.catalog.fixtures import RUN, RUN_SQL, cte, fixture
from statflow.catalog.registry import Tables, query
from statflow.functions.instants import instant
from statflow.operators import ledger, lookup, trends
from statflow.sinks.metrics import run_metrics
from statflow.sources import replies as replies_

# asked for: every second channel, far beyond those that exist, and some of them twice
_IDS_CTE = """, ids as (select cast(c_custkey * 2 as string) as channel_id from customer
  union all select cast(s_suppkey as string) from supplier),
details as (select cast(l_orderkey as string) as video_id, max(l_linenumber) as lines,
  count(*) as n from lineitem group by l_orderkey),
page as (select * exclude (nth) from (select *, row_number() over (partition by uploads_playlist_id
  order by position, video_id) as nth from uploads) where nth <= 50)
"""


def _chain(t: Tables):
    asked = t.raw("customer").select((F.col("c_custkey") * 2).cast("string").alias("channel_id"))
    again = t.raw("supplier").select(F.col("s_suppkey").cast("string").alias("channel_id"))
    details = (
        t.raw("lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("video_id"))
        .agg(F.max("l_linenumber").alias("lines"), F.count("*").alias("n"))
    )
    channels, uploads = fixture(t, "channel_lists"), fixture(t, "uploads")
    return asked.unionByName(again), channels, uploads, details


@query(
    "j1_lookup_chain",
    cte("channel_lists", "uploads")
    + _IDS_CTE
    + """select i.channel_id, c.uploads_playlist_id, p.position, p.video_id, d.lines, d.n
    from ids i join channel_lists c on i.channel_id = c.channel_id
    join page p on c.uploads_playlist_id = p.uploads_playlist_id
    join details d on p.video_id = d.video_id""",
)
def lookup_chain(t: Tables):
    return lookup.lookup_chain(*_chain(t)).select(
        "channel_id", "uploads_playlist_id", "position", "video_id", "lines", "n"
    )


@query(
    "j2_dropped_keys",
    cte("channel_lists", "uploads")
    + _IDS_CTE
    + """, found as (select i.channel_id, c.uploads_playlist_id from ids i
      join channel_lists c on i.channel_id = c.channel_id)
    select 'channel_not_found' as reason, channel_id, cast(null as varchar) as video_id from ids
      where channel_id not in (select channel_id from channel_lists)
    union all select 'no_uploads', channel_id, null from found
      where uploads_playlist_id not in (select uploads_playlist_id from uploads)
    union all select 'no_details', f.channel_id, p.video_id from found f
      join page p on f.uploads_playlist_id = p.uploads_playlist_id
      where p.video_id not in (select video_id from details)""",
)
def dropped_keys(t: Tables):
    return lookup.dropped_keys(*_chain(t))


@query(
    "j1_from_replies",
    cte("uploads")
    + """, ids as (select cast(c_custkey as varchar) as channel_id, c_custkey % 5 as kind from customer),
    lists as (select channel_id, 'UU' || channel_id as uploads_playlist_id from ids where kind > 1)
    select l.channel_id, l.uploads_playlist_id, cast(nth - 1 as int) as position, video_id from lists l
    join (select uploads_playlist_id, video_id,
        row_number() over (partition by uploads_playlist_id order by position, video_id) as nth from uploads) u
      on l.uploads_playlist_id = u.uploads_playlist_id where nth <= 50""",
)
def chain_from_replies(t: Tables):
    """Raw replies of both kinds to the inputs of the lookup; the first item of a detail counts."""
    replies = t.raw("customer").selectExpr(
        "cast(c_custkey as string) as channel_id",
        """case c_custkey % 5 when 0 then '{"items": []}' when 1 then '{"error": {}}' else
        concat('{"items": [{"contentDetails": {"relatedPlaylists": {"uploads": "UU', c_custkey,
          '"}}}, {"contentDetails": {"relatedPlaylists": {"uploads": "other"}}}]}') end as reply""",
    )
    lists = replies_.uploads_lists(replies, "reply", "channel_id")
    order = F.sort_array(F.collect_list(F.struct("position", "video_id")))
    pages = fixture(t, "uploads").groupBy("uploads_playlist_id").agg(order.alias("page"))
    item = "named_struct('contentDetails', named_struct('videoId', p.video_id))"
    pages = pages.selectExpr(
        "uploads_playlist_id", f"to_json(named_struct('items', transform(slice(page, 1, 60), p -> {item}))) as reply"
    )
    uploads = replies_.uploads_positions(pages, "reply", "uploads_playlist_id")
    asked = lists.select("channel_id", "uploads_playlist_id")
    return asked.join(lookup.first_page(uploads, asked), "uploads_playlist_id").select(
        "channel_id", "uploads_playlist_id", "position", "video_id"
    )


@query(
    "n1_latest_videos",
    cte("uploads")
    + """select uploads_playlist_id as channel_id, video_id, published_at from (
      select *, row_number() over (partition by uploads_playlist_id
        order by published_at desc, video_id) as nth from uploads) where nth <= 50""",
)
def latest_videos(t: Tables):
    """Fifty newest per channel; one channel holds a third of all rows."""
    rows = fixture(t, "uploads").withColumnRenamed("uploads_playlist_id", "channel_id")
    return lookup.latest_videos(rows.drop("position"))


_NEWEST = """select video_id, scraped_at, view_count, like_count, comment_count from (
  select *, row_number() over (partition by video_id order by scraped_at desc, view_count desc,
    like_count desc, comment_count desc) as nth from {0}) where nth = 1"""


@query("n2_latest_snapshot", cte("snapshots") + _NEWEST.format("snapshots"))
def latest_snapshot(t: Tables):
    return trends.latest_snapshot(fixture(t, "snapshots"))


@query("n2_latest_snapshot_hot", cte("hot_snapshots") + _NEWEST.format("hot_snapshots"))
def latest_snapshot_hot(t: Tables):
    return trends.latest_snapshot(fixture(t, "hot_snapshots"))


_GROWTH = """, linked as (select *, lag(scraped_at) over w as before, lag(view_count) over w as v,
    lag(like_count) over w as l, lag(comment_count) over w as c from {0}
  window w as (partition by video_id order by scraped_at, view_count, like_count, comment_count))
select video_id, scraped_at, view_count, like_count, comment_count,
  view_count - v as view_count_delta, like_count - l as like_count_delta,
  comment_count - c as comment_count_delta,
  (epoch_us(scraped_at) - epoch_us(before)) / 3600000000.0::double as hours,
  case when scraped_at > before then (view_count - v)
    / ((epoch_us(scraped_at) - epoch_us(before)) / 3600000000.0::double) end as views_per_hour
from linked"""


@query("n3_growth", cte("snapshots") + _GROWTH.format("snapshots"))
def growth(t: Tables):
    return trends.growth(fixture(t, "snapshots"))


@query("n3_growth_hot", cte("hot_snapshots") + _GROWTH.format("hot_snapshots"))
def growth_hot(t: Tables):
    """One video holds a third of all snapshots; the range partitioning splits it."""
    return trends.growth(fixture(t, "hot_snapshots"))


_COPIES = [
    "cast(l_suppkey % 5 as string) as video_id",
    "date_trunc('year', l_shipdate) as scraped_at",
    "cast(l_linenumber % 2 as bigint) as view_count",
    "cast(1 as bigint) as like_count",
    "cast(l_linenumber % 3 as bigint) as comment_count",
]


@query(
    "n3_growth_copies",
    f"with copies as (select {', '.join(_COPIES)} from lineitem)" + _GROWTH.format("copies"),
)
def growth_copies(t: Tables):
    """Few videos with very many equal snapshots."""
    return trends.growth(t.view("lineitem", _COPIES))


@query(
    "a1_run_metrics",
    cte("videos")
    + f"""select {RUN_SQL} as captured_at, count(*) as rows from videos
    where next_poll_at <= {RUN_SQL}""",
)
def metrics(t: Tables):
    rows = fixture(t, "videos").where(F.col("next_poll_at") <= instant(RUN))
    return run_metrics(rows.withColumn("captured_at", instant(RUN)), "captured_at")


@query(
    "a3_quota_ledger",
    cte("request_log")
    + """, daily as (select api_key,
      cast((ts at time zone 'UTC') at time zone 'America/Los_Angeles' as date) as day,
      cast(sum(units) as bigint) as units, count(*) as requests,
      bool_or(coalesce(status = 403 and (contains(lower(message), 'quotaexceeded')
        or contains(lower(message), 'dailylimitexceeded')
        or contains(lower(message), 'ratelimitexceeded')), false)) as exhausted
      from request_log group by all)
    select api_key, cast(day as varchar) as quota_day, units, requests, exhausted,
      cast(case when exhausted then 0 else greatest(10000 - units, 0) end as bigint) as remaining
    from daily""",
)
def quota_ledger(t: Tables):
    used = ledger.quota_ledger(fixture(t, "request_log"))
    return used.withColumn("quota_day", F.col("quota_day").cast("string"))


@query(
    "u1_enrich_batches",
    """select cast(o_orderkey as string) as video_id, o_orderkey * 3 + 1 as view_count,
      o_orderkey % 11 as like_count, true as ok, cast(null as varchar) as error
    from orders where o_orderkey % 10 <> 7""",
)
def enrich_batches(t: Tables):
    """Counters from a client, fifty ids per request; it knows no id that ends in 7."""

    class FormulaClient:
        def fetch(self, keys):
            return [
                {"video_id": key, "view_count": int(key) * 3 + 1, "like_count": int(key) % 11}
                for key in keys
                if not key.endswith("7")
            ]

    result = T.StructType(
        [
            T.StructField("view_count", T.LongType()),
            T.StructField("like_count", T.LongType()),
        ]
    )
    ids = t.raw("orders").select(F.col("o_orderkey").cast("string").alias("video_id"))
    return lookup.enrich_batches(ids, "video_id", FormulaClient, result)


@query(
    "u1_enrich_failures",
    """select cast(o_orderkey as string) as video_id,
      case when o_orderkey % 100 < 50 then o_orderkey * 3 end as view_count, o_orderkey % 100 < 50 as ok,
      case when o_orderkey % 100 >= 50 then '400 bad request' end as error
    from orders""",
)
def enrich_failures(t: Tables):
    """A request that is refused for good costs its own keys only, and is not repeated."""

    class HalfRefusing:
        def fetch(self, keys):
            if int(keys[0]) % 100 >= 50:
                raise lookup.RequestError("400 bad request")
            return [{"video_id": key, "view_count": int(key) * 3} for key in keys]

    result = T.StructType([T.StructField("view_count", T.LongType())])
    ids = t.raw("orders").select(F.col("o_orderkey").cast("string").alias("video_id"))
    return lookup.enrich_batches(ids, "video_id", HalfRefusing, result, batch=1)
