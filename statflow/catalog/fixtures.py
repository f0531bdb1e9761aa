"""Channel and video tables seen through the test tables.

Each fixture is a list of SQL expressions over one table.  The same text serves Spark
(``Tables.view``) and the SQL twin (``cte``), so both sides start from equal rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from statflow.catalog.registry import Tables

# run instants: inside the order dates, and after the events
RUN = datetime(2001, 8, 1, 12, tzinfo=timezone.utc)
RUN_SQL = "timestamp '2001-08-01 12:00:00'"
OBSERVED = datetime(2024, 6, 1, 6, 30, tzinfo=timezone.utc)
OBSERVED_SQL = "timestamp '2024-06-01 06:30:00'"

CHANNEL_OBS = [
    "event_id",
    "concat('UC', lpad(cast(user_id as string), 8, '0')) as channel_id",
    "concat('Channel ', cast(user_id as string), ' v', cast(event_id % 10 as string)) as channel_title",
    "case when event_id % 5 = 0 then null"
    " else concat('Über \"', event_type, '\" ', cast(event_id as string)) end as channel_description",
    "case when event_id % 17 = 0 then null else ts - interval '400' day end as published_at",
    "case when user_id % 7 = 0 then null else event_type end as country",
    "case when event_id % 11 = 0 then 0"
    " else cast(floor(value * 1000000) as bigint) end as total_views",
    "case when event_id % 13 = 0 then 0"
    " else cast(floor(value * value * 331) as bigint) end as subscriber_count",
    "cast(event_id % 97 as bigint) as video_count",
    "ts as processed_at",
]

# channel table with a null counter here and there
CHANNELS = [
    "concat('UC', lpad(cast(c_custkey as string), 8, '0')) as channel_id",
    "c_name as channel_title",
    "concat('In ', c_mktsegment) as channel_description",
    "timestamp '2001-01-31 18:00:00' - interval '1' hour * (c_custkey % 9000) as published_at",
    "c_mktsegment as country",
    "case when c_custkey % 31 = 0 then null"
    " else cast(floor(abs(c_acctbal) * 10000) as bigint) end as total_views",
    "case when c_custkey % 37 = 0 then null"
    " else cast(floor(abs(c_acctbal) * 331) as bigint) end as subscriber_count",
    "cast(c_custkey % 89 as bigint) as video_count",
    "timestamp '2001-02-01 00:00:00' + interval '1' hour * (c_custkey % 4700) as processed_at",
    "timestamp '2001-02-01 00:00:00' as created_at",
]

SEEDS = [
    "cast(c_custkey as string) as channel_id",
    "c_name as channel_title",
    "case when c_custkey % 6 = 0 then '' when c_custkey % 6 = 1 then null"
    " else substring(c_mktsegment, 1, 9) end as country",
    "case when c_custkey % 14 = 3 then null"
    " else cast(floor(abs(c_acctbal) * 100) as bigint) end as subscriber_count",
    "cast(floor(abs(c_acctbal) * 10000) as bigint) as total_views",
    "case when c_custkey % 10 = 0 then null when c_custkey % 10 = 1 then ''"
    " when c_custkey % 10 = 2 then '  '"
    " when c_custkey % 10 = 3 then concat('https://x.example/playlist?a=1&list=UU', cast(c_custkey as string))"
    " when c_custkey % 10 = 4 then concat('UU', cast(c_custkey as string), '=')"
    " else concat('  UU', cast(c_custkey as string), ' ') end as uploads_playlist_id",
]

VIDEOS = [
    "cast(o_orderkey as string) as video_id",
    "cast(o_custkey as string) as channel_id",
    "o_orderdate as published_at",
    "case o_orderstatus when 'O' then 'active' when 'F' then 'archived' else 'deleted' end as status",
    "case when o_orderkey % 4 = 0 then null else o_orderdate + interval '1' day end as last_polled_at",
    "case when o_orderkey % 10 = 0 then null else o_orderdate + interval '30' day end as next_poll_at",
    "cast(6 as int) as current_interval_hours",
    "o_orderdate as created_at",
]

SNAPSHOTS = [
    "cast(l_orderkey as string) as video_id",
    "l_shipdate as scraped_at",
    "cast(floor(l_extendedprice) as bigint) as view_count",
    "cast(l_quantity * 10 as bigint) as like_count",
    "cast(l_linenumber as bigint) as comment_count",
]

# one video holds a third of all snapshots
HOT_SNAPSHOTS = [
    "case when l_orderkey % 3 = 0 then 'hot' else cast(l_orderkey as string) end as video_id",
    *SNAPSHOTS[1:],
]

# one channel holds a third of all uploads
UPLOADS = [
    "concat('UU', case when o_orderkey % 3 = 0 then '1' else cast(o_custkey as string) end)"
    " as uploads_playlist_id",
    "o_orderkey * 7919 % 100003 as position",
    "cast(o_orderkey as string) as video_id",
    "o_orderdate as published_at",
]

CHANNEL_LISTS = [
    "cast(c_custkey as string) as channel_id",
    "concat('UU', cast(c_custkey as string)) as uploads_playlist_id",
]

REQUEST_LOG = [
    "event_id",
    "ts",
    "case when user_id % 9 = 0 then concat('k', cast(user_id % 5 as string))"
    " else concat('AIzaKey', lpad(cast(user_id % 5 as string), 8, '0')) end as api_key",
    "case when event_type = 'error' then 403 when event_type = 'signup' then 400 else 200 end as status",
    "case when event_type = 'error' and event_id % 4 = 0 then 'reason: quotaExceeded'"
    " when event_type = 'error' and event_id % 4 = 1 then 'DAILYLIMITEXCEEDED'"
    " when event_type = 'error' and event_id % 4 = 2 then null"
    " when event_type = 'error' then 'forbidden'"
    " when event_type = 'signup' then 'quotaExceeded' else 'ok' end as message",
    "cast(1 + event_id % 40 as int) as units",
]

_SOURCES = {
    "channel_obs": ("events", CHANNEL_OBS),
    "channels": ("customer", CHANNELS),
    "seeds": ("customer", SEEDS),
    "videos": ("orders", VIDEOS),
    "snapshots": ("lineitem", SNAPSHOTS),
    "hot_snapshots": ("lineitem", HOT_SNAPSHOTS),
    "uploads": ("orders", UPLOADS),
    "channel_lists": ("customer", CHANNEL_LISTS),
    "request_log": ("events", REQUEST_LOG),
}


def fixture(tables: Tables, name: str) -> DataFrame:
    source, expressions = _SOURCES[name]
    return tables.view(source, expressions)


def cte(*names: str) -> str:
    """``with`` clause that defines the named fixtures."""
    parts = []
    for name in names:
        source, expressions = _SOURCES[name]
        parts.append(f"{name} as (select {', '.join(expressions)} from {source})")
    return "with " + ",\n".join(parts) + "\n"
