"""Messages, API objects, key lists and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.catalog.fixtures import OBSERVED, OBSERVED_SQL, cte, fixture
from statflow.catalog.registry import Tables, query
from statflow.functions import bags, instants, text
from statflow.operators import ledger, parse
from statflow.schemas import CHANNEL_ITEM, VIDEO_ITEM
from statflow.session import scratch_path
from statflow.sources.events import as_event_frame
from statflow.sources.keys import explode_keys
from statflow.sources.replies import read_items

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
_ISO_SQL = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"


def messages(observed: DataFrame):
    """Wire messages, six tenths good; the others broken in one way each."""
    rows = observed.withColumn("kind", F.col("event_id") % 10)
    record = F.struct(
        F.when(F.col("kind") != 8, F.col("channel_id")).alias("channel_id"),
        "channel_title",
        "channel_description",
        F.date_format("published_at", _ISO).alias("published_at"),
        "country",
        F.when(F.col("kind") == 6, F.lit("@float@"))
        .when(F.col("kind") == 5, F.col("total_views").cast("string"))
        .otherwise(F.concat(F.lit("@"), F.col("total_views").cast("string"), F.lit("@")))
        .alias("total_views"),
        "subscriber_count",
        "video_count",
        F.when(F.col("kind") == 7, F.lit(""))
        .otherwise(F.date_format("processed_at", _ISO))
        .alias("processed_at"),
    )
    body = F.to_json(record, {"ignoreNullFields": "false"})
    body = F.replace(body, F.lit('"@float@"'), F.lit("1.5"))
    body = F.replace(F.replace(body, F.lit('"@'), F.lit("")), F.lit('@"'), F.lit(""))
    value = (
        F.when(F.col("kind") == 3, F.lit("{not json"))
        .when(F.col("kind") == 4, F.lit(None))
        .otherwise(body)
    )
    return as_event_frame(
        rows.withColumn("body", value), "channel_id", "body", "processed_at"
    )


_LOST = "event_id % 10 in (3, 4)"


@query(
    "p1_parse_messages",
    cte("channel_obs")
    + f"""select processed_at as kafka_timestamp,
      case when {_LOST} or event_id % 10 = 8 then null else channel_id end as channel_id,
      case when {_LOST} then null else channel_title end as channel_title,
      case when {_LOST} then null else channel_description end as channel_description,
      case when {_LOST} then null else published_at end as published_at,
      case when {_LOST} then null else country end as country,
      case when event_id % 10 in (3, 4, 5, 6) then null else total_views end as total_views,
      case when {_LOST} then null else subscriber_count end as subscriber_count,
      case when {_LOST} then null else video_count end as video_count,
      case when event_id % 10 in (3, 4, 7) then null else processed_at end as processed_at
    from channel_obs""",
)
def parse_messages(t: Tables):
    return parse.parse_messages(messages(fixture(t, "channel_obs")))


@query(
    "p2_usable",
    cte("channel_obs")
    + """select processed_at as kafka_timestamp, channel_id, channel_title, channel_description,
      published_at, country, total_views, subscriber_count, video_count, processed_at
    from channel_obs where event_id % 10 in (0, 1, 2, 9)""",
)
def usable(t: Tables):
    return parse.usable(parse.parse_checked(messages(fixture(t, "channel_obs"))))


@query(
    "p2_rejected",
    cte("channel_obs")
    + """select processed_at as kafka_timestamp, case event_id % 10 when 3 then 'corrupt'
      when 4 then 'no_value' when 5 then 'corrupt' when 6 then 'corrupt'
      when 7 then 'no_event_time' else 'no_key' end as reject_reason
    from channel_obs where event_id % 10 in (3, 4, 5, 6, 7, 8)""",
)
def rejected(t: Tables):
    return parse.rejected(parse.parse_checked(messages(fixture(t, "channel_obs")))).drop("message")


@query(
    "p3_wire_time",
    """select event_id, case when event_id % 7 in (2, 3, 6) then null
      when event_id % 7 = 4 then date_trunc('second', ts) else ts end as at from events""",
)
def wire_time(t: Tables):
    """ISO text in every form a producer writes, and some it should not."""
    kind, ts = F.col("event_id") % 7, F.col("ts")
    zulu = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    written = (
        F.when(kind == 0, zulu)
        .when(kind == 1, F.date_format(ts, _ISO))
        .when(kind == 2, F.lit(""))
        .when(kind == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(
            kind == 5,
            F.concat(
                F.date_format(
                    ts + F.expr("interval '5:30' hour to minute"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
                ),
                F.lit("+05:30"),
            ),
        )
        .when(kind == 6, F.lit("yesterday"))
    )
    rows = t.view("events", ["event_id", "ts"]).select("event_id", written.alias("at"))
    return parse.typed_times(rows, "at")


@query(
    "p4_iso_text",
    f"""select event_id, case when event_id % 2 = 0 then strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00')
      else strftime(ts, {_ISO_SQL}) end as written from events""",
)
def iso_text(t: Tables):
    rows = t.view("events", ["event_id", "ts"])
    at = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return rows.select("event_id", instants.iso_text(at).alias("written"))


@query(
    "w1_wire_round_trip",
    cte("channel_obs")
    + """select channel_id as key, processed_at as kafka_timestamp, channel_id, channel_title,
      channel_description, published_at, country, total_views, subscriber_count, video_count,
      processed_at from channel_obs""",
)
def wire_round_trip(t: Tables):
    """Rows to keyed messages and back."""
    rows = fixture(t, "channel_obs").drop("event_id")
    sent = parse.wire_frame(rows)
    arrived = sent.withColumn("at", F.get_json_object("value", "$.processed_at").cast("timestamp"))
    back = parse.parse_messages(as_event_frame(arrived, "key", "value", "at"), "key")
    return back.withColumn("key", F.col("key").cast("string"))


# ---------------------------------------------------------------------------
# API objects.  Text "@null@" becomes an explicit null in the JSON.
# ---------------------------------------------------------------------------


def _json(column):
    return F.replace(F.to_json(column), F.lit('"@null@"'), F.lit("null"))


# Key names of API objects
_CHANNEL_OBJECT = """named_struct(
  'id', case when c_custkey % 19 <> 0 then concat('UC', cast(c_custkey as string)) end,
  'snippet', case when c_custkey % 11 <> 0 then named_struct(
    'title', case when c_custkey % 7 <> 0 then c_name end,
    'description', case when c_custkey % 6 = 0 then '@null@' when c_custkey % 6 <> 1
      then concat('Über "', c_mktsegment, '"') end,
    'publishedAt', case when c_custkey % 13 <> 0
      then concat('20', lpad(cast(c_custkey % 24 as string), 2, '0'), '-03-01T10:20:30Z') end,
    'country', case when c_custkey % 5 <> 0 then substring(c_mktsegment, 1, 2) end) end,
  'statistics', case when c_custkey % 29 <> 0 then named_struct(
    'viewCount', case when c_custkey % 4 <> 0 then cast(c_custkey * 1000003 as string) end,
    'subscriberCount', case when c_custkey % 3 <> 0 then cast(c_custkey * 17 as string) end,
    'hiddenSubscriberCount', c_custkey % 3 = 0,
    'videoCount', case when c_custkey % 23 = 0 then 'n/a' else cast(c_custkey % 50 as string) end) end)"""


def channel_objects(t: Tables):
    rows = t.raw("customer").selectExpr("c_custkey", f"{_CHANNEL_OBJECT} as object")
    return rows.select("c_custkey", F.from_json(_json(F.col("object")), CHANNEL_ITEM).alias("item"))


@query(
    "p5_flatten_channels",
    f"""select c_custkey,
      case when c_custkey % 19 <> 0 then concat('UC', c_custkey) else '' end as channel_id,
      case when c_custkey % 11 <> 0 and c_custkey % 7 <> 0 then c_name else '' end as channel_title,
      case when c_custkey % 11 = 0 or c_custkey % 6 = 1 then '' when c_custkey % 6 = 0 then null
        else concat('Über "', c_mktsegment, '"') end as channel_description,
      case when c_custkey % 11 = 0 or c_custkey % 13 = 0 then ''
        else concat('20', lpad(cast(c_custkey % 24 as varchar), 2, '0'), '-03-01T10:20:30Z') end as published_at,
      case when c_custkey % 11 = 0 or c_custkey % 5 = 0 then '' else substring(c_mktsegment, 1, 2) end as country,
      cast(case when c_custkey % 29 = 0 or c_custkey % 4 = 0 then 0 else c_custkey * 1000003 end as bigint) as total_views,
      cast(case when c_custkey % 29 = 0 or c_custkey % 3 = 0 then 0 else c_custkey * 17 end as bigint) as subscriber_count,
      cast(case when c_custkey % 29 = 0 then 0 when c_custkey % 23 = 0 then null
        else c_custkey % 50 end as bigint) as video_count,
      strftime({OBSERVED_SQL}, '%Y-%m-%dT%H:%M:%S+00:00') as processed_at,
      case when c_custkey % 29 <> 0 and c_custkey % 23 = 0 then 'video_count' else '' end as bad
    from customer""",
)
def flatten_channels(t: Tables):
    items = channel_objects(t).select("c_custkey", "item.*")
    flat = parse.flatten_channels(items, OBSERVED, "c_custkey")
    return flat.withColumn("bad", F.array_join(parse.BAD_FIELDS, ",")).drop(parse.BAD_FIELDS)


# Key names of API objects
_VIDEO_OBJECT = """named_struct(
  'id', case when p_partkey % 41 <> 0 then concat('v', cast(p_partkey as string)) end,
  'snippet', case when p_partkey % 37 <> 0 then named_struct(
    'channelTitle', case when p_partkey % 5 <> 0 then p_brand end,
    'title', case when p_partkey % 7 <> 0 then p_name end,
    'description', case when p_partkey % 8 = 0 then '@null@' when p_partkey % 8 <> 1 then p_type end,
    'publishedAt', case when p_partkey % 13 <> 0
      then concat('20', lpad(cast(p_partkey % 24 as string), 2, '0'), '-03-01T10:20:30.5Z') end,
    'categoryId', case when p_partkey % 3 <> 0 then cast(p_size as string) end,
    'liveBroadcastContent', case when p_partkey % 9 <> 0 then 'live' end,
    'tags', case when p_partkey % 4 = 0 then array() when p_partkey % 4 <> 1
      then array(p_brand, 'a,"b"', p_type) end,
    'thumbnails', case when p_partkey % 17 <> 0 then named_struct(
      'medium', named_struct('url', 'm.jpg', 'width', 320),
      'default', case when p_partkey % 2 = 0 then named_struct('url', 'd.jpg', 'width', 120) end,
      'high', case when p_partkey % 3 = 0 then named_struct('url', 'h.jpg', 'width', 480) end,
      'maxres', case when p_partkey % 5 = 0 then named_struct(
        'url', case when p_partkey % 10 <> 0 then 'x.jpg' end, 'width', 1280) end) end) end,
  'statistics', case when p_partkey % 31 <> 0 then named_struct(
    'viewCount', case when p_partkey % 5 <> 0 then cast(p_partkey * 1000003 as string) end,
    'likeCount', case when p_partkey % 6 <> 0 then cast(p_size * 10 as string) end,
    'commentCount', case when p_partkey % 43 = 0 then '1,000' when p_partkey % 47 = 0 then '@null@'
      else cast(p_size as string) end) end,
  'contentDetails', case when p_partkey % 29 <> 0 then named_struct(
    'duration', case when p_partkey % 3 <> 0 then concat('PT', cast(p_size as string), 'M') end,
    'dimension', '2d',
    'definition', case when p_partkey % 4 <> 0 then 'hd' end,
    'caption', case when p_partkey % 5 <> 0 then 'false' end,
    'licensedContent', case when p_partkey % 3 <> 0 then p_partkey % 2 = 0 end,
    'projection', case when p_partkey % 7 <> 0 then 'rectangular' end) end,
  'status', case when p_partkey % 23 <> 0 then named_struct(
    'uploadStatus', case when p_partkey % 3 <> 0 then 'processed' end,
    'privacyStatus', case when p_partkey % 5 <> 0 then 'public' end,
    'embeddable', case when p_partkey % 4 <> 0 then p_partkey % 3 = 0 end,
    'publicStatsViewable', case when p_partkey % 6 <> 0 then p_partkey % 5 = 0 end) end,
  'topicDetails', case when p_partkey % 3 = 0 then named_struct(
    'topicCategories', case when p_partkey % 2 = 0
      then array(concat('https://w.example/', p_type)) end) end)"""

_NO_SNIPPET = "p_partkey % 37 = 0"
_NO_CONTENT = "p_partkey % 29 = 0"
_NO_STATUS = "p_partkey % 23 = 0"
_THUMBNAIL_SQL = f"""case when {_NO_SNIPPET} or p_partkey % 17 = 0 then ''
  when p_partkey % 10 = 0 then '' when p_partkey % 5 = 0 then 'x.jpg'
  when p_partkey % 3 = 0 then 'h.jpg' when p_partkey % 2 = 0 then 'd.jpg' else '' end"""


def video_objects(t: Tables):
    rows = t.raw("part").selectExpr("p_partkey", f"{_VIDEO_OBJECT} as object")
    return rows.select("p_partkey", _json(F.col("object")).alias("object"))


def video_items(t: Tables):
    item = F.from_json("object", VIDEO_ITEM).alias("item")
    return video_objects(t).select("p_partkey", item).select("p_partkey", "item.*")


@query(
    "p6_flatten_videos",
    f"""select p_partkey,
      case when p_partkey % 41 <> 0 then concat('v', p_partkey) end as video_id,
      case when {_NO_SNIPPET} or p_partkey % 5 = 0 then '' else p_brand end as channel_title,
      'Data Science & AI' as project_category,
      case when {_NO_SNIPPET} or p_partkey % 7 = 0 then '' else p_name end as title,
      case when {_NO_SNIPPET} or p_partkey % 8 = 1 then '' when p_partkey % 8 = 0 then null
        else p_type end as description,
      case when {_NO_SNIPPET} or p_partkey % 13 = 0 then null else
        make_timestamp(2000 + p_partkey % 24, 3, 1, 10, 20, 30.5) end as published_at,
      {_THUMBNAIL_SQL} as thumbnail_url,
      case when {_NO_SNIPPET} or p_partkey % 4 in (0, 1) then ''
        else concat(p_brand, '|a,"b"|', p_type) end as tags_text,
      cast(case when {_NO_SNIPPET} or p_partkey % 4 in (0, 1) then 0 else 3 end as int) as tags_size,
      case when {_NO_SNIPPET} or p_partkey % 3 = 0 then null else cast(p_size as varchar) end as youtube_category_id,
      case when {_NO_SNIPPET} or p_partkey % 9 = 0 then 'none' else 'live' end as live_broadcast_content,
      cast(case when p_partkey % 31 = 0 or p_partkey % 5 = 0 then 0 else p_partkey * 1000003 end as bigint) as view_count,
      cast(case when p_partkey % 31 = 0 or p_partkey % 6 = 0 then 0 else p_size * 10 end as bigint) as like_count,
      cast(case when p_partkey % 31 = 0 then 0 when p_partkey % 43 = 0 or p_partkey % 47 = 0 then null
        else p_size end as bigint) as comment_count,
      case when {_NO_CONTENT} or p_partkey % 3 = 0 then '' else concat('PT', p_size, 'M') end as duration,
      case when {_NO_CONTENT} then '' else '2d' end as dimension,
      case when {_NO_CONTENT} or p_partkey % 4 = 0 then '' else 'hd' end as definition,
      case when {_NO_CONTENT} or p_partkey % 5 = 0 then '' else 'false' end as caption,
      case when {_NO_CONTENT} or p_partkey % 3 = 0 then false else p_partkey % 2 = 0 end as licensed_content,
      case when {_NO_CONTENT} or p_partkey % 7 = 0 then '' else 'rectangular' end as projection,
      case when p_partkey % 6 = 0 then concat('https://w.example/', p_type) else '' end as topics_text,
      cast(case when p_partkey % 6 = 0 then 1 else 0 end as int) as topics_size,
      case when {_NO_STATUS} or p_partkey % 3 = 0 then '' else 'processed' end as upload_status,
      case when {_NO_STATUS} or p_partkey % 5 = 0 then '' else 'public' end as privacy_status,
      case when {_NO_STATUS} or p_partkey % 4 = 0 then true else p_partkey % 3 = 0 end as embeddable,
      case when {_NO_STATUS} or p_partkey % 6 = 0 then true else p_partkey % 5 = 0 end as public_stats_viewable,
      {OBSERVED_SQL} as captured_at,
      case when p_partkey % 31 <> 0 and (p_partkey % 43 = 0 or p_partkey % 47 = 0)
        then 'comment_count' else '' end as bad
    from part""",
)
def flatten_videos(t: Tables):
    flat = parse.flatten_videos(video_items(t), OBSERVED, "Data Science & AI", "p_partkey")
    return flat.select(
        *[c for c in flat.columns if c not in ("tags", "topic_categories", parse.BAD_FIELDS)],
        F.array_join("tags", "|").alias("tags_text"),
        F.size("tags").alias("tags_size"),
        F.array_join("topic_categories", "|").alias("topics_text"),
        F.size("topic_categories").alias("topics_size"),
        F.array_join(parse.BAD_FIELDS, ",").alias("bad"),
    )


@query(
    "p7_best_thumbnail",
    f"select p_partkey, {_THUMBNAIL_SQL} as thumbnail_url from part",
)
def best_thumbnail(t: Tables):
    url = bags.thumbnail_url(F.col("snippet")).alias("thumbnail_url")
    return video_items(t).select("p_partkey", url)


@query(
    "p8_text_count",
    """select l_orderkey, l_partkey, l_linenumber, cast(case l_linenumber % 5 when 0 then 0
        when 3 then null when 4 then null else l_partkey end as bigint) as counted,
      l_linenumber % 5 in (3, 4) as unreadable from lineitem""",
)
def text_count(t: Tables):
    """Missing, plain, signed and padded, unreadable, explicit null."""
    kind, number = F.col("l_linenumber") % 5, F.col("l_partkey").cast("string")
    body = (
        F.when(kind == 0, F.lit("{}"))
        .when(kind == 1, F.concat(F.lit('{"n":"'), number, F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"n":" +'), number, F.lit(' "}')))
        .when(kind == 3, F.concat(F.lit('{"n":"'), number, F.lit('x"}')))
        .otherwise(F.lit('{"n":null}'))
    )
    rows = t.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", body.alias("body"))
    bag = rows.withColumn("bag", F.from_json("body", "map<string,string>"))
    return bag.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        bags.count(F.col("bag"), "n").alias("counted"),
        (F.size(bags.unreadable_counts(F.col("bag"), {"n": "n"})) > 0).alias("unreadable"),
    )


@query(
    "p9_clean_ids",
    cte("seeds")
    + """select channel_id, substring(concat('ä', repeat(channel_title, 4)), 1, 64) as clipped,
      case when uploads_playlist_id is null then null when trim(uploads_playlist_id) = '' then ''
        when contains(uploads_playlist_id, '=')
          then list_extract(string_split(trim(uploads_playlist_id), '='), -1)
        else trim(uploads_playlist_id) end as playlist from seeds""",
)
def clean_ids(t: Tables):
    wide = F.concat(F.lit("\t  ä"), F.repeat("channel_title", 4), F.lit(" \n"))
    return fixture(t, "seeds").select(
        "channel_id",
        text.clean_key(wide).alias("clipped"),
        text.playlist_key(F.col("uploads_playlist_id")).alias("playlist"),
    )


@query(
    "p19_mask_secret",
    cte("request_log")
    + """select event_id, case when length(api_key) <= 8 then '****'
      else concat(left(api_key, 4), '…', right(api_key, 4)) end as api_key from request_log""",
)
def mask_secret(t: Tables):
    return ledger.masked(fixture(t, "request_log")).select("event_id", "api_key")


@query(
    "p20_quota_errors",
    cte("request_log")
    + """select event_id, api_key, message from request_log where status = 403 and (
      contains(lower(message), 'quotaexceeded') or contains(lower(message), 'dailylimitexceeded')
      or contains(lower(message), 'ratelimitexceeded'))""",
)
def quota_errors(t: Tables):
    return ledger.quota_errors(fixture(t, "request_log")).select("event_id", "api_key", "message")


_LIST = """concat(' K', cast(p_partkey as string), ', ,K', cast(p_partkey % 7 as string), ',',
  p_name, '  ,', case when p_partkey % 5 = 0 then '' else concat('K', cast(p_partkey as string)) end)"""


@query(
    "s5_key_list",
    f"""with lists as (select p_partkey, string_split({_LIST}, ',') as parts from part),
    placed as (select p_partkey, unnest(parts) as raw, generate_subscripts(parts, 1) as nth from lists)
    select p_partkey, cast(nth - 1 as int) as position, trim(raw) as key
    from placed where trim(raw) <> ''""",
)
def key_list(t: Tables):
    return explode_keys(t.raw("part").selectExpr("p_partkey", f"{_LIST} as keys"), "keys")


@query(
    "s4_landing_replies",
    f"""select reply, case when p_partkey % 41 <> 0 then concat('v', p_partkey) end as video_id,
      case when {_NO_SNIPPET} or p_partkey % 7 = 0 then '' else p_name end as title
    from (select *, p_partkey // 50 as reply from part) where reply % 4 <> 3""",
)
def landing_replies(t: Tables):
    """Replies of 50 items each are landed as JSON lines and read back; some hold no list."""
    objects = video_objects(t).withColumn("reply", F.expr("p_partkey div 50"))
    replies = objects.groupBy("reply").agg(F.array_join(F.collect_list("object"), ",").alias("all"))
    listed = F.concat(F.lit(', "items": ['), F.col("all"), F.lit("]"))
    body = F.concat(
        F.lit('{"reply": '),
        F.col("reply").cast("string"),
        F.when(F.col("reply") % 4 != 3, listed).otherwise(F.lit("")),
        F.lit("}"),
    )
    path = scratch_path(t.spark, "landing")
    replies.select(body.alias("value")).write.text(path)
    extra = T.StructType([T.StructField("reply", T.LongType())])
    items = read_items(t.spark, path, VIDEO_ITEM, extra)
    return parse.flatten_videos(items, OBSERVED, "c", "reply").select("reply", "video_id", "title")
