"""The measurement queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from statflow.catalog.fixtures import RUN, RUN_SQL, cte, fixture
from statflow.catalog.registry import Tables, query
from statflow.functions.instants import hours_later, instant, poll_interval_hours
from statflow.operators import lookup, merge, parse, queue
from statflow.plans.jobs import ingest_uploads
from statflow.plans.publish import VersionedTable
from statflow.schemas import DEFAULT_CATEGORY, VIDEOS
from statflow.session import scratch_path

_AGE_SQL = f"(epoch_us({RUN_SQL}) - epoch_us(published_at))"
_HOUR = 3_600_000_000
INTERVAL_SQL = f"""cast(case when {_AGE_SQL} < 24 * {_HOUR} then 1 when {_AGE_SQL} < 168 * {_HOUR} then 6
  when {_AGE_SQL} < 720 * {_HOUR} then 24 else 168 end as int)"""


@query(
    "f1_active_seeds",
    cte("seeds")
    + """select channel_id, uploads_playlist_id from seeds
    where uploads_playlist_id is not null and uploads_playlist_id <> ''""",
)
def active_seeds(t: Tables):
    return queue.active_seeds(fixture(t, "seeds"))


@query(
    "q4_ordered_seeds",
    cte("seeds")
    + """select channel_id, uploads_playlist_id from seeds
    where uploads_playlist_id is not null and uploads_playlist_id <> '' order by channel_id""",
)
def ordered_seeds(t: Tables):
    return queue.ordered_seeds(fixture(t, "seeds"))


@query(
    "f2_due",
    cte("videos")
    + f"select video_id, published_at, next_poll_at, status from videos where next_poll_at <= {RUN_SQL}",
)
def due(t: Tables):
    rows = queue.due_videos(fixture(t, "videos"), RUN)
    return rows.select("video_id", "published_at", "next_poll_at", "status")


@query(
    "f2_due_active",
    cte("videos")
    + f"""select video_id, next_poll_at from videos
    where next_poll_at <= {RUN_SQL} and status = 'active'""",
)
def due_active(t: Tables):
    rows = queue.due_videos(fixture(t, "videos"), RUN, only_active=True)
    return rows.select("video_id", "next_poll_at")


@query(
    "q3_chunks",
    cte("videos")
    + f""", numbered as (select video_id, published_at, next_poll_at,
      row_number() over (order by next_poll_at, video_id) - 1 as n
      from videos where next_poll_at <= {RUN_SQL})
    select video_id, published_at, next_poll_at, n // 50 as batch_no, n % 50 + 1 as pos_in_batch
    from numbered""",
)
def chunks(t: Tables):
    return queue.chunk_due(queue.due_videos(fixture(t, "videos"), RUN))


@query(
    "q3_chunks_one_instant",
    cte("videos")
    + f""", numbered as (select video_id, published_at, {RUN_SQL} as next_poll_at,
      row_number() over (order by video_id) - 1 as n from videos)
    select video_id, published_at, next_poll_at, n // 50 as batch_no, n % 50 + 1 as pos_in_batch
    from numbered""",
)
def chunks_one_instant(t: Tables):
    """The whole queue due at the same instant, as after an ingestion run."""
    rows = fixture(t, "videos").withColumn("next_poll_at", instant(RUN))
    return queue.chunk_due(queue.due_videos(rows, RUN))


@query(
    "p15_poll_interval",
    cte("snapshots")
    + f"""select video_id, scraped_at, view_count, {INTERVAL_SQL} as hours
    from (select *, scraped_at + to_microseconds(cast(view_count * 997 as bigint)) as published_at
      from snapshots)""",
)
def poll_interval(t: Tables):
    at = F.timestamp_add("MICROSECOND", F.col("view_count") * 997, F.col("scraped_at"))
    return fixture(t, "snapshots").select(
        "video_id",
        "scraped_at",
        "view_count",
        poll_interval_hours(at, instant(RUN)).alias("hours"),
    )


@query(
    "p16_poll_times",
    cte("videos")
    + f"""select video_id, {RUN_SQL} as last_polled_at, {INTERVAL_SQL} as current_interval_hours,
      {RUN_SQL} + to_hours({INTERVAL_SQL}) as next_poll_at from videos""",
)
def poll_times(t: Tables):
    return merge.poll_updates(fixture(t, "videos").select("video_id", "published_at"), RUN)


@query(
    "p16_hours_later",
    "select l_orderkey, l_shipdate, l_linenumber, l_shipdate + to_hours(l_linenumber) as later from lineitem",
)
def later(t: Tables):
    rows = t.view("lineitem", ["l_orderkey", "l_shipdate", "l_linenumber"])
    at = hours_later(F.col("l_shipdate"), F.col("l_linenumber")).alias("later")
    return rows.select("l_orderkey", "l_shipdate", "l_linenumber", at)


@query(
    "p17_run_constants",
    f"""select p_partkey, {RUN_SQL} as captured_at, 'Data Science & AI' as project_category from part""",
)
def run_constants(t: Tables):
    empty = {name: F.lit(None).cast("map<string,string>") for name in ("snippet", "statistics", "contentDetails", "status", "topicDetails")}
    items = t.raw("part").select("p_partkey", F.col("p_partkey").cast("string").alias("id")).withColumns(empty)
    return parse.flatten_videos(items, RUN, DEFAULT_CATEGORY, "p_partkey").select(
        "p_partkey", "captured_at", "project_category"
    )


_MERGED_SQL = f"""select coalesce(t.video_id, s.video_id) as video_id,
      case when s.video_id is null then t.channel_id else s.channel_id end as channel_id,
      case when s.video_id is null then t.published_at else s.published_at end as published_at,
      case when s.video_id is null then t.status else 'active' end as status,
      case when s.video_id is null then t.last_polled_at else {RUN_SQL} end as last_polled_at,
      case when s.video_id is null then t.next_poll_at else {RUN_SQL} end as next_poll_at,
      cast(case when t.video_id is null then 1 else t.current_interval_hours end as int) as current_interval_hours,
      case when t.video_id is null then {RUN_SQL} else t.created_at end as created_at
    from videos t full join batch s on t.video_id = s.video_id"""


@query(
    "flow3_ingest",
    cte("seeds", "uploads", "videos")
    + f""", cleaned as (select channel_id, list_extract(string_split(trim(uploads_playlist_id), '='), -1)
        as uploads_playlist_id
      from seeds where uploads_playlist_id is not null and uploads_playlist_id <> ''),
    page as (select * from (select *, row_number() over (partition by uploads_playlist_id
        order by position, video_id) as nth from uploads) where nth <= 5),
    batch as (select video_id, channel_id, published_at from (
      select p.video_id, c.channel_id, p.published_at,
        row_number() over (partition by p.video_id order by c.channel_id desc, p.position desc) as nth
      from cleaned c join page p on c.uploads_playlist_id = p.uploads_playlist_id) where nth = 1)
    {_MERGED_SQL}""",
)
def ingest(t: Tables):
    """Seeds, their cleaned list ids, the first five uploads of each, merged into the queue."""
    seeds = queue.clean_seeds(queue.active_seeds(fixture(t, "seeds")))
    page = lookup.first_per_key(
        fixture(t, "uploads"), "uploads_playlist_id", ["position", "video_id"], 5
    )
    batch = seeds.join(page, "uploads_playlist_id")
    return merge.upsert_queue(fixture(t, "videos"), batch, RUN, ("channel_id", "position"))


@query(
    "flow3_ingest_job",
    cte("seeds", "uploads", "videos")
    + f""", cleaned as (select trim(channel_id) as channel_id,
        list_extract(string_split(trim(uploads_playlist_id), '='), -1) as uploads_playlist_id
      from seeds where uploads_playlist_id is not null and uploads_playlist_id <> ''),
    page as (select * from (select *, row_number() over (partition by uploads_playlist_id
        order by position, video_id) as nth from uploads) where nth <= 5),
    batch as (select video_id, channel_id, published_at from (
      select p.video_id, c.channel_id, p.published_at,
        row_number() over (partition by p.video_id order by c.channel_id desc, p.position desc) as nth
      from cleaned c join page p on c.uploads_playlist_id = p.uploads_playlist_id
      where c.channel_id in (select channel_id from seeds)) where nth = 1)
    {_MERGED_SQL}""",
)
def ingest_job(t: Tables):
    """The job itself: seeds to uploads, the parent check, the merge and the publication."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "queue"), VIDEOS)
    table.publish(fixture(t, "videos"))
    ingest_uploads(fixture(t, "seeds"), fixture(t, "uploads"), table, RUN)
    return table.read()
