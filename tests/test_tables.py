"""Published tables, series, layouts, database options, and the batch jobs."""

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow import session
from statflow.operators import boards, lookup, merge, quality, queue
from statflow.operators.merge import Policy
from statflow.plans import jobs, publish
from statflow.plans.publish import PublishConflict, VersionedTable, merge_into
from statflow.schemas import CHANNEL_STATS, VIDEO_TRENDS, VIDEOS, VIEW_TIMESERIES
from statflow.sinks import series, tables
from statflow.sinks.messages import send_options
from statflow.sinks.metrics import write_counted
from statflow.sources.events import broker_options
from statflow.sources.tables import Database, Split

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T1 = T0 + timedelta(days=2)


def numbers(spark, path):
    return VersionedTable(spark, path("t"), spark.range(1).schema)


def test_readers_follow_the_newest_commit(spark, path):
    table = numbers(spark, path)
    assert table.read().count() == 0 and table.current() is None
    assert table.publish(spark.range(3)).rows == 3
    reader = table.read()
    table.publish(table.read().union(table.read()))
    # a reader keeps the version it started with
    assert reader.count() == 3 and table.read().count() == 6
    assert table.current().version == 2 and table.current().buckets == 1


def test_a_half_written_version_is_not_seen(spark, path):
    table = numbers(spark, path)
    table.publish(spark.range(3))
    spark.range(9).write.parquet(f"{table.root}/v000000000002-dead")
    assert table.read().count() == 3


def test_second_writer_of_a_version_fails(spark, path):
    table = numbers(spark, path)
    table.publish(spark.range(3))
    stale = table.current()
    assert stale.folders
    with pytest.raises(PublishConflict):
        table._commit(stale)
    assert table.read().count() == 3


def sizes(root):
    """Bytes of the data files of a table by folder and bucket."""
    found = {}
    for file in Path(root).rglob("*.parquet"):
        place = file.parent.relative_to(root).parts
        found[place] = found.get(place, 0) + file.stat().st_size
    return found


def bucketed(spark, path, count=3000):
    table = VersionedTable(spark, path("b"), VIDEOS, "video_id", 16, queue.DUE_ORDER)
    rows = spark.range(count).selectExpr(
        "cast(id as string) as video_id", "'c' as channel_id", "timestamp_seconds(id) as published_at", "'active' as status",
        "cast(null as timestamp) as last_polled_at", "timestamp_seconds(id) as next_poll_at", "6 as current_interval_hours",
        "timestamp_seconds(0) as created_at",
    )
    table.publish(rows)
    return table


def test_a_batch_of_one_key_rewrites_one_bucket(spark, path):
    table = bucketed(spark, path)
    before, was = table.current(), sizes(table.root)
    assert len(before.folders) == 16
    measured = spark.createDataFrame([("77", T0)], "video_id string, published_at timestamp")
    scanned = []

    def change(rows):
        scanned.extend(rows.inputFiles())
        return merge.apply_cadence(rows, measured, T1)

    after = table.update(measured, change)
    new = {place: size for place, size in sizes(table.root).items() if place not in was}
    assert len(new) == 1 and sum(new.values()) < sum(was.values()) / 10
    assert len(scanned) == 1 and after.rows < 3000 / 10
    moved = [n for n in before.folders if after.folders[n] != before.folders[n]]
    assert len(moved) == 1 and f"key_bucket={moved[0]}" in scanned[0]
    polled = {r.video_id for r in table.read().where("last_polled_at is not null").collect()}
    assert polled == {"77"} and table.read().count() == 3000


def test_new_keys_and_keys_of_no_row(spark, path):
    table = VersionedTable(spark, path("b"), VIDEOS, "video_id", 4)
    keys = "video_id string, channel_id string, published_at timestamp, position int"
    batch = spark.createDataFrame([(f"v{i}", "c", T0, i) for i in range(9)] + [(None, "c", T0, 0)], keys)
    table.update(batch, lambda rows: merge.upsert_queue(rows, batch, T0, ("position",)))
    assert table.current().version == 1 and table.read().count() == 9
    assert table.update(batch.limit(0), lambda rows: 1 / 0).version == 1
    assert table.update(spark.createDataFrame([("none",)], "video_id string"), lambda rows: rows).rows <= 9
    assert sorted(r.video_id for r in table.read().collect()) == [f"v{i}" for i in range(9)]


def test_rows_of_other_buckets_are_refused(spark, path):
    table = bucketed(spark, path, 200)
    for names in (["7"], ["7", "8", "9"]):
        keys = spark.createDataFrame([(name,) for name in names], "video_id string")
        whole = table.read()
        with pytest.raises(Exception, match="other buckets"):
            table.update(keys, lambda rows: whole)
    assert table.current().version == 1


def test_a_table_keeps_its_number_of_buckets(spark, path):
    bucketed(spark, path, 100)
    again = VersionedTable(spark, path("b"), VIDEOS, "video_id", 4)
    again.update(again.read().where("video_id = '5'"), lambda rows: rows.where("video_id <> '5'"))
    assert again.current().buckets == 16 and again.read().count() == 99


def test_files_are_sorted_for_the_due_scan(spark, path):
    table = VersionedTable(spark, path("v"), VIDEOS, sorted_by=queue.DUE_ORDER)
    rows = [
        (f"v{i}", "c", T0, "active", None, T0 + timedelta(hours=i * 37 % 100), 6, T0)
        for i in range(100)
    ]
    table.publish(spark.createDataFrame(rows, VIDEOS).coalesce(1))
    polls = [r.next_poll_at for r in table.read().coalesce(1).collect()]
    assert polls == sorted(polls) and len(polls) == 100


def test_merge_needs_a_catalog_that_can(spark):
    spark.range(3).withColumn("x", F.lit(1)).write.saveAsTable("plain_target")
    policy = Policy("id", last=("x",), on_insert={"x": 0})
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            merge_into(spark.range(5).withColumn("x", F.lit(2)), "plain_target", policy, ["x"])
    finally:
        spark.sql("drop table plain_target")


def test_an_overtaken_writer_updates_again(spark, path):
    table = numbers(spark, path)
    table.publish(spark.range(1))
    calls = []

    def change(rows):
        if not calls:
            table.update(spark.range(1), lambda own: own.union(spark.range(90, 91)))
        calls.append(rows.count())
        return rows.union(spark.range(80, 81))

    table.update(spark.range(1), change)
    assert sorted(r.id for r in table.read().collect()) == [0, 80, 90] and calls == [1, 2]


def test_a_writer_of_other_buckets_is_no_conflict(spark, path):
    table = VersionedTable(spark, path("n"), spark.range(1).schema, "id", 8)
    table.publish(spark.range(100))
    home = {r.id: r.b for r in spark.range(100).select("id", table.bucket(8).alias("b")).collect()}
    other = next(n for n in home if home[n] != home[0])
    calls = []

    def change(rows):
        if not calls:
            gone = spark.createDataFrame([(other,)], "id long")
            table.update(gone, lambda own: own.where(F.col("id") != other))
        calls.append(1)
        return rows.where("id <> 0")

    assert table.update(spark.range(1), change).version == 3
    assert calls == [1] and {r.id for r in table.read().collect()} == set(range(1, 100)) - {other}


def test_an_update_that_is_always_overtaken_fails(spark, path, monkeypatch):
    monkeypatch.setattr(publish, "ATTEMPTS", 2)
    table = numbers(spark, path)
    table.publish(spark.range(1))

    def change(rows):
        table.publish(spark.range(5))
        return rows

    with pytest.raises(PublishConflict):
        table.update(spark.range(1), change)
    assert table.read().count() == 5


def test_a_damaged_commit_is_an_error(spark, path):
    table = numbers(spark, path)
    commit = table.publish(spark.range(1))
    with pytest.raises(PublishConflict):
        table._commit(commit)
    with open(f"{path('t')}/_commits/{2:012d}.json", "w") as damaged:
        damaged.write('{"version": 2, "fol')
    with pytest.raises(ValueError):
        table.read()


def test_counted_while_written(spark, path):
    assert write_counted(spark.range(7), lambda df: df.write.parquet(path("x"))) == 7
    empty = spark.range(7).where("id < 0")
    assert write_counted(empty, lambda df: df.write.parquet(path("y"))) == 0


def snapshots(spark, n=200):
    rows = [(f"v{i % 10}", T0 + timedelta(hours=i), i, 0, 0) for i in range(n)]
    return spark.createDataFrame(rows, VIEW_TIMESERIES)


def scanned_rows(df):
    """Rows that the scan of a query without a shuffle has read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_series_prunes_by_day_and_key(spark, path):
    rows = spark.range(40_000).selectExpr(
        "concat('v', id % 100) as video_id", "timestamp_seconds(1704067200 + (id div 100) * 3600 * 6) as scraped_at",
        "id as view_count", "0L as like_count", "0L as comment_count",
    )
    series.append_series(rows, path("s"), T1, partitions=10)
    stored = series.read_series(spark, path("s"), VIEW_TIMESERIES)
    assert len(list(Path(path("s")).rglob("*.parquet"))) == 10  # for a hundred days
    day = stored.where(F.col("scraped_date") == date(2024, 1, 3)).where("video_id = 'v3'")
    plan = plan_of(day)
    assert "EqualTo(scraped_date,2024-01-03)" in plan and "EqualTo(video_id,v3)" in plan
    assert 0 < scanned_rows(day) <= 40_000 / 5
    expected = rows.where("date(scraped_at) = '2024-01-03' and video_id = 'v3'")
    assert sorted(day.select(*VIEW_TIMESERIES.names).collect()) == sorted(expected.collect()) and day.count() == 4


def test_a_repeated_run_replaces_its_rows_only(spark, path):
    series.append_series(snapshots(spark, 50), path("s"), T0)
    assert series.append_series(snapshots(spark, 30), path("s"), T1) == 30
    assert series.append_series(snapshots(spark, 30), path("s"), T1) == 30
    assert series.read_series(spark, path("s"), VIEW_TIMESERIES).count() == 80
    assert series.read_series(spark, path("s"), VIEW_TIMESERIES, T1).count() == 30


def test_layout_changes_no_row(spark):
    laid_out = series.series_layout(snapshots(spark), "scraped_at", "video_id", "d", 3)
    assert sorted(laid_out.drop("d").collect()) == sorted(snapshots(spark).collect())


def test_an_index_skips_row_groups(spark, path):
    """Countries stand in no order, and each row group holds most of their range: only Bloom filters tell."""
    rows = spark.range(60_000).selectExpr(
        "cast(id as string) as video_id", "concat('c', pmod(id * 7919, 60000)) as channel_id", "timestamp_seconds(id) as published_at",
        "'active' as status", "cast(null as timestamp) as last_polled_at", "timestamp_seconds(id) as next_poll_at",
        "6 as current_interval_hours", "timestamp_seconds(0) as created_at",
    ).coalesce(1)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 * 1024))
    try:
        read = {}
        for indexes in ((), ("channel_id",)):
            table = VersionedTable(spark, path(f"i{len(indexes)}"), VIDEOS, "video_id", 2, queue.DUE_ORDER, indexes)
            table.publish(rows)
            wanted = table.read().where("channel_id = 'c777'")
            read[indexes] = scanned_rows(wanted)
            assert wanted.count() == 1
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert read["channel_id",] < read[()] / 3



def test_filters_reach_the_scan(spark, path):
    frame = spark.createDataFrame(
        [("v", "c", T0, "active", None, T0, 6, T0)], VIDEOS
    )
    frame.write.parquet(path("videos"))
    stored = spark.read.schema(VIDEOS).parquet(path("videos"))
    plan = plan_of(queue.due_videos(stored, T1, only_active=True).select("video_id"))
    assert "LessThanOrEqual(next_poll_at" in plan and "EqualTo(status,active)" in plan
    assert "ReadSchema: struct<video_id:string,status:string,next_poll_at:timestamp>" in plan


def test_leaderboard_keeps_only_the_top_of_each_task(spark):
    frame = spark.range(100).selectExpr("cast(id as string) as channel_id", "id as subscriber_count")
    assert "TakeOrderedAndProject" in plan_of(boards.leaderboard(frame, "subscriber_count"))


def test_database_options():
    database = Database("jdbc:x", "drv", "me", "pw")
    assert database.options("t") == {
        "url": "jdbc:x",
        "driver": "drv",
        "dbtable": "t",
        "user": "me",
        "password": "pw",
    }
    assert "password" not in Database("jdbc:x", "drv").options("t")
    assert Split("id", 0, 100, 8).options()["numPartitions"] == "8"
    assert tables.write_options(database, "t")["batchsize"] == "200"


def test_enriched_table_needs_its_own_name(spark):
    with pytest.raises(ValueError):
        jobs.enrich_channels(spark, Database("jdbc:x", "drv"), "channel_stats", "channel_stats")


def test_broker_options():
    options = broker_options("b:9092", "topic", "group")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    assert broker_options("b:9092", "topic", "group", 5)["maxOffsetsPerTrigger"] == "5"


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == configured
    assert session.scratch_path(spark, "x").startswith(configured)


def video_table(spark, path, *rows):
    table = VersionedTable(spark, path("videos"), VIDEOS, "video_id", 4)
    if rows:
        table.publish(spark.createDataFrame(list(rows), VIDEOS))
    return table


def test_refresh_quarantines_and_leaves_the_table_alone_without_good_rows(spark, path):
    table = VersionedTable(spark, path("c"), CHANNEL_STATS, "channel_id", 4)
    items = "n int, id string, snippet map<string,string>, statistics map<string,string>"
    bad = spark.createDataFrame([(1, "a", {}, {"viewCount": "x"})], items)
    assert jobs.refresh_channels(bad, table, T0, ["n"]) == {"affected": 0, "quarantined": 1}
    assert table.current() is None
    good = spark.createDataFrame(
        [(1, "a", {"title": "A"}, {"viewCount": "5"}), (2, "a", {"title": "B"}, {"viewCount": "-6"})],
        items,
    )
    assert jobs.refresh_channels(good, table, T0, ["n"]) == {"affected": 1, "quarantined": 1}
    assert table.read().first().channel_title == "A"


def test_channels_as_messages(spark, path):
    items = spark.createDataFrame(
        [("a", {"title": "A"}, {"viewCount": "5"}), ("b", {}, {"viewCount": "?"}), (None, {}, {})],
        "id string, snippet map<string,string>, statistics map<string,string>",
    )
    sent = jobs.publish_channels(items, T0, lambda df: df.write.parquet(path("topic")))
    rows = {r.key: r.value for r in spark.read.parquet(path("topic")).collect()}
    assert sent == 2 and set(rows) == {"a", None}
    assert '"total_views":5' in rows["a"] and '"country":""' in rows["a"]
    assert send_options("b:1", "t")["kafka.acks"] == "all"


def test_ingest_checks_the_parent(spark, path):
    channels = spark.createDataFrame(
        [("a", " x?list=UUa "), ("b", ""), ("c", None), (" d ", "UUd")],
        "channel_id string, uploads_playlist_id string",
    )
    uploads = spark.createDataFrame(
        [("UUa", i, f"v{i}", T0) for i in range(8)] + [("UUd", 0, "w", T0), ("UUz", 0, "z", T0)],
        "uploads_playlist_id string, position int, video_id string, published_at timestamp",
    )
    table = video_table(spark, path)
    # the cleaned id "d" is not in the channel table, which holds " d "
    assert jobs.ingest_uploads(channels, uploads, table, T0) == {"affected": 5, "quarantined": 1}
    rows = table.read().collect()
    assert sorted(r.video_id for r in rows) == ["v0", "v1", "v2", "v3", "v4"]
    assert {(r.channel_id, r.status, r.current_interval_hours) for r in rows} == {("a", "active", 1)}
    assert jobs.ingest_uploads(channels.limit(0), uploads, table, T0)["affected"] == 0
    assert table.current().version == 1


def test_collect_is_repeatable(spark, path):
    table = video_table(
        spark,
        path,
        ("v", "c", T0, "archived", None, T0, 6, T0),
        ("w", "c", T0, "active", None, T1 + timedelta(days=1), 6, T0),
        ("x", "c", T0, "active", None, None, 6, T0),
    )

    def measure(due):
        return due.select("video_id", *(F.lit(7).alias(n) for n in VIEW_TIMESERIES.names[2:]))

    before = table.read()
    assert jobs.collect_snapshots(table, measure, path("s"), T1) == 1
    rows = {r.video_id: r for r in table.read().collect()}
    assert rows["v"].next_poll_at == (T1 + timedelta(hours=6)).replace(tzinfo=None)
    assert rows["v"].status == "archived" and rows["w"] == before.where("video_id = 'w'").first()
    # the same run again, as after a crash between the two writes
    table.publish(before)
    assert jobs.collect_snapshots(table, measure, path("s"), T1) == 1
    assert series.read_series(spark, path("s"), VIEW_TIMESERIES).count() == 1
    version = table.current().version
    assert jobs.collect_snapshots(table, measure, path("s"), T1) == 1
    assert table.current().version == version


def test_a_repeated_collection_keeps_what_it_has(spark, path):
    table = video_table(spark, path, *((f"{i}", "c", T0, "active", None, T0, 6, T0) for i in range(5)))
    asked = []

    def some(left_out):
        def measure(due):
            asked.extend(r.video_id for r in due.collect())
            return due.where(F.col("video_id") != left_out).select(
                "video_id", *(F.lit(7).alias(n) for n in VIEW_TIMESERIES.names[2:])
            )

        return measure

    assert jobs.collect_snapshots(table, some("3"), path("s"), T1) == 4
    assert jobs.collect_snapshots(table, some("none"), path("s"), T1) == 5
    assert sorted(asked) == ["0", "1", "2", "3", "3", "4"]
    assert jobs.collect_snapshots(table, some("none"), path("s"), T1) == 5
    rows = series.read_series(spark, path("s"), VIEW_TIMESERIES).collect()
    assert sorted(r.video_id for r in rows) == ["0", "1", "2", "3", "4"]
    assert queue.due_videos(table.read(), T1).isEmpty()


def test_a_collection_goes_on_after_a_crash(spark, path, monkeypatch):
    table = video_table(spark, path, ("a", "c", T0, "active", None, T0, 6, T0))
    calls = []

    def measure(due):
        calls.append(due.count())
        return due.select("video_id", *(F.lit(7).alias(n) for n in VIEW_TIMESERIES.names[2:]))

    with monkeypatch.context() as broken:
        broken.setattr(jobs, "append_series", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.collect_snapshots(table, measure, path("s"), T1)
    assert jobs.collect_snapshots(table, measure, path("s"), T1) == 1
    assert calls == [1, 0]


def test_a_video_that_arrives_during_a_collection_stays(spark, path):
    table = video_table(spark, path, ("a", "c", T0, "active", None, T0, 6, T0))

    def measure(due):
        new = spark.createDataFrame([("b", "c", T0, 0)], "video_id string, channel_id string, published_at timestamp, position int")
        table.update(new, lambda rows: merge.upsert_queue(rows, new, T1, ("position",)))
        return due.select("video_id", *(F.lit(7).alias(n) for n in VIEW_TIMESERIES.names[2:]))

    jobs.collect_snapshots(table, measure, path("s"), T1)
    rows = {r.video_id: r.next_poll_at for r in table.read().collect()}
    assert set(rows) == {"a", "b"} and rows["a"] > rows["b"]


def test_a_repeated_series_run_leaves_no_stale_days(spark, path):
    series.append_series(snapshots(spark, 90), path("s"), T1)
    series.append_series(snapshots(spark, 30), path("s"), T1)
    assert series.read_series(spark, path("s"), VIEW_TIMESERIES).count() == 30
    series.append_series(snapshots(spark, 30).limit(0), path("s"), T1)
    assert series.read_series(spark, path("s"), VIEW_TIMESERIES, T1).count() == 0


def test_a_client_is_asked_once_per_batch(spark, path):
    due = [(f"{i:03d}", "c", T0, "active", None, T0, 6, T0) for i in range(120)]
    table = video_table(spark, path, *due)
    log = path("requests")

    class Client:
        def fetch(self, keys):
            with open(log, "a") as out:
                out.write(" ".join(keys) + "\n")
            return [
                {"video_id": k, "view_count": 1, "like_count": 2, "comment_count": 3}
                for k in keys
                if k != "007"
            ]

    result = T.StructType([f for f in VIEW_TIMESERIES.fields if f.name.endswith("_count")])

    def measure(rows):
        return lookup.enrich_batches(rows.coalesce(1), "video_id", Client, result).where("ok")

    assert jobs.collect_snapshots(table, measure, path("s"), T1) == 119
    with open(log) as lines:
        asked = [key for line in lines for key in line.split()]
    assert sorted(asked) == [row[0] for row in due]
    waiting = queue.due_videos(table.read(), T1).collect()
    assert [r.video_id for r in waiting] == ["007"]


def test_chunks_are_sent_whole_and_in_due_order(spark, path):
    due = [(f"{i:03d}", "c", T0, "active", None, T0 + timedelta(minutes=i * 37 % 430), 6, T0) for i in range(430)]
    table, log = video_table(spark, path, *due), path("requests")

    class Client:
        def fetch(self, keys):
            with open(log, "a") as out:
                out.write(f"{id(self)} " + " ".join(keys) + "\n")
            if keys[0] == order[100]:
                raise lookup.QuotaExhausted("no key left")
            return [{"video_id": k, "view_count": 1, "like_count": 2, "comment_count": 3} for k in keys]

    order = [row[0] for row in sorted(due, key=lambda row: (row[5], row[0]))]
    assert jobs.collect_snapshots(table, jobs.in_chunks(Client, senders=2), path("s"), T1) == 430 - 3 * 50 - 30
    with open(log) as lines:
        sent = [line.split() for line in lines]
    # chunks 0, 2, 4 ... belong to one client, which ran out at chunk 2; 1, 3 ... to the other
    chunks = [order[at : at + 50] for at in range(0, 430, 50)]
    by_client = {}
    for client, *keys in sent:
        by_client.setdefault(client, []).append(keys)
    assert sorted(by_client.values()) == sorted([[chunks[0], chunks[2]], chunks[1::2]])
    left = {r.video_id for r in queue.due_videos(table.read(), T1).collect()}
    assert left == {key for chunk in chunks[2::2] for key in chunk}


def test_trends_of_nothing(spark, path):
    empty = spark.createDataFrame([], VIDEO_TRENDS)
    assert series.append_trends(empty, path("t"), T0) == {"inserted_videos": 0}


def test_violation_report_of_other_key_types(spark):
    """Keys of two types come out as text; null keys are no duplicates, null parents are not looked up."""
    columns = "video_id bigint, channel_id string, published_at timestamp, status string, current_interval_hours int"
    rows = [(1, "a", T0, "active", 6), (1, "b", T0, "odd", 0), (None, None, T0, "active", 6), (None, "b", T0, "active", 6)]
    videos = spark.createDataFrame(rows, columns).withColumn("created_at", F.col("published_at"))
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "channel_id string")

    def report(df):
        found = quality.violation_report(df, "videos", "video_id", unique=True, parent=("channel_id", parents, "channel_id"))
        assert found.columns == ["rule", "key", "n"]
        return sorted((tuple(row) for row in found.collect()), key=str)

    none = [("channel_id:not_null", None, 1), ("video_id:not_null", None, 2)]
    want = [("channel_id:parent", "b", 2), ("current_interval_hours:range", "1", 1), ("status:domain", "1", 1), ("video_id:unique", "1", 2)]
    assert report(videos) == sorted(none + want, key=str)
    assert report(videos.limit(0)) == []
