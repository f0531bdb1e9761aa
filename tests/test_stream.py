"""The snapshot stream: duplicates, late rows, replays, parity with the batch."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from statflow.operators import merge, parse
from statflow.plans.publish import VersionedTable
from statflow.schemas import CHANNEL_STATS_V1
from statflow.session import STREAM_SETTINGS
from statflow.sources.events import STREAM_FRAME, read_event_files
from statflow.streaming import dedup, run
from statflow.streaming.sinks import AppendSink, FolderStore, UnknownCheckpoint
from statflow.streaming.state import read_state, start_state

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(key, hours, views=1, arrival=None, **more):
    at = T0 + timedelta(hours=hours)
    body = {"channel_id": key, "total_views": views, "processed_at": at.isoformat(), **more}
    return (key.encode(), json.dumps(body).encode(), arrival or at)


class Run:
    """A stream over a folder; each ``feed`` lands one file and runs until it is read."""

    def __init__(self, spark, home, mode="redelivered"):
        self.spark, self.home, self.mode = spark, home, mode
        self.rows, self.progress = [], []
        self.handler = self.keep

    def keep(self, batch, batch_id):
        self.rows += [(r.channel_id, r.processed_at) for r in batch.collect()]

    def feed(self, *messages):
        frame = self.spark.createDataFrame(list(messages), STREAM_FRAME)
        frame.coalesce(1).write.mode("append").parquet(f"{self.home}/in")
        stream = run.snapshots(read_event_files(self.spark, f"{self.home}/in", 1), self.mode)
        query = run.start(stream, self.handler, f"{self.home}/checkpoint", trigger=None)
        query.awaitTermination()
        self.progress += [json.loads(p.json) for p in query.recentProgress]
        return self


def hours(rows):
    return sorted((k, int((t - T0.replace(tzinfo=None)).total_seconds() // 3600)) for k, t in rows)


FEEDS = [
    [message("a", 0), message("a", 0)],
    [message("a", 6)],
    [message("a", 6), message("a", 12)],
    [message("c", 1 / 60), message("a", 12)],
]


@pytest.mark.parametrize("settings", [{}, STREAM_SETTINGS], ids=["default", "large_state"])
def test_redelivered_rows_go_and_late_rows_go_and_snapshots_stay(spark, tmp_path, settings):
    stream = Run(spark, str(tmp_path))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for feed in FEEDS:
            stream.feed(*feed)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert hours(stream.rows) == [("a", 0), ("a", 6), ("a", 12)]
    assert run.late_rows(stream.progress) == 1
    assert run.state_rows(stream.progress) == 1


def test_first_ever_loses_the_series(spark, tmp_path):
    stream = Run(spark, str(tmp_path), "first_ever")
    for feed in FEEDS:
        stream.feed(*feed)
    # the late row is dropped as well: its event time is behind the watermark
    assert hours(stream.rows) == [("a", 0)]
    assert run.state_rows(stream.progress) == 1


def test_within_watermark_forgets_after_the_delay(spark, tmp_path):
    stream = Run(spark, str(tmp_path), "within_watermark")
    stream.feed(message("a", 0), message("a", 0))
    stream.feed(message("b", 6))
    stream.feed(message("a", 12))
    assert hours(stream.rows) == [("a", 0), ("a", 12), ("b", 6)]


def test_unknown_mode(spark):
    with pytest.raises(KeyError):
        dedup.deduplicate(spark.range(1), "some")


def test_rows_without_event_time_do_not_reach_the_state(spark, tmp_path):
    stream = Run(spark, str(tmp_path))
    broken = (b"x", b'{"channel_id":"x","processed_at":""}', T0)
    stream.feed(message("a", 0), broken, (None, b"{", T0), (None, None, T0))
    assert hours(stream.rows) == [("a", 0)]
    assert run.state_rows(stream.progress) == 1


def test_zoneless_event_time_is_cast(spark):
    frame = spark.sql("select 'a' as channel_id, timestamp_ntz '2024-01-01 00:00:00' as processed_at")
    assert dedup.redelivered(frame.union(frame)).count() == 1


def test_stream_and_batch_agree(spark, tmp_path):
    stream = Run(spark, str(tmp_path))
    messages = [message(k, h, views=h, country="US") for k in "abc" for h in range(5)] * 2
    seen = []
    stream.handler = lambda batch, _: seen.extend(batch.drop("kafka_timestamp").collect())
    stream.feed(*messages)
    batch = run.snapshots(spark.createDataFrame(messages, STREAM_FRAME)).drop("kafka_timestamp")
    assert sorted(seen, key=str) == sorted(batch.collect(), key=str) and len(seen) == 15


def test_append_sink_ignores_a_batch_delivered_again(spark, tmp_path):
    sink = AppendSink(FolderStore(str(tmp_path)), "rows", "s")
    frame = spark.range(5)
    sink(frame, 0)
    sink(frame, 0)
    # after a restart, and within one process
    AppendSink(FolderStore(str(tmp_path)), "rows", "s")(frame, 0)
    sink(spark.range(5, 7), 1)
    sink(spark.range(5, 7), 1)
    sink(spark.range(0), 2)
    assert sorted(r.id for r in sink.read(spark, frame.schema).collect()) == list(range(7))
    ledger = {r.batch_id: r.rows for r in sink.committed(spark).collect()}
    assert ledger == {0: 5, 1: 2}


def test_append_sink_hides_an_attempt_that_died(spark, tmp_path):
    class Dying(FolderStore):
        def append(self, df, table):
            if table.endswith("_commits"):
                raise OSError("lost")
            super().append(df, table)

    frame = spark.range(5)
    with pytest.raises(OSError):
        AppendSink(Dying(str(tmp_path)), "rows", "s")(frame, 0)
    sink = AppendSink(FolderStore(str(tmp_path)), "rows", "s")
    assert sink.read(spark, frame.schema).count() == 0
    sink(frame, 0)
    assert sink.read(spark, frame.schema).count() == 5
    assert AppendSink(FolderStore(str(tmp_path)), "rows", "other").read(spark, frame.schema).count() == 0


class State(Run):
    """Each ``feed`` starts the stream again from its checkpoint."""

    def __init__(self, spark, home, newer_only=False, handler=None):
        super().__init__(spark, home)
        self.newer_only, self.handler = newer_only, handler

    def feed(self, *messages):
        frame = self.spark.createDataFrame(list(messages), STREAM_FRAME)
        frame.coalesce(1).write.mode("append").parquet(f"{self.home}/in")
        stream = run.snapshots(read_event_files(self.spark, f"{self.home}/in", 1), self.mode)
        query = start_state(stream, f"{self.home}/checkpoint", self.newer_only, trigger=None, handler=self.handler)
        query.awaitTermination()
        return self

    @property
    def table(self):
        return {r.channel_id: r for r in read_state(self.spark, f"{self.home}/checkpoint").collect()}


def test_state_over_several_starts(spark, tmp_path):
    stream = State(spark, str(tmp_path))
    assert stream.table == {}
    stream.feed(message("a", 0, 1, country="US"), message("b", 0, 1))
    assert {k: r.total_views for k, r in stream.table.items()} == {"a": 1, "b": 1}
    stream.feed(message("a", 1, 5, country="DE"))
    stream.feed(message("b", 2, 6), message("a", 1, 5, country="DE"))
    rows = stream.table
    assert {k: r.total_views for k, r in rows.items()} == {"a": 5, "b": 6}
    # the first arrival decides these, as with upserts
    assert rows["a"].country == "US" and rows["a"].created_at == T0.replace(tzinfo=None)


def test_state_without_new_messages(spark, tmp_path):
    stream = State(spark, str(tmp_path)).feed(message("a", 0, 3))
    stream.feed((None, b"{", T0))
    assert stream.table["a"].total_views == 3 and len(stream.table) == 1


def test_arrival_or_event_time_decides(spark, tmp_path):
    def arriving(n, hour):
        return message("a", hour, 1, arrival=T0 + timedelta(days=9, hours=n), country=f"C{hour}")

    both = {}
    for newer_only in (False, True):
        home = str(tmp_path / str(newer_only))
        # within the delay of the watermark, or they would be too late
        stream = State(spark, home, newer_only)
        stream.feed(*(arriving(n, hour / 60) for n, hour in enumerate([3, 1, 7, 2, 5])))
        both[newer_only] = stream.table["a"]
    assert both[False].processed_at == (T0 + timedelta(minutes=5)).replace(tzinfo=None)
    assert both[True].processed_at == (T0 + timedelta(minutes=7)).replace(tzinfo=None)
    assert {row.country for row in both.values()} == {f"C{3 / 60}"}


def test_state_is_what_upserts_give(spark, tmp_path):
    stream = State(spark, str(tmp_path))
    table = VersionedTable(spark, str(tmp_path / "table"), CHANNEL_STATS_V1, "channel_id", 4)
    feeds = [(3, None), (4, 5), (None, 6), (9, 9), (12, None)]
    for batch, (a, b) in enumerate(feeds):
        feed = [message(k, v, v, country=f"C{batch}", channel_title=k) for k, v in (("a", a), ("b", b)) if v is not None]
        stream.feed(*feed)
        rows = parse.parse_messages(spark.createDataFrame(feed, STREAM_FRAME)).withColumn("created_at", F.col("processed_at"))
        table.update(rows, lambda own: merge.upsert_channels(own, rows, T0, ("kafka_timestamp",)))
    want = {r.channel_id: r for r in table.read().drop("created_at").collect()}
    got = {r.channel_id: r for r in read_state(spark, f"{tmp_path}/checkpoint").drop("created_at").collect()}
    assert got == want and len(got) == 2


def test_changed_channels_go_to_a_handler(spark, tmp_path):
    seen = []
    stream = State(spark, str(tmp_path), handler=lambda batch, n: seen.append({r.channel_id: r.total_views for r in batch.collect()}))
    stream.feed(message("a", 0, 1), message("b", 0, 1))
    stream.feed(message("b", 1, 4))
    assert [one for one in seen if one] == [{"a": 1, "b": 1}, {"b": 4}]
    assert spark.conf.get(next(iter(STREAM_SETTINGS)), None) != STREAM_SETTINGS[next(iter(STREAM_SETTINGS))]


def test_a_new_checkpoint_under_an_old_name_is_refused(spark, tmp_path):
    sinks = {"rows": AppendSink(FolderStore(str(tmp_path / "rows")), "t", "s")}
    for name, sink in sinks.items():
        first = Run(spark, str(tmp_path / name))
        first.handler = sink
        first.feed(message("a", 0, 1))
        first.feed(message("a", 1, 5))  # the same checkpoint goes on
        again = Run(spark, str(tmp_path / f"{name}2"))
        again.handler = sink
        with pytest.raises(Exception, match="UnknownCheckpoint"):
            again.feed(message("a", 2, 6))
    with pytest.raises(UnknownCheckpoint):
        AppendSink(FolderStore(str(tmp_path / "rows")), "t", "s")(spark.range(1), 0)
