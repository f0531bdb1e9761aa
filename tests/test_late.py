"""Late rows: each message is stored, late, or a copy of one that is; none is lost."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.sources.events import STREAM_FRAME, read_event_files
from statflow.streaming import late, run
from statflow.streaming.sinks import AppendSink, FolderStore

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(key, minutes, views=1):
    at = T0 + timedelta(minutes=minutes)
    body = {"channel_id": key, "total_views": views, "processed_at": at.isoformat()}
    return (key.encode(), json.dumps(body).encode(), at)


class Run:
    def __init__(self, spark, home, mode="redelivered"):
        self.spark, self.home, self.mode, self.dropped = spark, home, mode, 0
        self.sink = AppendSink(FolderStore(f"{home}/sink"), "snapshots", "late")
        self.handler = late.keeping_late(self.sink, f"{home}/checkpoint")

    def feed(self, *messages):
        frame = self.spark.createDataFrame(list(messages), STREAM_FRAME)
        frame.coalesce(1).write.mode("append").parquet(f"{self.home}/in")
        rows = late.snapshots_with_candidates(read_event_files(self.spark, f"{self.home}/in"), self.mode)
        self.schema = T.StructType([f for f in rows.schema.fields if f.name != late.CANDIDATE])
        self.schema = self.schema.add(late.LATE_MS, T.LongType())
        query = run.start(rows, self.handler, f"{self.home}/checkpoint", trigger=None)
        query.awaitTermination()
        self.dropped += run.late_rows(json.loads(p.json) for p in query.recentProgress)
        return self

    def stored(self):
        return self.sink.read(self.spark, self.schema)


def told(df, *more):
    minutes = (F.unix_seconds("processed_at") - int(T0.timestamp())) / 60
    return sorted(tuple(r) for r in df.select("channel_id", minutes.cast("int"), *more).collect())


def test_late_rows_say_by_how_much(spark, tmp_path):
    stream = Run(spark, str(tmp_path))
    stream.feed(message("a", 0), message("a", 60))  # watermark 50 from here on
    stream.feed(message("a", 50), message("b", 51), message("c", 20, 7), message("c", 20, 8), message("a", 0))
    stored = stream.stored()
    assert told(late.on_time(stored)) == [("a", 0), ("a", 60), ("b", 51)]
    # exactly at the watermark is late; copies are late as often as they come
    minute = 60_000
    assert told(late.late(stored), late.LATE_MS) == [
        ("a", 0, 50 * minute), ("a", 50, 0), ("c", 20, 30 * minute), ("c", 20, 30 * minute)
    ]
    # the snapshot that is stored is not lost, the others are there once; ties by the counters
    assert told(late.lost(stored), "total_views", late.LATE_MS) == [("a", 50, 1, 0), ("c", 20, 7, 30 * minute)]
    assert stream.dropped == 4


def test_nothing_is_late_in_the_first_batch(spark, tmp_path):
    stream = Run(spark, str(tmp_path)).feed(message("a", 0), message("b", 9000), message("c", -9000))
    assert late.late(stream.stored()).count() == 0
    assert told(late.on_time(stream.stored())) == [("a", 0), ("b", 9000), ("c", -9000)]


def test_times_before_1970_are_late_at_once(spark, tmp_path):
    stream = Run(spark, str(tmp_path)).feed(message("a", 0), message("b", -60_000_000))
    assert told(late.late(stream.stored())) == [("b", -60_000_000)]
    assert stream.dropped == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_every_message_is_somewhere(spark, tmp_path, seed):
    rng = random.Random(seed)
    stream, sent = Run(spark, str(tmp_path)), []
    for start in range(0, 120, 30):
        feed = [(rng.choice("abc"), start + rng.randint(-60, 30)) for _ in range(40)]
        sent += feed
        stream.feed(*(message(*m) for m in feed))
    stored = stream.stored()
    on_time, dropped = told(late.on_time(stored)), told(late.late(stored))
    assert len(dropped) == stream.dropped > 0  # just what the operator says it dropped
    assert len(set(on_time)) == len(on_time)
    assert set(on_time) | set(dropped) == set(sent)
    assert sorted(on_time + told(late.lost(stored))) == sorted(set(sent))


def test_a_batch_delivered_again_finds_the_same_rows_late(spark, tmp_path):
    stream = Run(spark, str(tmp_path)).feed(message("a", 60))
    store = stream.handler

    def store_and_die(batch, batch_id):
        store(batch, batch_id)
        raise RuntimeError("died after the write")

    stream.handler = store_and_die
    with pytest.raises(StreamingQueryException):
        stream.feed(message("a", 5), message("a", 70))
    # a new process: nothing is remembered but the ledger and the checkpoint
    again = Run(spark, str(tmp_path)).feed(message("b", 80))
    assert told(late.on_time(again.stored())) == [("a", 60), ("a", 70), ("b", 80)]
    assert told(late.late(again.stored()), late.LATE_MS) == [("a", 5, 45 * 60_000)]


def test_empty_batches(spark, tmp_path):
    stream = Run(spark, str(tmp_path)).feed(message("a", 0)).feed()
    assert told(stream.stored()) == [("a", 0)]
    assert late.lost(stream.stored()).count() == 0


def test_a_span_of_time_is_dealt_over_all_tasks(spark, tmp_path):
    from statflow.catalog import fixtures, parsing, registry, storage

    # a table in the order of time, ten days a file
    events = spark.range(0, 3000, numPartitions=3).selectExpr(
        "id as event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 14) as ts",
        "id % 7 as user_id", "'view' as event_type", "double(id) as value", "'' as props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    t = registry.Tables(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, sent in (("sent", storage._sent(t)), ("messages", parsing.messages(storage._dealt(t)))):
            time = "at" if name == "sent" else "timestamp"
            day = F.dayofmonth(time)
            sent.where(day <= 10).write.parquet(str(tmp_path / name))
            landed = spark.read.parquet(str(tmp_path / name))
            per_file = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
            assert sum(per_file) == sum(1 for n in range(3000) if n * 14 < 10 * 24 * 60)
            assert max(per_file) < sum(per_file) / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = F.get_json_object("value", "$.processed_at").cast("timestamp")
    sent = storage._sent(t)
    assert sent.where(written == F.col("at")).count() == fixtures.fixture(t, "channel_obs").count() == 3000
