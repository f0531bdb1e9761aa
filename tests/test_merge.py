"""Upserts, folds, keyed updates, quality splits."""

import random
from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statflow.operators import merge, quality
from statflow.schemas import CHANNEL_STATS_V1, VIDEOS

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T1 = T0 + timedelta(days=1)
BATCH = (
    "n int, channel_id string, channel_title string, channel_description string, "
    "published_at timestamp, country string, total_views long, subscriber_count long, "
    "video_count long, processed_at timestamp"
)


def batch_row(n, key, title, country, views, at=T1):
    return (n, key, title, None, at, country, views, 0, 0, at)


def channels(spark, *rows):
    return spark.createDataFrame(list(rows), CHANNEL_STATS_V1)


def channel(key, title, country, views, at=T0):
    return (key, title, "about", at, country, views, 0, 0, at, at)


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_repeated_new_key_takes_first_and_last(spark):
    batch = spark.createDataFrame(
        [batch_row(2, "n", "new", "DE", 2), batch_row(1, "n", "old", "US", 1)], BATCH
    )
    row = merge.upsert_channels(channels(spark), batch, T1, ["n"]).first()
    assert (row.channel_title, row.total_views, row.country) == ("new", 2, "US")
    assert row.created_at == T1.replace(tzinfo=None)


def test_known_key_keeps_first_wins_columns_and_takes_nulls(spark):
    target = channels(spark, channel("k", "t", "US", 5), channel("x", "stays", "FR", 1))
    batch = spark.createDataFrame([batch_row(1, "k", None, "DE", 9)], BATCH)
    rows = by_key(merge.upsert_channels(target, batch, T1, ["n"]), "channel_id")
    k = rows["k"]
    assert (k.country, k.total_views, k.channel_title, k.channel_description) == ("US", 9, None, None)
    assert k.created_at == k.published_at == T0.replace(tzinfo=None)
    assert rows["x"].channel_title == "stays" and len(rows) == 2


def test_arrival_decides_unless_newer_only(spark):
    target = channels(spark, channel("k", "t", "US", 5, T1))
    batch = spark.createDataFrame([batch_row(1, "k", "late", "US", 1, T0)], BATCH)
    plain = merge.upsert_channels(target, batch, T1, ["n"]).first()
    guarded = merge.upsert_channels(target, batch, T1, ["n"], newer_only=True).first()
    assert plain.channel_title == "late" and guarded.channel_title == "t"


def test_upsert_twice_is_upsert_once(spark):
    target = channels(spark, channel("k", "t", "US", 5))
    batch = spark.createDataFrame(
        [batch_row(i, random.Random(i).choice("kabc"), f"t{i}", "DE", i) for i in range(40)], BATCH
    )
    once = merge.upsert_channels(target, batch, T1, ["n"])
    twice = merge.upsert_channels(once, batch, T1, ["n"])
    assert sorted(once.collect()) == sorted(twice.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9) | st.none()), min_size=1, max_size=20))
def test_fold_does_not_depend_on_partitioning(spark, rows):
    numbered = [(i, key, value) for i, (key, value) in enumerate(rows)]
    frame = spark.createDataFrame(numbered, "n int, k string, v int")
    wanted = {}
    for n, key, value in numbered:
        wanted.setdefault(key, [value, None])[1] = value
    for parts in (1, 5):
        shuffled = frame.repartition(parts, F.hash("n"))
        folded = merge.fold_batch(
            shuffled.withColumn("w", F.col("v")), "k", ["n"], first=["w"], last=["v"]
        )
        assert {r.k: [r.w, r.v] for r in folded.collect()} == wanted


def queue_row(key, status, interval, next_poll=T0):
    return (key, "c", T0, status, T0, next_poll, interval, T0)


def test_queue_upsert_wakes_a_video_and_keeps_its_interval(spark):
    target = spark.createDataFrame([queue_row("v", "archived", 168)], VIDEOS)
    batch = spark.createDataFrame(
        [("v", "d", T1), ("w", "d", T1)], "video_id string, channel_id string, published_at timestamp"
    )
    rows = by_key(merge.upsert_queue(target, batch, T1, ["published_at"]), "video_id")
    at = T1.replace(tzinfo=None)
    v, w = rows["v"], rows["w"]
    assert (v.status, v.current_interval_hours, v.channel_id) == ("active", 168, "d")
    assert v.last_polled_at == v.next_poll_at == at and v.created_at == T0.replace(tzinfo=None)
    assert (w.status, w.current_interval_hours, w.created_at) == ("active", 1, at)


def test_cadence_touches_measured_rows_only(spark):
    target = spark.createDataFrame(
        [queue_row("v", "deleted", 6), queue_row("u", "active", 6)], VIDEOS
    )
    measured = spark.createDataFrame(
        [("v", T0), ("unknown", T0)], "video_id string, published_at timestamp"
    )
    rows = by_key(merge.apply_cadence(target, measured, T1), "video_id")
    assert set(rows) == {"u", "v"}
    assert rows["u"] == target.where("video_id = 'u'").first()
    v = rows["v"]
    assert (v.status, v.current_interval_hours) == ("deleted", 6)
    assert v.next_poll_at == (T1 + timedelta(hours=6)).replace(tzinfo=None)
    # an empty measurement changes nothing
    assert sorted(merge.apply_cadence(target, measured.limit(0), T1).collect()) == sorted(target.collect())


def test_clean_and_quarantine_make_up_the_input(spark):
    rows = [
        ("a", "c", T0, "active", T0, T0, 1, T0),
        ("a", "c", T0, "active", T0, T0, 2, T0),
        ("b", "x", T0, "active", T0, T0, 1, T0),
        ("c" * 65, "c", T0, "odd", T0, T0, 0, T0),
        (None, "c", None, "active", T0, T0, None, T0),
    ]
    frame = spark.createDataFrame(rows, VIDEOS)
    parent = spark.createDataFrame([("c",), ("c",)], "channel_id string")
    checked = quality.with_all_violations(
        frame, "videos", "video_id", ["current_interval_hours"], ("channel_id", parent, "channel_id")
    )
    good, bad = quality.clean(checked), quality.quarantined(checked)
    assert sorted(map(str, good.union(bad.drop("violated")).collect())) == sorted(map(str, frame.collect()))
    assert [r.current_interval_hours for r in good.collect()] == [1]
    found = sorted(tuple(sorted(r.violated)) for r in bad.collect())
    assert found == [
        ("channel_id:parent",),
        ("current_interval_hours:not_null", "published_at:not_null", "video_id:not_null"),
        ("current_interval_hours:range", "status:domain", "video_id:length"),
        ("video_id:unique",),
    ]


ARRIVALS = st.lists(
    st.tuples(
        st.sampled_from("abcd"),
        st.sampled_from(["US", "DE", None]),
        st.integers(0, 99) | st.none(),
        st.integers(0, 5),
    ),
    max_size=15,
)


def row_by_row(known, arrivals):
    """The same merge, one statement per record."""
    state = {k: dict(v) for k, v in known.items()}
    for key, country, views, hour in arrivals:
        if key not in state:
            state[key] = {"country": country, "views": views, "hour": hour}
        else:
            state[key].update(views=views, hour=hour)
    return state


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(ARRIVALS, ARRIVALS)
def test_upsert_is_the_row_by_row_merge(spark, before, arrivals):
    def frame(rows):
        made = [
            batch_row(n, key, None, country, views, T0 + timedelta(hours=hour))
            for n, (key, country, views, hour) in enumerate(rows)
        ]
        return spark.createDataFrame(made, BATCH).repartition(3)

    known = row_by_row({}, before)
    target = merge.upsert_channels(channels(spark), frame(before), T0, ["n"])
    merged = merge.upsert_channels(target, frame(arrivals), T1, ["n"])
    got = {
        r.channel_id: {
            "country": r.country,
            "views": r.total_views,
            "hour": int((r.processed_at - T0.replace(tzinfo=None)).total_seconds() // 3600),
        }
        for r in merged.collect()
    }
    assert got == row_by_row(known, arrivals)
    created = {r.channel_id: r.created_at for r in merged.collect()}
    assert {k for k, at in created.items() if at == T0.replace(tzinfo=None)} == set(known)


def test_newest_row_wins_over_later_arrival(spark):
    target = channels(spark, channel("a", "old", "US", 1, T0 + timedelta(hours=5)))
    rows = [batch_row(1, "a", "ten", "US", 10, T0 + timedelta(hours=10)), batch_row(2, "a", "three", "US", 3, T0 + timedelta(hours=3))]
    merged = merge.upsert_channels(target, spark.createDataFrame(rows, BATCH), T1, ["n"], newer_only=True)
    assert merged.first().total_views == 10


def test_rows_without_a_key_are_not_stored(spark):
    batch = spark.createDataFrame([batch_row(1, None, "x", "US", 1), batch_row(2, "a", "y", "US", 2)], BATCH)
    once = merge.upsert_channels(channels(spark), batch, T1, ["n"])
    assert once.count() == 1 and merge.upsert_channels(once, batch, T1, ["n"]).count() == 1
