"""Distributed numbering and neighbours."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from statflow.operators import lookup, queue, trends
from statflow.plans import numbering

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_chunks_add_up_and_only_the_last_is_short(spark):
    rows = [(f"v{i:04d}", T0, T0 + timedelta(hours=i % 7)) for i in range(437)]
    due = spark.createDataFrame(rows, "video_id string, published_at timestamp, next_poll_at timestamp")
    chunks = queue.chunk_due(due.repartition(5), 50, partitions=6)
    got = {(r.batch_no, r.pos_in_batch): r.video_id for r in chunks.collect()}
    ordered = [v for v, _, _ in sorted(rows, key=lambda r: (r[2], r[0]))]
    assert got == {(i // 50, i % 50 + 1): v for i, v in enumerate(ordered)}


def test_chunks_of_nothing(spark):
    due = spark.createDataFrame([], "video_id string, published_at timestamp, next_poll_at timestamp")
    assert queue.chunk_due(due).count() == 0


def test_rows_are_not_gathered_for_numbering(spark):
    numbered = numbering.number_rows(spark.range(1000).withColumn("x", F.hash("id")), ["x", "id"], "n")
    plan = plan_of(numbered)
    gathered = plan[plan.index("SinglePartition") :]
    # the only gathering is over one count per partition
    assert plan.count("SinglePartition") == 1 and "partial_count" in gathered


def snapshots(spark, rows):
    return spark.createDataFrame(
        rows,
        "video_id string, scraped_at timestamp, view_count long, like_count long, comment_count long",
    )


def test_growth_edges(spark):
    rows = [
        ("a", T0, 10, 1, 1),
        ("a", T0 + timedelta(hours=2), 4, 1, 5),
        ("a", T0 + timedelta(hours=2), 6, 1, 5),
        ("b", T0, 1, 1, 1),
    ]
    out = trends.growth(snapshots(spark, rows)).orderBy("video_id", "scraped_at", "view_count").collect()
    assert [(r.view_count_delta, r.hours, r.views_per_hour) for r in out] == [
        (None, None, None),
        (-6, 2.0, -3.0),
        (2, 0.0, None),
        (None, None, None),
    ]


@pytest.mark.parametrize("batch", [1, 7, 10_000])
@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_ranges_give_the_neighbours_of_a_window(spark, partitions, batch):
    rows = [
        ("hot" if i % 3 else f"k{i % 11}", T0 + timedelta(minutes=i % 5), i % 2, i % 3, 0)
        for i in range(300)
    ]
    rows += [(None, T0, i % 2, 0, 0) for i in range(20)]
    frame = snapshots(spark, rows)
    window = Window.partitionBy("video_id").orderBy(*trends.SNAPSHOT_ORDER)
    wanted = frame.withColumns({f"prev_{c}": F.lag(c).over(window) for c in trends.SNAPSHOT_ORDER})
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(batch))
    try:
        got = numbering.with_previous(frame, "video_id", trends.SNAPSHOT_ORDER, trends.SNAPSHOT_ORDER, partitions)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select(got.columns).collect()))
    finally:
        spark.conf.unset(key)


def test_neighbours_of_nothing(spark):
    assert trends.growth(snapshots(spark, [])).count() == 0


def test_latest_snapshot_is_one_whole_row(spark):
    rows = [("a", T0, 5, None, 1), ("a", T0 + timedelta(hours=1), 6, None, 2), ("b", T0, 1, 1, 1)]
    out = {r.video_id: r for r in trends.latest_snapshot(snapshots(spark, rows)).collect()}
    assert (out["a"].view_count, out["a"].like_count, out["a"].comment_count) == (6, None, 2)


def test_first_rows_per_key_are_cut_before_the_shuffle(spark):
    frame = spark.range(1000).withColumn("k", F.col("id") % 3)
    cut = lookup.first_per_key(frame, "k", ["id"], 4)
    plan = plan_of(cut)
    assert plan.count("WindowGroupLimit") == 2 and ", Partial" in plan
    assert sorted(r.id for r in cut.collect()) == list(range(12))


def test_numbering_matches_a_window(spark):
    frame = spark.range(5000).select("id", (F.hash("id") % 50).alias("x"))
    wanted = frame.withColumn("n", F.row_number().over(Window.orderBy("x", "id")) - 1)
    got = numbering.number_rows(frame, ["x", "id"], "n", 9)
    assert got.exceptAll(wanted.select(got.columns)).isEmpty() and got.count() == 5000


@pytest.mark.parametrize("partitions", [1, 2, 7, 16])
def test_ranges_hold_the_order_and_equal_rows_are_spread(spark, partitions):
    rows = [("hot", 5)] * 3000 + [(f"k{n % 97}", n) for n in range(2000)] + [(None, 1), ("zz", None)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    found = numbering.dealt(df, ["k", "n"], "range", partitions)
    placed = found.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.k or "", r.n or 0) for r in placed) == sorted((k or "", n or 0) for k, n in rows)
    assert {r.range for r in placed} <= set(range(partitions)) and all(r.task == r.range for r in placed)
    ends: dict = {}
    for r in placed:
        value = (r.k is not None, r.k or "", r.n is not None, r.n or 0)
        low, high = ends.get(r.range, (value, value))
        ends[r.range] = min(low, value), max(high, value)
    in_order = [ends[n] for n in sorted(ends)]
    assert all(before[1] <= after[0] for before, after in zip(in_order, in_order[1:]))
    assert max(sum(r.range == n for r in placed) for n in ends) < 2.2 * len(rows) / partitions + 300


def test_ranges_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, n int")
    assert numbering.dealt(empty, ["k", "n"], "range", 4).count() == 0
    assert numbering.with_previous(empty, "k", ["n"], ["n"], 4).count() == 0


def test_growth_stays_in_the_jvm(spark):
    rows = [(f"v{n % 7}", T0 + timedelta(hours=n), n, n, n) for n in range(100)]
    plan = plan_of(trends.growth(snapshots(spark, rows)))
    assert "MapInArrow" not in plan and "shufflepartitionidpassthrough" in plan
    assert "hashpartitioning" not in plan
