"""Hot keys on the many-rows side of a join are split at run time."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from statflow.operators import lookup, quality

# a small input takes the place of a large one: the thresholds shrink with it
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key in SMALL:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def hot_children(spark, n=90_000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
    return spark.range(0, n, numPartitions=16).select(
        F.col("id"), hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )


def parents(spark):
    return spark.range(0, 4000, numPartitions=4).select(F.col("id").alias("k"))


def test_orphans(small):
    found = quality.orphans(hot_children(small), "k", parents(small), "k")
    assert len(found.collect()) == hot_children(small).where("k >= 4000").count()
    assert "skew=true" in plan_of(found)


def test_cascade(small):
    left = quality.cascade_delete(hot_children(small), "k", parents(small), "k")
    assert len(left.collect()) == hot_children(small).where("k >= 4000").count()
    assert "skew=true" in plan_of(left)


def test_missing_parents_are_counted_before_the_join(small):
    counted = quality.orphan_counts(hot_children(small), "k", parents(small), "k")
    plan = plan_of(counted)
    # the join is the last operator: what reaches it is one row per key
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")
    assert counted.count() == 1000


def test_requested_channels(small):
    asked = hot_children(small).select(F.col("k").cast("string").alias("channel_id"), "text")
    channels = parents(small).select(
        F.col("k").cast("string").alias("channel_id"),
        F.concat(F.lit("UU"), F.col("k").cast("string")).alias("uploads_playlist_id"),
    )
    found = asked.join(channels, "channel_id")
    rows = found.collect()
    assert "skew=true" in plan_of(found) and len(rows) == asked.where("cast(channel_id as int) < 4000").count()
    uploads = channels.select("uploads_playlist_id", F.lit(0).alias("position"), F.lit("v").alias("video_id"))
    details = small.createDataFrame([("v", 1)], "video_id string, n int")
    assert lookup.lookup_chain(asked, channels, uploads, details).count() == len(rows)


@pytest.fixture
def plain(spark):
    """Default thresholds of adaptive execution: alike rows of a hot key stay far below them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_rows_of_one_key_are_dealt_over_tasks(plain):
    n = 450_000
    videos = plain.range(0, n, numPartitions=8).selectExpr(
        "id", "case when id % 3 > 0 then 'hot' when id % 9 > 0 then string(id) end as video_id",
        "'c' as channel_id", "timestamp '2024-01-01 00:00:00' as published_at", "'active' as status",
        "6 as current_interval_hours", "timestamp '2024-01-01 00:00:00' as created_at",
    )
    checked = quality.with_all_violations(videos, "videos", key="video_id", order=("id",))
    per_task = [r["count"] for r in checked.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) == n and max(per_task) < n * 6 // 10  # the hot key has 300,000 rows
    assert quality.clean(checked).count() == 1 + 100_000
    assert [r.id for r in quality.clean(checked).where("video_id = 'hot'").collect()] == [1]
    told = quality.quarantined(checked).groupBy(F.col(quality.VIOLATED)[0].alias("rule")).count()
    assert {tuple(r) for r in told.collect()} == {("video_id:unique", 299_999), ("video_id:not_null", 50_000)}


def test_uploads_of_one_list_are_dealt_over_tasks(plain):
    uploads = plain.range(0, 450_000, numPartitions=8).selectExpr(
        "case when id % 3 > 0 then 'UU1' else string(id % 1000) end as uploads_playlist_id",
        "450000 - id as position", "string(id) as video_id",
    )
    asked = plain.createDataFrame([("UU1",), ("UU1",), ("3",), ("none",), (None,)], "uploads_playlist_id string")
    page = lookup.first_page(uploads, asked)
    rows = page.collect()
    hot = [i for i in range(449_999, 0, -1) if i % 3 > 0][:50]
    few = [i for i in range(449_999, 0, -1) if i % 3 == 0 and i % 1000 == 3][:50]
    assert sorted(int(r.video_id) for r in rows if r.uploads_playlist_id == "UU1") == sorted(hot)
    assert sorted(int(r.video_id) for r in rows if r.uploads_playlist_id == "3") == sorted(few)
    assert len(rows) == 100 and page.columns == uploads.columns
    assert "hashpartitioning(uploads_playlist_id#" in plan_of(page) and ", __share#" in plan_of(page)
