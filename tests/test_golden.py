"""Hand-written rows for the edge of each rule."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from statflow.functions import bags, instants, ratios, text
from statflow.operators import boards, enrich, ledger, parse, shaping
from statflow.schemas import CHANNEL_ITEM, CHANNEL_STATS, VIDEO_ITEM
from statflow.sources.keys import explode_keys
from statflow.sources.replies import parse_replies
from statflow.sources.seeds import read_seeds

NOW = datetime(2024, 1, 3, 22, tzinfo=timezone.utc)


@pytest.fixture(autouse=True, params=["UTC", "America/New_York"])
def zone(spark, request):
    """No rule may depend on the zone of the session."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def one(spark, column, **values):
    """The value of an expression over one row of literals."""
    frame = spark.range(1).withColumns({k: F.lit(v) for k, v in values.items()})
    return frame.select(column.alias("x")).first().x


def test_ratios_guard_against_zero_and_null(spark):
    schema = "total_views long, subscriber_count long, video_count long"
    rows = spark.createDataFrame([(10, 0, 0), (10, None, None), (0, 5, 1)], schema)
    for rounded in (False, True):
        zero, null, no_views = enrich.with_engagement(rows, rounded).collect()
        assert (zero.avg_views_per_video, zero.views_per_subscriber) == (0.0, 0.0)
        assert zero.engagement_ratio == 0.0 and zero.size_tier == "Micro (<1K)"
        assert null.views_per_subscriber == 0.0 and null.size_tier == "Micro (<1K)"
        assert no_views.engagement_ratio == 0.0


def test_rounding(spark):
    schema = "total_views long, subscriber_count long, video_count long"
    rows = spark.createDataFrame([(1_000_000, 7, 3), (2**62, 1, 1)], schema)
    first, huge = enrich.with_engagement(rows, rounded=True).collect()
    assert first.avg_views_per_video == 333333.33
    assert first.views_per_subscriber == 142857.1429
    assert first.engagement_ratio == 0.0007
    assert huge.avg_views_per_video == float(2**62)


@pytest.mark.parametrize(
    "subscribers, label",
    [
        (999, "Micro (<1K)"),
        (1_000, "Small (1K–10K)"),
        (9_999, "Small (1K–10K)"),
        (10_000, "Mid (10K–100K)"),
        (100_000, "Large (100K–1M)"),
        (1_000_000, "Mega (1M+)"),
    ],
)
def test_tier_edges(spark, subscribers, label):
    assert one(spark, ratios.size_tier(F.lit(subscribers))) == label


@pytest.mark.parametrize(
    "published, days",
    [("2024-01-01T23:00:00Z", 1), ("2024-01-05T10:00:00Z", -1), (None, None)],
)
def test_age_counts_whole_days(spark, published, days):
    at = instants.parse_instant(F.lit(published).cast("string"))
    assert one(spark, instants.elapsed_days(at, instants.instant(NOW))) == days


@pytest.mark.parametrize(
    "hours, interval", [(-5, 1), (23.999, 1), (24, 6), (168, 24), (720, 168), (None, None)]
)
def test_poll_interval_edges(spark, hours, interval):
    seconds = None if hours is None else int(hours * 3600)
    published = F.timestamp_seconds(F.unix_timestamp(instants.instant(NOW)) - F.lit(seconds))
    got = one(spark, instants.poll_interval_hours(published, instants.instant(NOW)))
    assert got == interval


def test_wire_time_forms(spark):
    forms = ["", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.123456+00:00"]
    frame = spark.createDataFrame([(f,) for f in forms], "at string")
    parsed = frame.select(F.unix_micros(instants.parse_instant(F.col("at"))).alias("x")).collect()
    base = 1_704_067_200_000_000
    assert [r.x for r in parsed] == [None, base, base, base + 123456]


def test_iso_text_drops_a_zero_fraction(spark):
    assert one(spark, instants.iso_text(instants.instant(NOW))) == "2024-01-03T22:00:00+00:00"
    later = instants.instant(NOW) + F.expr("interval 5 microseconds")
    assert one(spark, instants.iso_text(later)) == "2024-01-03T22:00:00.000005+00:00"


@pytest.mark.parametrize(
    "thumbnails, url",
    [
        ('{"high":{"url":"h"},"default":{"url":"d"}}', "h"),
        ('{"medium":{"url":"m"}}', ""),
        ('{"maxres":{},"high":{"url":"h"}}', ""),
        ('{"default":{"url":"d","width":120}}', "d"),
        (None, ""),
    ],
)
def test_best_thumbnail(spark, thumbnails, url):
    sizes = F.from_json(F.lit(thumbnails).cast("string"), bags.THUMBNAILS)
    assert one(spark, bags.best_thumbnail(sizes)) == url


@pytest.mark.parametrize(
    "raw, key", [("https://x?list=UUa", "UUa"), ("UUa", "UUa"), ("a=", ""), (" \t UUa\n", "UUa")]
)
def test_playlist_key(spark, raw, key):
    assert one(spark, text.playlist_key(F.lit(raw))) == key


def test_clean_key_counts_characters(spark):
    assert one(spark, text.clean_key(F.lit(" " + "ü" * 70))) == "ü" * 64


@pytest.mark.parametrize(
    "secret, shown", [("AIzaSyD12345XYZ", "AIza…5XYZ"), ("abc", "****"), ("12345678", "****")]
)
def test_mask(spark, secret, shown):
    assert one(spark, text.mask_secret(F.lit(secret))) == shown


@pytest.mark.parametrize(
    "status, message, hit",
    [
        (403, "reason: quotaExceeded", True),
        (403, "RATELIMITEXCEEDED", True),
        (403, "forbidden", False),
        (400, "quotaExceeded", False),
        (403, None, False),
    ],
)
def test_quota_error(spark, status, message, hit):
    assert one(spark, text.is_quota_error(F.lit(status), F.lit(message).cast("string"))) is hit


def messages(spark, *bodies):
    rows = [(None, None if b is None else b.encode(), NOW) for b in bodies]
    return spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")


GOOD = '{"channel_id":"a","total_views":5,"processed_at":"2024-01-01T00:00:00Z"}'


def test_broken_messages_are_quarantined(spark):
    bad = [
        "{oops",
        '{"channel_id":"a","total_views":"12","processed_at":"2024-01-01T00:00:00Z"}',
        '{"channel_id":"a","total_views":1.5,"processed_at":"2024-01-01T00:00:00Z"}',
        None,
        '{"total_views":5,"processed_at":"2024-01-01T00:00:00Z"}',
        '{"channel_id":"a","processed_at":""}',
    ]
    checked = parse.parse_checked(messages(spark, GOOD, *bad))
    assert [r.channel_id for r in parse.usable(checked).collect()] == ["a"]
    reasons = [r.reject_reason for r in parse.rejected(checked).collect()]
    assert reasons == ["corrupt", "corrupt", "corrupt", "no_value", "no_key", "no_event_time"]
    lenient = parse.parse_checked(messages(spark, GOOD, *bad), require_time=False)
    assert parse.usable(lenient).count() == 2


def test_good_rows_are_the_same_with_and_without_the_check(spark):
    raw = messages(spark, GOOD)
    assert parse.usable(parse.parse_checked(raw)).collect() == parse.parse_messages(raw).collect()


def test_wire_frame_writes_nulls_and_drops_the_empty_key(spark):
    rows = spark.createDataFrame([("", None), ("k", 1)], "channel_id string, total_views long")
    empty, keyed = parse.wire_frame(rows).collect()
    assert empty.key is None and empty.value == '{"channel_id":"","total_views":null}'
    assert keyed.key == "k"


def test_missing_null_and_empty_differ(spark):
    body = (
        '{"items":[{"id":"a","snippet":{"title":null,"country":""},"statistics":{"viewCount":"7"}},'
        '{"id":"b","statistics":{"viewCount":null}},{"snippet":{}}]}'
    )
    frame = spark.createDataFrame([(body,), ("{}",), ('{"items":[]}',)], "body string")
    items = parse_replies(frame, "body", CHANNEL_ITEM)
    a, b, c = parse.flatten_channels(items, NOW).collect()
    assert (a.channel_title, a.channel_description, a.country) == (None, "", "")
    assert (a.total_views, a.subscriber_count, a.bad_fields) == (7, 0, [])
    assert (b.total_views, b.bad_fields) == (None, ["total_views"])
    assert c.channel_id == "" and c.processed_at == "2024-01-03T22:00:00+00:00"
    assert parse.readable(parse.flatten_channels(items, NOW)).count() == 2
    assert parse.unreadable(parse.flatten_channels(items, NOW)).count() == 1


def test_video_defaults(spark):
    frame = spark.createDataFrame([('{"items":[{}]}',)], "body string")
    row = parse.flatten_videos(parse_replies(frame, "body", VIDEO_ITEM), NOW).first()
    assert (row.video_id, row.published_at, row.youtube_category_id) == (None, None, None)
    assert (row.tags, row.topic_categories, row.live_broadcast_content) == ([], [], "none")
    assert (row.licensed_content, row.embeddable, row.public_stats_viewable) == (False, True, True)
    assert (row.view_count, row.thumbnail_url, row.duration) == (0, "", "")
    assert row.project_category == "Data Science & AI"


def test_key_list_keeps_order_and_repeats(spark):
    frame = spark.createDataFrame([(1, " b, ,a,\tb\n,")], "id int, keys string")
    rows = explode_keys(frame, "keys").collect()
    assert [(r.position, r.key) for r in rows] == [(0, "b"), (2, "a"), (3, "b")]


def test_default_only_for_an_absent_column(spark):
    frame = spark.createDataFrame([("c", None)], "channel_id string, total_views long")
    row = shaping.fill_defaults(frame, "channel_stats", NOW).first()
    assert row.total_views is None and row.subscriber_count == 0
    assert row.created_at == row.processed_at and row.created_at is not None
    assert set(row.asDict()) == set(CHANNEL_STATS.names)


def test_seed_file(spark, tmp_path):
    header = "channel_id,channel_title,country,subscriber_count,total_views,uploads_playlist_id\n"
    file = tmp_path / "seeds.csv"
    file.write_text(header + 'a,"Ü, ""x""",,5,,\nb,t,"",1,2," UUb "\n', encoding="utf-8")
    a, b = read_seeds(spark, str(file)).collect()
    assert (a.channel_title, a.country, a.total_views, a.uploads_playlist_id) == ('Ü, "x"', None, None, None)
    assert (b.country, b.uploads_playlist_id) == ("", " UUb ")


def test_row_ids_are_unique(spark):
    frame = shaping.with_row_id(spark.range(0, 1000, numPartitions=7), "row_id")
    assert frame.columns == ["row_id", "id"]
    assert frame.select("row_id").distinct().count() == 1000


def test_leaderboard_puts_nulls_last_and_breaks_ties(spark):
    rows = [("b", 5), ("a", 5), ("z", None), ("c", 9)]
    frame = spark.createDataFrame(rows, "channel_id string, subscriber_count long")
    top = boards.leaderboard(frame, "subscriber_count", 4).collect()
    assert [r.channel_id for r in top] == ["c", "a", "b", "z"]


def test_quota_day_turns_at_pacific_midnight(spark):
    rows = [
        (datetime(2024, 7, 1, 6, 59, 59, tzinfo=timezone.utc), "k", 200, "ok", 3),
        (datetime(2024, 7, 1, 7, 0, 0, tzinfo=timezone.utc), "k", 403, "quotaExceeded", 9),
        (datetime(2024, 12, 1, 7, 59, 0, tzinfo=timezone.utc), "k", 200, "ok", 20_000),
    ]
    log = spark.createDataFrame(rows, "ts timestamp, api_key string, status int, message string, units int")
    days = ledger.quota_ledger(log).orderBy("quota_day").collect()
    assert [str(r.quota_day) for r in days] == ["2024-06-30", "2024-07-01", "2024-11-30"]
    assert [(r.exhausted, r.remaining) for r in days] == [(False, 9997), (True, 0), (False, 0)]


def test_steps_across_a_clock_change(spark):
    before = instants.instant("2024-03-09T20:00:00")
    after = one(spark, instants.iso_text(instants.hours_later(before, F.lit(168))))
    assert after == "2024-03-16T20:00:00+00:00"
    week_later = instants.instant("2024-03-16T19:59:59")
    assert one(spark, instants.elapsed_days(before, week_later)) == 6
    earlier = instants.earlier(instants.instant("2024-03-16T20:00:00"), timedelta(days=7))
    assert one(spark, instants.iso_text(earlier)) == "2024-03-09T20:00:00+00:00"
    # 06:30 and 05:30 UTC show the same time of day in New York on that day
    twice = instants.instant("2024-11-03T06:30:00")
    assert one(spark, instants.iso_text(twice)) == "2024-11-03T06:30:00+00:00"
    assert str(one(spark, instants.utc_date(instants.instant("2024-01-02T01:00:00")))) == "2024-01-02"
