"""Requests in batches, with retries."""

import json
import os

from pyspark.sql import types as T

from statflow.operators import lookup

RESULT = T.StructType([T.StructField("n", T.LongType())])


def ids(spark, count, parts=1):
    frame = spark.createDataFrame([(f"{i:03d}",) for i in range(count)], "id string")
    return frame.coalesce(parts) if parts == 1 else frame.repartition(parts)


def client(log, failures=0, error=None, from_batch=0):
    """A client that notes each request in a file, and fails as told."""

    class Recorder:
        def __init__(self):
            self.failed = 0

        def fetch(self, keys):
            with open(log, "a") as out:
                out.write(json.dumps(keys) + "\n")
            with open(log) as seen:
                batch = len({line for line in seen}) - 1
            if error is not None and batch >= from_batch and self.failed < failures:
                self.failed += 1
                raise getattr(lookup, error)("down")
            return [{"id": key, "n": int(key)} for key in keys if not key.endswith("9")]

    return Recorder


def requests(log):
    with open(log) as lines:
        return [json.loads(line) for line in lines]


def test_batches_of_fifty(spark, path):
    log = path("log")
    out = lookup.enrich_batches(ids(spark, 120), "id", client(log), RESULT, sleep=lambda s: None)
    rows = out.collect()
    assert [len(r) for r in requests(log)] == [50, 50, 20]
    assert len(rows) == 108 and all(r.ok and r.error is None for r in rows)
    assert {r.id: r.n for r in rows}["042"] == 42


def test_batches_run_on_across_arrow_batches(spark, path):
    log = path("log")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        lookup.enrich_batches(ids(spark, 120), "id", client(log), RESULT).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [len(r) for r in requests(log)] == [50, 50, 20]


def test_transient_errors_are_repeated(spark, path):
    log, pauses = path("log"), path("pauses")

    def sleep(seconds):
        with open(pauses, "a") as out:
            out.write(f"{seconds}\n")

    flaky = client(log, failures=4, error="TransientError")
    rows = lookup.enrich_batches(ids(spark, 60), "id", flaky, RESULT, sleep=sleep).collect()
    assert [len(r) for r in requests(log)] == [50] * 5 + [10]
    assert all(r.ok for r in rows)
    assert open(pauses).read().split() == ["4.0", "4.0", "4.0", "8.0"]


def test_a_batch_that_keeps_failing_is_skipped(spark, path):
    log = path("log")
    broken = client(log, failures=5, error="TransientError")
    rows = lookup.enrich_batches(ids(spark, 60), "id", broken, RESULT, sleep=lambda s: None).collect()
    failed = [r for r in rows if not r.ok]
    assert len(failed) == 50 and {r.error for r in failed} == {"down"} and failed[0].n is None
    assert len(rows) == 50 + 9


def test_without_quota_nothing_more_is_asked(spark, path):
    log = path("log")
    spent = client(log, failures=1, error="QuotaExhausted", from_batch=1)
    rows = lookup.enrich_batches(ids(spark, 160), "id", spent, RESULT).collect()
    assert [len(r) for r in requests(log)] == [50, 50]
    assert sum(r.ok for r in rows) == 45 and sum(not r.ok for r in rows) == 110


def test_pauses_double_between_bounds():
    assert [lookup.pause_after(n) for n in (1, 3, 4, 6, 7, 20)] == [4, 4, 8, 32, 60, 60]


def test_no_keys_no_client(spark, path):
    log = path("log")
    out = lookup.enrich_batches(ids(spark, 1).limit(0), "id", client(log), RESULT)
    assert out.count() == 0 and not os.path.exists(log)
