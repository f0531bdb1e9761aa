"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR: folder of Parquet tables.  BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from statflow.catalog import QUERIES  # noqa: E402
from statflow.session import local_session  # noqa: E402

HEADLINE = (
    "p18_enriched_view",
    "p18_engagement_stream_form",
    "q1_leaderboard",
    "p2_usable",
    "p6_flatten_videos",
    "w1_wire_round_trip",
    "m4_fold_batch",
    "m1_upsert_channels",
    "m2_upsert_queue",
    "m3_apply_cadence",
    "m5_publish",
    "f2_due",
    "q3_chunks",
    "n1_latest_videos",
    "n2_latest_snapshot",
    "n3_growth",
    "n3_growth_hot",
    "v4_violation_report",
    "v4_clean_rows",
    "j1_lookup_chain",
    "j4_cascade_snapshots",
    "a3_quota_ledger",
    "u1_enrich_batches",
    "w4_append_series",
    "t4_stream_snapshots",
    "t5_stream_state",
)


def shuffle_bytes(spark: SparkSession) -> int:
    """Bytes written to shuffle files since the start of the session."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(n).totalShuffleWrite() for n in range(executors.size()))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus), spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for _ in range(3):
        run("p18_enriched_view")
    seconds, shuffled = {}, {}
    for name in wanted:
        run(name)  # fills the file cache and compiles; the better of the next two runs counts
        before = shuffle_bytes(spark)
        first = run(name)
        shuffled[name] = shuffle_bytes(spark) - before
        seconds[name] = round(min(first, run(name)), 3)
    spark.stop()
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "shuffle_bytes": shuffled,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
