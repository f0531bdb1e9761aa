"""Joins to a unique side that stay bounded per task, however many rows one key holds.

Adaptive execution splits a partition only once its compressed bytes pass a threshold.  Millions of alike rows
of one key stay below it and are sorted by one task.  Here rows are counted per key first.  Those of a
key with many are dealt over as many shares as it needs, and its row of the unique side goes to each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows of one key that may meet in one task
SHARE_ROWS = 100_000

_KEY, _HEAVY, _SHARES, _SHARE = "__key", "__heavy", "__shares", "__share"


def heavy_keys(rows: DataFrame, key: str, share_rows: int = SHARE_ROWS) -> DataFrame:
    """Keys with more rows than one share takes, and their number of shares.

    Their number is at most that of all rows divided by ``share_rows``, so they can be broadcast."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(_HEAVY)).agg(F.count("*").alias("__rows"))
    shares = F.ceil(F.col("__rows") / F.lit(share_rows)).cast("int")
    return counted.where(F.col("__rows") > share_rows).select(_HEAVY, shares.alias(_SHARES))


def join_unique(
    rows: DataFrame, key: str, unique: DataFrame, unique_key: str, how: str, heavy: DataFrame
) -> DataFrame:
    """``rows`` joined to ``unique``, which has a key at most once; ``heavy`` are ``heavy_keys`` of ``rows``, or of more rows.

    A row's share follows from its values, so a repeated task deals it the same way."""
    columns = rows.columns
    dealt = rows.join(F.broadcast(heavy), F.col(key) == F.col(_HEAVY), "left_outer")
    place = F.pmod(F.xxhash64(*columns), F.col(_SHARES)).cast("int")
    dealt = dealt.select(*columns, F.when(F.col(_SHARES).isNotNull(), place).otherwise(F.lit(0)).alias(_SHARE))
    told = unique.withColumnRenamed(unique_key, _KEY).join(F.broadcast(heavy), F.col(_KEY) == F.col(_HEAVY), "left_outer")
    last = F.coalesce(F.col(_SHARES), F.lit(1)) - 1
    told = told.withColumn("__of", F.explode(F.sequence(F.lit(0), last))).drop(_HEAVY, _SHARES)
    joined = dealt.join(told, (F.col(key) == F.col(_KEY)) & (F.col(_SHARE) == F.col("__of")), how)
    return joined.drop(_KEY, _SHARE, "__of")
