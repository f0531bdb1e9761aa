"""Use of request quota, from the request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.instants import quota_day
from statflow.functions.text import is_quota_error, mask_secret
from statflow.schemas import DAILY_QUOTA_UNITS, QUOTA_ZONE


def quota_errors(log: DataFrame) -> DataFrame:
    return log.where(is_quota_error(F.col("status"), F.col("message")))


def quota_ledger(log: DataFrame, limit: int = DAILY_QUOTA_UNITS) -> DataFrame:
    """Units per key and quota day.

    A key is exhausted once the service has said so; what remains never falls below 0.
    """
    used = log.groupBy("api_key", quota_day(F.col("ts"), QUOTA_ZONE).alias("quota_day")).agg(
        F.sum("units").alias("units"),
        F.count("*").alias("requests"),
        F.bool_or(is_quota_error(F.col("status"), F.col("message"))).alias("exhausted"),
    )
    left = F.greatest(F.lit(limit) - F.col("units"), F.lit(0))
    return used.withColumn("remaining", F.when(F.col("exhausted"), F.lit(0)).otherwise(left))


def masked(log: DataFrame) -> DataFrame:
    return log.withColumn("api_key", mask_secret(F.col("api_key")))
