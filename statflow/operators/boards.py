"""Leaderboards and selections over the channel table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.instants import earlier, instant


def leaderboard(df: DataFrame, by: str, top: int = 10, key: str = "channel_id") -> DataFrame:
    """The ``top`` rows by a column, largest first, nulls last, ties by key."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(key)).limit(top)


def in_country(df: DataFrame, country: str) -> DataFrame:
    """Rows of one country; unknown (null) and not given ('') are no country."""
    return df.where(F.col("country") == country)


def stale(df: DataFrame, as_of: datetime | str, after: timedelta) -> DataFrame:
    """Rows last processed longer ago than ``after``."""
    return df.where(F.col("processed_at") < earlier(instant(as_of), after))
