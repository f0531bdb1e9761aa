"""Counts taken while rows are written, so that nothing is read twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Runs ``write`` on the rows and returns how many went through it."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def run_metrics(df: DataFrame, as_of_column: str) -> DataFrame:
    """Number of rows and the run instant, as one row per run."""
    return df.groupBy(as_of_column).agg(F.count("*").alias("rows"))
