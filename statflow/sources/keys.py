"""Lists of keys in one comma-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.text import strip


def explode_keys(df: DataFrame, column: str, key: str = "key") -> DataFrame:
    """One row per key with its place in the list; blanks go, repeats stay."""
    placed = df.select(
        *[name for name in df.columns if name != column],
        F.posexplode(F.split(F.col(column), ",")).alias("position", "raw"),
    )
    return placed.withColumn(key, strip(F.col("raw"))).drop("raw").where(F.col(key) != "")
