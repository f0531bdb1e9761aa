"""CSV seed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statflow.schemas import CHANNEL_SEED

# what the parser puts in place of an unquoted empty field; no text contains it
_ABSENT = "\x01"


def read_seeds(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """Seed rows; an empty field is null, a quoted empty field is ''.

    Quotes inside a quoted field are doubled.  ``line_breaks`` allows line breaks inside
    quotes, at the price that a file is no longer split over tasks.
    """
    return (
        spark.read.schema(CHANNEL_SEED)
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .option("nullValue", _ABSENT)
        .option("emptyValue", "")
        .csv(path)
    )
