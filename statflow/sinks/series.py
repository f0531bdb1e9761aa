"""Append-only tables in Parquet: measurement series and trend rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions.instants import utc_date
from statflow.sinks.metrics import write_counted

RUN = "run_id"
TREND_DATE = "captured_date"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def series_layout(
    df: DataFrame, time: str, key: str, date: str, partitions: int | None = None
) -> DataFrame:
    """Rows ordered for the declared access paths: by day, then key, newest first.

    The range partitioning uses the whole sort order and all other plain columns, so a day, a
    key or an instant with very many rows is spread over tasks.  The day is a column of the files, not a
    folder: there are as many files as ranges, however many days a run has, and min/max statistics of
    files and row groups prune on the day and, within it, on the key.
    """
    dated = df.withColumn(date, utc_date(F.col(time)))
    order = [F.col(date), F.col(key), F.col(time).desc()]
    rest = [
        F.col(f.name)
        for f in df.schema.fields
        if f.name not in (key, time) and not isinstance(f.dataType, (T.ArrayType, T.MapType))
    ]
    wanted = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dated.repartitionByRange(wanted, *order, *rest).sortWithinPartitions(*order)


def run_name(as_of: datetime | str) -> str:
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return f"r{(moment - _EPOCH) // timedelta(microseconds=1)}"


def read_series(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    as_of: datetime | str | None = None,
    date: str = "scraped_date",
) -> DataFrame:
    """The series, or only the rows of one run, of which only its folder is listed."""
    # the day is stored, the run is the name of the folder
    parts = [T.StructField(date, T.DateType()), T.StructField(RUN, T.StringType())]
    reader = spark.read.schema(T.StructType([*schema.fields, *parts])).option("basePath", path)
    if as_of is None:
        return reader.parquet(path)
    folder = f"{path}/{RUN}={run_name(as_of)}"
    if not _exists(spark, folder):
        return spark.createDataFrame([], T.StructType([*schema.fields, *parts]))
    return reader.parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(jpath)


def append_series(
    df: DataFrame,
    path: str,
    as_of: datetime | str,
    time: str = "scraped_at",
    key: str = "video_id",
    date: str = "scraped_date",
    partitions: int | None = None,
) -> int:
    """Adds the rows of one run, in a folder of its own: one file, or more, for each range of days and keys.

    Returns their number.  A repeated run replaces the folder as a whole, also with fewer days
    or no rows: ``df`` must hold all rows of the run.
    """
    laid_out = series_layout(df, time, key, date, partitions)
    folder = f"{path}/{RUN}={run_name(as_of)}"
    return write_counted(laid_out, lambda rows: indexed(rows.write, [key]).mode("overwrite").parquet(folder))


def append_trends(
    df: DataFrame, path: str, as_of: datetime | str, partitions: int | None = None
) -> dict[str, object]:
    """Adds the trend rows of a run; a run without rows adds none."""
    rows = append_series(df, path, as_of, "captured_at", "video_id", TREND_DATE, partitions)
    return {"inserted_videos": rows, "captured_at": as_of} if rows else {"inserted_videos": 0}


def indexed(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """A writer whose Parquet files carry Bloom filters of ``columns``.

    For equality on columns that the sort order doesn't serve: a row group that can't hold the value
    is not read."""
    for name in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    return writer
