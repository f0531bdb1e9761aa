"""The landing zone of API replies as a stream: each file is read once, and no field is lost.

``read_raw`` (``sources.replies``) reads the whole zone again at each run, and keeps the declared fields only.
Here the file source remembers in its checkpoint what it has read, a run takes what came since, and objects are kept
as ``VARIANT``: a field that the API adds later is stored from the day it appears, and can be asked for
when somebody needs it, in old rows too (null there).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, TEXT, REPLY, ITEM = "file", "text", "reply", "item"
LANDED = T.StructType(
    [T.StructField(FILE, T.StringType()), T.StructField("id", T.StringType()), T.StructField(ITEM, T.VariantType())]
)


def stream_replies(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """``file, text, reply`` of new lines; ``reply`` is null where the line is no JSON document."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _parsed(reader.text(path))


def batch_replies(spark: SparkSession, path: str) -> DataFrame:
    """The same columns of all lines below ``path``."""
    return _parsed(spark.read.text(path))


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("value").alias(TEXT),
        F.try_parse_json("value").alias(REPLY),
    ).where(F.trim(TEXT) != "")


def unreadable(replies: DataFrame) -> DataFrame:
    """Lines that are no JSON document, with their file."""
    return replies.where(F.col(REPLY).isNull()).select(FILE, TEXT)


def landed_items(replies: DataFrame) -> DataFrame:
    """``file, id, item``: one row per object in the list ``items`` of a reply.

    A reply without such a list has none; an element that is no object has no ``id`` and is kept.  An id that
    is sent as a number is its text.
    """
    # a reply that is null, or whose items are no list, explodes to nothing
    listed = F.try_variant_get(REPLY, "$.items", "array<variant>")
    rows = replies.select(FILE, F.explode(listed).alias(ITEM))
    return rows.select(FILE, F.try_variant_get(ITEM, "$.id", "string").alias("id"), ITEM)


def field(path: str, kind: str = "string") -> Column:
    """A field of ``item``; null where it is missing or can't be read as ``kind``."""
    return F.try_variant_get(ITEM, path, kind)


def typed(items: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``items`` without the object, with columns ``name: (path, type)`` taken from it."""
    return items.select(FILE, "id", *(field(path, kind).alias(name) for name, (path, kind) in fields.items()))


def field_names(items: DataFrame, path: str = "$") -> DataFrame:
    """``name, n, first_file``: the fields that objects have at ``path``, in how many rows, and since which file.

    Counted before the shuffle, so its size is the number of names per task.
    """
    part = F.try_variant_get(ITEM, path, "map<string,variant>")
    names = items.select(FILE, F.explode(F.map_keys(part)).alias("name"))
    return names.groupBy("name").agg(F.count("*").alias("n"), F.min(FILE).alias("first_file"))
