"""Fields of API objects that were read as string maps.

A missing key takes the default; a key that is present with a null keeps the null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

THUMBNAILS = "map<string,map<string,string>>"
BEST_FIRST = ("maxres", "high", "default")


def has(bag: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(bag, F.lit(key)), F.lit(False))


def value(bag: Column, key: str) -> Column:
    return F.try_element_at(bag, F.lit(key))


def text(bag: Column, key: str, default: str) -> Column:
    return F.when(has(bag, key), value(bag, key)).otherwise(F.lit(default))


def flag(bag: Column, key: str, default: bool) -> Column:
    return F.when(has(bag, key), value(bag, key).try_cast("boolean")).otherwise(F.lit(default))


def texts(bag: Column, key: str) -> Column:
    """A list of texts; the empty list when the key is missing."""
    read = F.from_json(value(bag, key), "array<string>")
    return F.when(has(bag, key), read).otherwise(F.array().cast("array<string>"))


def text_count(raw: Column) -> Column:
    """Digits to bigint; null when the text is no whole number."""
    return raw.try_cast("bigint")


def count(bag: Column, key: str) -> Column:
    """A counter sent as text: 0 when missing, null when unreadable."""
    return F.when(has(bag, key), text_count(value(bag, key))).otherwise(F.lit(0).cast("bigint"))


def unreadable_counts(bag: Column, keys: dict[str, str]) -> Column:
    """Names of the counters that are present but no whole number."""
    marks = [
        F.when(has(bag, key) & text_count(value(bag, key)).isNull(), F.lit(name))
        for name, key in keys.items()
    ]
    return F.array_compact(F.array(*marks))


def best_thumbnail(thumbnails: Column) -> Column:
    """Address of the best size present; '' when that size has no address."""
    best = F.coalesce(*(F.try_element_at(thumbnails, F.lit(size)) for size in BEST_FIRST))
    return F.when(has(best, "url"), value(best, "url")).otherwise(F.lit(""))


def thumbnail_url(snippet: Column) -> Column:
    # a list of one element: the text is parsed once, however often its parts are used
    parsed = F.array(F.from_json(value(snippet, "thumbnails"), THUMBNAILS))
    return F.transform(parsed, best_thumbnail)[0]
