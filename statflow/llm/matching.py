"""Places of regular-expression matches as column expressions, in code points.

Text is read once per pattern; nothing leaves the JVM.  Java's regular expressions are used, so
patterns should have no repeated groups over long stretches (those recurse): character classes,
possessive where the next character decides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,end:bigint,found:string>"
#: Matches that are summed up at once; keeps the work linear in the number of matches.
_STEP = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas use it again and again."""
    return F.transform(F.array(value), use)[0]


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, found>>`` of all matches, leftmost and not overlapping; ends are exclusive.

    The pattern must not match the empty string."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.slice(F.arrays_zip(gaps, found), F.lit(1), F.size(found))

    def place(pairs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _STEP).cast("int")), lambda n: F.slice(pairs, n * _STEP + 1, _STEP))
        empty = F.array().cast(f"array<{SPAN}>")

        def one(done: Column, pair: Column) -> Column:
            start = done["at"] + F.length(pair["0"])
            end = start + F.length(pair["1"])
            return F.struct(end.alias("at"), F.array_append(done["out"], F.struct(start.alias("start"), end.alias("end"), pair["1"].alias("found"))).alias("out"))

        def block(done: Column, rows: Column) -> Column:
            start = F.struct(done["at"].alias("at"), empty.alias("out"))
            return let(
                F.aggregate(rows, start, one),
                lambda now: F.struct(now["at"].alias("at"), F.array_append(done["out"], now["out"]).alias("out")),
            )

        nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
        return F.flatten(F.aggregate(blocks, nothing, block)["out"])

    return F.when(F.size(found) > 0, let(pairs, place)).otherwise(none())


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def where(condition: Column, spans: Column) -> Column:
    """``spans``, which are only looked for where ``condition`` holds."""
    return F.when(condition, spans).otherwise(none())


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted ``array<struct<kind, start, end>>``, joined by commas."""
    one = lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
