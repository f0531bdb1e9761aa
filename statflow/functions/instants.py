"""Instants: parsing, printing and arithmetic on elapsed time."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.schemas import POLL_CADENCE, SLOWEST_POLL_HOURS

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def instant(as_of: datetime | str | Column) -> Column:
    """The run instant as a column; zone-less values are UTC."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of)


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to timestamp; empty or unreadable text gives null."""
    return F.try_to_timestamp(F.nullif(text, F.lit("")))


def utc_clock(at: Column) -> Column:
    """What a clock in UTC shows at the instant, without a zone; free of the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(at), epoch)


def utc_date(at: Column) -> Column:
    return utc_clock(at).cast("date")


def iso_text(at: Column) -> Column:
    """Timestamp to ISO-8601 text in UTC, without a fraction when it is zero."""
    seconds = F.replace(F.substring(utc_clock(at).cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    micros = F.pmod(F.unix_micros(at), F.lit(1_000_000))
    fraction = F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    return F.concat(seconds, F.when(micros == 0, F.lit("")).otherwise(fraction), F.lit("+00:00"))


def elapsed_days(since: Column, until: Column) -> Column:
    """Whole 24-hour days between two instants, truncated toward zero."""
    micros = F.unix_micros(until) - F.unix_micros(since)
    return F.call_function("div", micros, F.lit(MICROS_PER_DAY)).cast("int")


def hours_later(at: Column, hours: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(at) + hours.cast("bigint") * F.lit(MICROS_PER_HOUR))


def earlier(at: Column, by: timedelta) -> Column:
    micros = by // timedelta(microseconds=1)
    return F.timestamp_micros(F.unix_micros(at) - F.lit(micros).cast("bigint"))


def poll_interval_hours(published_at: Column, as_of: Column) -> Column:
    """Hours until the next measurement, by age: the older, the rarer."""
    age = F.unix_micros(as_of) - F.unix_micros(published_at)
    chain = F.when(age.isNull(), F.lit(None).cast("int"))
    for below_hours, interval in POLL_CADENCE:
        chain = chain.when(age < below_hours * MICROS_PER_HOUR, F.lit(interval))
    return chain.otherwise(F.lit(SLOWEST_POLL_HOURS))


def quota_day(at: Column, zone: str) -> Column:
    """Calendar day in the zone whose midnight resets the quota."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(at)).cast("date")
