"""Text clean-up, masking and classification."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.schemas import KEY_LENGTH, QUOTA_REASONS, QUOTA_STATUS

# Every character that counts as white space at the ends of an id.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends (SQL ``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_key(text: Column) -> Column:
    """Stripped and cut to the key length, counted in characters."""
    return F.substring(strip(text), 1, KEY_LENGTH)


def playlist_key(text: Column) -> Column:
    """The id behind the last ``=`` of a playlist address, or the bare id."""
    return F.substring_index(strip(text), "=", -1)


def mask_secret(secret: Column) -> Column:
    """Show at most the four outer characters on each side."""
    masked = F.concat(F.substring(secret, 1, 4), F.lit("…"), F.substring(secret, -4, 4))
    return F.when(F.char_length(secret) <= 8, F.lit("****")).otherwise(masked)


def is_quota_error(status: Column, message: Column) -> Column:
    """A refused request whose text names one of the quota reasons, in any case."""
    lowered = F.lower(message)
    named = reduce(or_, (lowered.contains(reason) for reason in QUOTA_REASONS))
    return F.coalesce((status == QUOTA_STATUS) & named, F.lit(False))
