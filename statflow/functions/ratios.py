"""Engagement ratios and size tiers.

Each ratio exists in two forms: the plain double used by the streaming job, and the
rounded decimal used by the reporting view (``rounded=True``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.schemas import FLOOR_TIER, SIZE_TIERS

EXACT = "decimal(20,0)"


def _guarded(numerator: Column, denominator: Column, factor: int, digits: int | None) -> Column:
    """``factor * numerator / denominator``; 0 unless the denominator is positive."""
    if digits is None:
        ratio, zero = numerator / denominator, F.lit(0.0)
    else:
        ratio, zero = numerator.cast(EXACT) / denominator.cast(EXACT), F.lit(0)
    if factor != 1:
        ratio = ratio * factor
    if digits is not None:
        ratio = F.round(ratio, digits)
    return F.when(denominator > 0, ratio).otherwise(zero).cast("double")


def avg_views_per_video(views: Column, videos: Column, rounded: bool = False) -> Column:
    return _guarded(views, videos, 1, 2 if rounded else None)


def views_per_subscriber(views: Column, subscribers: Column, rounded: bool = False) -> Column:
    return _guarded(views, subscribers, 1, 4 if rounded else None)


def engagement_ratio(subscribers: Column, views: Column, rounded: bool = False) -> Column:
    """Subscribers in percent of views."""
    return _guarded(subscribers, views, 100, 6 if rounded else None)


def size_tier(subscribers: Column) -> Column:
    (bound, label), *rest = SIZE_TIERS
    chain = F.when(subscribers >= bound, F.lit(label))
    for bound, label in rest:
        chain = chain.when(subscribers >= bound, F.lit(label))
    return chain.otherwise(F.lit(FLOOR_TIER))
