"""Support arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

def min_count(min_support: float, n_baskets: int) -> int:
    """Smallest frequency that reaches ``min_support``."""
    return math.ceil(min_support * n_baskets)


def min_support_for(min_item_freq: int, n_baskets: int) -> float:
    return min_item_freq / float(n_baskets)


def estimated_min_count(min_support_percent: Column, n_baskets: Column) -> Column:
    """The frequency shown next to a support given in percent."""
    return F.bround(min_support_percent / 100 * n_baskets, 0).cast("long")

