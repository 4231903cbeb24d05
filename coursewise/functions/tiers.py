"""Tier labels of the dashboard (G5-G7) with thresholds as arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier labels and default thresholds of the course dashboard,
# listed in display order.
PRICE_TIERS = ["Free", "Low Price (< 400K)", "Mid Price (400K - 800K)",
               "High Price (800K - 1.5M)", "Very High Price (> 1.5M)"]
PRICE_BOUNDS = (400_000, 800_000, 1_500_000)
DURATION_TIERS = ["Very Short (<= 3h)", "Short (3h - 8h)", "Medium (8h - 15h)",
                  "Long (15h - 24h)", "Very Long (> 24h)", "Unknown"]
DURATION_BOUNDS = (3, 8, 15, 24)
RATING_TIERS = ["Good (4 - 5)", "Fair (3 - 3.9)", "Poor (under 3)", "No Rating"]
RATING_BOUNDS = (4, 3)


def price_tier(price: Column, bounds=PRICE_BOUNDS, labels=PRICE_TIERS) -> Column:
    """<=0 free, then strict upper bounds."""
    c = F.when(price <= 0, labels[0])
    for b, lab in zip(bounds, labels[1:]):
        c = c.when(price < b, lab)
    return c.otherwise(labels[len(bounds) + 1])


def duration_tier(hours: Column, bounds=DURATION_BOUNDS, labels=DURATION_TIERS) -> Column:
    """<=0 unknown, then inclusive upper bounds."""
    c = F.when(hours <= 0, labels[-1])
    for b, lab in zip(bounds, labels):
        c = c.when(hours <= b, lab)
    return c.otherwise(labels[len(bounds)])


def rating_tier(rating: Column, bounds=RATING_BOUNDS, labels=RATING_TIERS) -> Column:
    """<=0 no rating, then inclusive lower bounds, best first."""
    c = F.when(rating <= 0, labels[-1])
    for b, lab in zip(bounds, labels):
        c = c.when(rating >= b, lab)
    return c.otherwise(labels[len(bounds)])


def tier_rank(label: Column, order: list[str]) -> Column:
    """1-based position of a label in a display order (NULL if absent)."""
    arr = F.array(*[F.lit(x) for x in order])
    pos = F.array_position(arr, label)
    return F.when(pos > 0, pos)
