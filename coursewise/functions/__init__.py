"""Column-expression helpers: pure ``Column -> Column`` functions, JVM-side only."""

from coursewise.functions.dates import parse_date, parse_timestamp, timestamp_text
from coursewise.functions.keys import hash_key
from coursewise.functions.prices import clean_price, discount_percentage, money
from coursewise.functions.tiers import (DURATION_TIERS, PRICE_TIERS, RATING_TIERS, duration_tier,
                                        price_tier, rating_tier, tier_rank)

__all__ = [
    "parse_date", "parse_timestamp", "timestamp_text", "hash_key", "clean_price",
    "discount_percentage", "money", "DURATION_TIERS", "PRICE_TIERS", "RATING_TIERS",
    "duration_tier", "price_tier", "rating_tier", "tier_rank",
]
