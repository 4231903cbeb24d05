"""Date and timestamp parsing (D3, D7, X5, X18) and the text form used in keys (Q9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first text as written by the course pages; one- or two-digit parts (Q6).
DATE_FORMATS = ("d/M/yyyy",)
# Scrape stamps come day-first from old files and ISO-like from the crawler (Q5).
TIMESTAMP_FORMATS = ("d/M/yyyy H:mm", "yyyy-MM-dd H:mm", "yyyy-MM-dd H:mm:ss")


def _blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def parse_date(c: Column, formats=DATE_FORMATS) -> Column:
    """Text -> DATE; blank, NULL or unparsable (``31/02/2024``) give NULL."""
    t = _blank_to_null(c)
    return F.coalesce(*[F.try_to_date(t, f) for f in formats])


def parse_timestamp(c: Column, formats=TIMESTAMP_FORMATS) -> Column:
    """Text -> TIMESTAMP over all accepted formats; garbage gives NULL."""
    t = _blank_to_null(c)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])


def timestamp_text(c: Column) -> Column:
    """Text of a UTC timestamp as the warehouse printed it: ``2024-05-04 10:20:00+00``."""
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
