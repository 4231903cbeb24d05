"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column) -> Column:
    """MD5 of the dash-joined text of the parts; NULL when any part is NULL.

    ``concat`` (not ``concat_ws``) keeps the NULL-in, NULL-out rule.
    """
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(p)
    return F.md5(F.concat(*pieces))
