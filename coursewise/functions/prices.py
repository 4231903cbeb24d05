"""Price expressions (E4, F13) on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def clean_price(text: Column) -> Column:
    """Price text -> number: ``Free`` is 0, currency signs and thousands commas dropped,
    then the first number; NULL when nothing numeric is left."""
    t = F.regexp_replace(text, "Free", "0")
    t = F.regexp_replace(t, "[₫$]", "")
    t = F.regexp_replace(F.trim(t), ",", "")
    num = F.regexp_extract(t, r"(\d+(\.\d+)?)", 1)
    return F.when(num != "", num).try_cast("double")


def discount_percentage(list_price: Column, sale_price: Column) -> Column:
    """round((1 - sale/list) * 100) when list > 0, else 0; decimal HALF_UP rounding."""
    lp, sp = money(list_price), money(sale_price)
    pct = F.round((F.lit(1) - sp / lp) * 100, 0)
    return F.when(lp > 0, pct).otherwise(F.lit(0)).cast("decimal(18,0)")
