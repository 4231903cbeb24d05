"""Property checks of the exact arithmetic against Python's Decimal (HALF_UP)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coursewise.functions.prices import discount_percentage
from coursewise.operators import serving

money = st.decimals(min_value=Decimal("0.00"), max_value=Decimal("99999999.99"), places=2)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(money, money), min_size=1, max_size=200))
def test_discount_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "l decimal(18,2), s decimal(18,2)")
    got = [r.d for r in df.select(discount_percentage(F.col("l"), F.col("s")).alias("d")).collect()]
    want = [((1 - s / l) * 100).quantize(Decimal(1), ROUND_HALF_UP) if l > 0 else Decimal(0) for l, s in pairs]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**7)), min_size=1, max_size=200))
def test_pct_review_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "r long, n long")
    got = [r.p for r in df.select(serving.pct_review(F.col("r"), F.col("n")).alias("p")).collect()]
    want = [(Decimal(r) * 100 / Decimal(n)).quantize(Decimal("0.01"), ROUND_HALF_UP) if n > 0 else Decimal("0.00")
            for r, n in pairs]
    assert got == want


def test_padded_day_and_month_names(spark):
    from coursewise.operators import marts
    from coursewise.plans.warehouse import Warehouse
    d = marts.dim_date(Warehouse(spark, "/root/testdata/sf0.001").stg_courses, pad_names=True)
    names = d.select("month_name", "day_name").distinct().collect()
    assert all(len(r.month_name) >= 9 and len(r.day_name) >= 9 for r in names)
    assert any(r.month_name == "May      " for r in names)
