"""Time trends promised by the reference's documentation (H1, H2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.operators.skew import lag_in_range


def student_growth(stg_courses: DataFrame) -> DataFrame:
    """H1: change of the student count between consecutive snapshots of a course."""
    snaps = stg_courses.select("course_id", "scraped_at", "num_students")
    lagged = lag_in_range(snaps, ["course_id"], "scraped_at", "num_students", "prev_students")
    return lagged.withColumn("growth", F.col("num_students") - F.col("prev_students"))


def price_by_month(fct_price_history: DataFrame, dim_date: DataFrame) -> DataFrame:
    """H2: monthly price statistics (history joined to the calendar on the day)."""
    h = fct_price_history.withColumn("date_key", F.to_date("recorded_at"))
    j = h.join(dim_date.select("date_key", "year_month"), "date_key")
    return (j.groupBy("year_month")
             .agg(F.count(F.lit(1)).alias("n_prices"),
                  (F.sum("sale_price").cast("double") / F.count("sale_price")).alias("avg_sale_price"),
                  F.min("sale_price").alias("min_sale_price"), F.max("sale_price").alias("max_sale_price"),
                  F.count_if(F.col("is_lowest_price_ever")).alias("n_all_time_lows")))
