"""Gold star schema (F1-F15): dimensions, bridge and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursewise.functions.dates import timestamp_text
from coursewise.functions.keys import hash_key
from coursewise.functions.prices import discount_percentage
from coursewise.operators.common import best_row, sequential_ids
from coursewise.operators.skew import lookup_join


# --------------------------------------------------------------------------- F1-F3

LOOKUPS = {"category": ("category_id", "category_name"),
           "language": ("language_id", "language_name"),
           "level": ("level_id", "level_name")}


def lookup_dim(stg: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of a lookup column numbered 1..n in binary (byte) order."""
    id_col, name_col = LOOKUPS[col]
    values = stg.select(F.col(col).cast("string").alias(name_col)).filter(F.col(name_col).isNotNull()).distinct()
    return sequential_ids(values, name_col, id_col).select(id_col, name_col)


def dim_category(stg_courses: DataFrame) -> DataFrame:
    """categories."""
    return lookup_dim(stg_courses, "category")


def dim_language(stg_courses: DataFrame) -> DataFrame:
    """languages."""
    return lookup_dim(stg_courses, "language")


def dim_level(stg_courses: DataFrame) -> DataFrame:
    """levels."""
    return lookup_dim(stg_courses, "level")


# --------------------------------------------------------------------------- F4-F5, F12

def best_course_record(stg_courses: DataFrame) -> DataFrame:
    """per course, a row with students first, then the newest scrape.

    (course_id, scraped_at) is unique after staging, so the order is total.
    """
    has_students = F.when(F.col("num_students") > 0, 1).otherwise(0)
    return best_row(stg_courses, ["course_id"],
                    [has_students.desc(), F.col("scraped_at").desc_nulls_last()])


def with_lookup_id(courses: DataFrame, col: str, dim: DataFrame) -> DataFrame:
    """Course rows with the id of one lookup value (J1); AQE broadcasts the lookup if it turns out small."""
    id_col, name_col = LOOKUPS[col]
    return courses.join(dim.select(F.col(id_col), F.col(name_col)), F.col(col) == F.col(name_col), "left").drop(name_col)


#: What ``dim_course`` and its lookups read of the courses.
DIM_COURSE_INPUT = ["course_id", "title", "headline", "course_url", "published_date", "duration_hours", "list_price",
                    "category", "language", "level", "num_students", "scraped_at"]


def dim_course(stg_courses: DataFrame, categories: DataFrame | None = None,
               languages: DataFrame | None = None, levels: DataFrame | None = None) -> DataFrame:
    """best record per course with lookup ids (three left joins, J1)."""
    out = best_course_record(stg_courses)
    for col, dim in (("category", categories), ("language", languages), ("level", levels)):
        out = with_lookup_id(out, col, dim if dim is not None else lookup_dim(stg_courses, col))
    return out.select("course_id", "title", "headline", "course_url", "published_date",
                      "duration_hours", "list_price", "category_id", "language_id", "level_id")


SNAPSHOT_COLUMNS = ["snapshot_id", "course_id", "num_students", "num_reviews", "rating",
                    "rating_1", "rating_2", "rating_3", "rating_4", "rating_5",
                    "last_updated_date", "scraped_at"]


def fct_course_snapshot(stg_courses: DataFrame) -> DataFrame:
    """the best record per course with an MD5 snapshot key."""
    best = best_course_record(stg_courses)
    sid = hash_key(F.col("course_id").cast("string"), timestamp_text(F.col("scraped_at")))
    return best.withColumn("snapshot_id", sid).select(*SNAPSHOT_COLUMNS)


# --------------------------------------------------------------------------- F6-F8

def date_bounds(stg_courses: DataFrame) -> DataFrame:
    """earliest and latest of published, updated and scrape dates (NULLs skipped)."""
    d = [F.col("published_date"), F.col("last_updated_date"), F.to_date("scraped_at")]
    return stg_courses.agg(F.min(F.least(*d)).alias("start_date"),
                           F.max(F.greatest(*d)).alias("end_date"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """one row per day between the bounds, inclusive.

    The span is bounded by the calendar (days between two dates), not by the
    data volume.  Years are spread out first and days within a year after it,
    so a stray date far away makes many rows but no long array.
    """
    known = bounds.filter(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
    years = known.select("start_date", "end_date", F.explode(F.sequence(F.year("start_date"), F.year("end_date"))).alias("y"))
    first, last = F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(31))
    return years.select(F.explode(F.sequence(F.greatest(first, "start_date"), F.least(last, "end_date"),
                                             F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def dim_date(stg_courses: DataFrame, pad_names: bool = False) -> DataFrame:
    """F8: calendar attributes per day (ISO weekday, names, weekend flag)."""
    spine = date_spine(date_bounds(stg_courses))
    d = F.col("date_day")
    dow = (F.weekday(d) + 1)
    month_name = F.date_format(d, "MMMM")
    day_name = F.date_format(d, "EEEE")
    if pad_names:  # Q8: the warehouse blank-pads names to 9 characters
        month_name, day_name = F.rpad(month_name, 9, " "), F.rpad(day_name, 9, " ")
    return spine.select(
        d.alias("date_key"),
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"), dow.alias("day_of_week"),
        month_name.alias("month_name"), day_name.alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


# --------------------------------------------------------------------------- F9-F10

def dim_instructor(stg_instructors: DataFrame) -> DataFrame:
    """per instructor, the row with most students (NULL last; course id breaks ties)."""
    best = best_row(stg_instructors, ["instructor_id"],
                    [F.col("total_students").desc_nulls_last(), F.col("course_id").asc_nulls_last(),
                     F.col("instructor_name").asc_nulls_last(), F.col("job_title").asc_nulls_last()])
    return best.select("instructor_id", "instructor_name", "job_title")


def bridge_course_instructors(stg_instructors: DataFrame) -> DataFrame:
    """distinct (course, instructor) pairs."""
    return stg_instructors.select("course_id", "instructor_id").distinct()


# --------------------------------------------------------------------------- F13-F15

def lowest_price_flag(prices: DataFrame, key: str = "course_id", price: str = "sale_price",
                      flag: str = "is_lowest_price_ever", of: DataFrame | None = None) -> DataFrame:
    """price > 0 and <= the course's minimum positive price over all time (Q19).

    Computed as a partial-aggregated MIN per course joined back, not as a
    window: a course holding a third of the rows is reduced map-side, and its
    rows are dealt out for the join (``skew.lookup_join``).  ``of`` gives the
    rows that the minimum is taken over, if they are not ``prices``.
    """
    lows = ((prices if of is None else of).filter(F.col(price) > 0).groupBy(key)
                  .agg(F.min(price).alias("__low")))
    joined = lookup_join(prices, lows, key)
    return joined.withColumn(flag, at_lowest(F.col(price), F.col("__low"))).drop("__low")


def at_lowest(price: Column, low: Column) -> Column:
    """F14 for one row: a positive price that is at the course's minimum positive price."""
    return F.coalesce((price > 0) & (price <= low), F.lit(False))


PRICE_HISTORY_COLUMNS = ["history_id", "course_id", "title", "course_url", "list_price",
                         "sale_price", "recorded_at", "discount_percentage", "is_lowest_price_ever"]


def fct_price_history(stg_price: DataFrame) -> DataFrame:
    """price history with key, discount and all-time-low flag.

    The rows are read twice, for the minimum per course and for themselves:
    pass written silver (``Warehouse`` does), or the de-duplication runs twice.
    """
    base = stg_price.select(
        hash_key(F.col("course_id").cast("string"), timestamp_text(F.col("scraped_at"))).alias("history_id"),
        "course_id", "title", "course_url", "list_price", "sale_price",
        F.col("scraped_at").alias("recorded_at"),
        discount_percentage(F.col("list_price"), F.col("sale_price")).alias("discount_percentage"),
    )
    return lowest_price_flag(base).select(*PRICE_HISTORY_COLUMNS)
