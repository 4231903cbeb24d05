"""Silver layer (D1-D15): typed, trimmed, defaulted, de-duplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursewise.functions.dates import parse_date, parse_timestamp
from coursewise.functions.prices import MONEY
from coursewise.operators.common import best_row
from coursewise.operators.skew import PLACE, placed

# --------------------------------------------------------------------------- D1-D7, D9-D12


def trim_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """TRIM text columns."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def duration_hours(seconds: Column) -> Column:
    """Seconds -> hours, one decimal, HALF_UP on exact decimals."""
    return F.round(seconds.try_cast("decimal(20,3)") / 3600, 1).try_cast("decimal(12,1)")


def list_price(original: Column) -> Column:
    """List price defaults to 0."""
    return F.coalesce(original.try_cast(MONEY), F.lit(0).cast(MONEY))


def sale_price(discount: Column, original: Column) -> Column:
    """Sale price falls back to the list price, then 0."""
    return F.coalesce(discount.try_cast(MONEY), original.try_cast(MONEY), F.lit(0).cast(MONEY))


def count_default(c: Column) -> Column:
    """D5 (+Q2/Q3): NULL, NaN and counts beyond a BIGINT become 0."""
    d = c.try_cast("double")
    return F.coalesce(F.when(~F.isnan(d), d).try_cast("bigint"), F.lit(0).cast("bigint"))


def rating_round(c: Column) -> Column:
    """Rating rounded to one decimal (NaN and values beyond the type -> NULL)."""
    d = c.try_cast("double")
    return F.round(F.when(~F.isnan(d), d).try_cast("decimal(10,3)"), 1).try_cast("decimal(4,1)")


def none_to_null(c: Column, token: str = "None") -> Column:
    """The text ``None`` written by old loaders means NULL."""
    return F.nullif(c, F.lit(token))


def rating_counts(dist_json: Column, n: int = 5, prefix: str = "rating_") -> dict[str, Column]:
    """Element i ``.count`` of the rating-distribution JSON array as INT.

    Missing elements, text ``None`` and invalid JSON all give NULL.
    """
    j = none_to_null(dist_json)
    return {f"{prefix}{i + 1}": F.get_json_object(j, f"$[{i}].count").try_cast("int")
            for i in range(n)}


def json_field(text: Column, path: str, dtype: str = "string") -> Column:
    """D9 object access: one member of JSON text (``$.k``), typed; missing or invalid -> NULL."""
    return F.get_json_object(text, path).try_cast(dtype)


def _scrape_time(df: DataFrame) -> Column:
    """Typed scrape time, whichever form the bronze rows carry."""
    if "scraped_at" in df.columns:
        dtype = df.schema["scraped_at"].dataType
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return F.col("scraped_at")
        return parse_timestamp(F.col("scraped_at").cast("string"))
    return parse_timestamp(F.col("_scraped_datetime"))


def _json_text(df: DataFrame, col: str) -> Column:
    """A column as JSON text, whether bronze carries it as text or nested."""
    nested = isinstance(df.schema[col].dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(F.col(col)) if nested else F.col(col).cast("string")


def _place(raw: DataFrame) -> list[str]:
    """The column of bronze rows that lie together by course and typed scrape time, if they do."""
    return [PLACE] if PLACE in raw.columns else []


def dedupe(df: DataFrame, keys: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """One row per key; remaining columns (or ``tie_break``) give a total order.

    Rows that ``skew.placed`` has brought together by the keys stay there.
    """
    at = [PLACE] if PLACE in df.columns else []
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in [*keys, *at]]
    return best_row(df, [*keys, *at], [F.col(c).asc_nulls_last() for c in rest])


def valid_instructor(df: DataFrame, col: str = "instructor_id") -> DataFrame:
    """Drop rows without an instructor id or with the placeholder ``0``."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != "0"))


# --------------------------------------------------------------------------- D13-D15

STG_COURSES_COLUMNS = [
    "course_id", "title", "headline", "language", "level", "duration_hours",
    "published_date", "last_updated_date", "list_price", "sale_price", "num_students",
    "num_reviews", "rating", "course_url", "category", "scraped_at", "rating_distribution",
    "rating_1", "rating_2", "rating_3", "rating_4", "rating_5",
]


def stg_courses(raw: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Bronze course pages -> one typed row per (course, scrape time)."""
    typed = raw.select(
        F.col("course_id"),
        F.trim("title").alias("title"),
        F.trim("headline").alias("headline"),
        F.col("language"),
        F.col("level"),
        duration_hours(F.col("course_duration_seconds")).alias("duration_hours"),
        parse_date(F.col("publishes_date")).alias("published_date"),
        parse_date(F.col("lasted_updated_date")).alias("last_updated_date"),
        list_price(F.col("original_price")).alias("list_price"),
        sale_price(F.col("discount_price"), F.col("original_price")).alias("sale_price"),
        count_default(F.col("num_students")).alias("num_students"),
        count_default(F.col("num_reviews")).alias("num_reviews"),
        rating_round(F.col("avg_rating_score")).alias("rating"),
        _json_text(raw, "rating_distribution").alias("rating_distribution"),
        F.col("_url").alias("course_url"),
        F.col("_category").alias("category"),
        _scrape_time(raw).alias("scraped_at"),
        *[F.col(c) for c in (tie_break or [])], *_place(raw),
    )
    one = dedupe(typed, ["course_id", "scraped_at"], tie_break)
    return one.withColumns(rating_counts(F.col("rating_distribution"))).select(*STG_COURSES_COLUMNS)


STG_INSTRUCTORS_COLUMNS = ["instructor_id", "instructor_name", "job_title", "course_id",
                           "total_students", "instructor_rating", "num_of_courses",
                           "total_num_reviews"]


def stg_instructors(raw: DataFrame) -> DataFrame:
    """Instructor rows, trimmed, rating rounded, placeholders dropped."""
    def opt(name, dtype):
        return F.col(name).try_cast(dtype) if name in raw.columns else F.lit(None).cast(dtype)

    out = raw.select(
        F.col("instructor_id").cast("string").alias("instructor_id"),
        F.trim("name").alias("instructor_name"),
        F.col("job_title"),
        F.col("course_id"),
        F.col("num_students").alias("total_students"),
        rating_round(F.col("avg_rating_score")).alias("instructor_rating"),
        opt("num_of_courses", "double").alias("num_of_courses"),
        opt("total_num_reviews", "double").alias("total_num_reviews"),
    )
    return valid_instructor(out)


STG_PRICE_COLUMNS = ["course_id", "title", "list_price", "sale_price", "scraped_at", "course_url"]


def stg_price_tracker(raw: DataFrame, tie_break: list[str] | None = None, place: bool = False) -> DataFrame:
    """Price offers -> one typed row per (course, scrape time); ``place``: a course's rows are to lie together."""
    typed = raw.select(
        F.col("course_id"),
        F.trim("title").alias("title"),
        list_price(F.col("original_price")).alias("list_price"),
        sale_price(F.col("discount_price"), F.col("original_price")).alias("sale_price"),
        _scrape_time(raw).alias("scraped_at"),
        F.col("_url").alias("course_url"),
        *[F.col(c) for c in (tie_break or [])], *_place(raw),
    )
    if place:  # by the typed time: texts of the same time may differ
        typed = placed(typed.drop(PLACE), "course_id", ["scraped_at"])
    return dedupe(typed, ["course_id", "scraped_at"], tie_break).select(*STG_PRICE_COLUMNS)
