"""

Each callable takes (spark, sf_dir) and returns a DataFrame over the driver's
tables (or data Spark derives from them).  Output types are normalised by
``to_output`` so they line up with the oracle's BIGINT/DOUBLE/VARCHAR types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursewise.functions import fmt
from coursewise.functions.dates import parse_timestamp, timestamp_text
from coursewise.functions.keys import hash_key
from coursewise.functions.prices import discount_percentage
from coursewise.operators import marts, serving, staging
from coursewise.operators.common import to_output
from coursewise.plans import fixtures
from coursewise.plans import oracle as O
from coursewise.plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_output(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def W(spark, sf_dir) -> Warehouse:
    return Warehouse(spark, sf_dir)


# =============================================================================== D: staging

@register("d1_trim", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id, trim(title) AS title, trim(headline) AS headline FROM fx_courses""")
def d1_trim(spark, sf):
    """TRIM of text columns."""
    return staging.trim_text(fixtures.fx_courses(spark, sf), ["title", "headline"]).select(
        "l_orderkey", "l_linenumber", "course_id", "title", "headline")


@register("d2_duration_hours", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id, round(course_duration_seconds / 3600.0, 1) AS duration_hours
FROM fx_courses""")
def d2_duration_hours(spark, sf):
    """Seconds -> hours."""
    return fixtures.fx_courses(spark, sf).select(
        "l_orderkey", "l_linenumber", "course_id",
        staging.duration_hours(F.col("course_duration_seconds")).alias("duration_hours"))


@register("d3_parse_date", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id,
       CAST(try_strptime(NULLIF(trim(publishes_date), ''), '%d/%m/%Y') AS DATE) AS published_date,
       CAST(try_strptime(NULLIF(trim(lasted_updated_date), ''), '%d/%m/%Y') AS DATE) AS last_updated_date
FROM fx_courses""")
def d3_parse_date(spark, sf):
    """D3: blank -> NULL, day-first text -> DATE."""
    from coursewise.functions.dates import parse_date
    return fixtures.fx_courses(spark, sf).select(
        "l_orderkey", "l_linenumber", "course_id",
        parse_date(F.col("publishes_date")).alias("published_date"),
        parse_date(F.col("lasted_updated_date")).alias("last_updated_date"))


@register("d4_price_default", O.with_(O.FX_OFFERS) + """
SELECT l_orderkey, l_linenumber, course_id,
       CAST(COALESCE(original_price, 0) AS DOUBLE) AS list_price,
       CAST(COALESCE(discount_price, original_price, 0) AS DOUBLE) AS sale_price
FROM fx_offers""")
def d4_price_default(spark, sf):
    """list = coalesce(orig, 0); sale = coalesce(disc, orig, 0)."""
    o = fixtures.fx_offers(spark, sf)
    return o.select("l_orderkey", "l_linenumber", "course_id",
                    staging.list_price(F.col("original_price")).alias("list_price"),
                    staging.sale_price(F.col("discount_price"), F.col("original_price")).alias("sale_price"))


@register("d5_count_default", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id,
       CAST(trunc(COALESCE(num_students, 0)) AS BIGINT) AS num_students,
       CAST(trunc(COALESCE(num_reviews, 0)) AS BIGINT) AS num_reviews
FROM fx_courses""")
def d5_count_default(spark, sf):
    """Counts default to 0 (NaN included)."""
    return fixtures.fx_courses(spark, sf).select(
        "l_orderkey", "l_linenumber", "course_id",
        staging.count_default(F.col("num_students")).alias("num_students"),
        staging.count_default(F.col("num_reviews")).alias("num_reviews"))


@register("d6_rating_round", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id,
       CAST(round(CAST(avg_rating_score AS DECIMAL(10,3)), 1) AS DOUBLE) AS rating
FROM fx_courses""")
def d6_rating_round(spark, sf):
    """Rating rounded to one decimal."""
    return fixtures.fx_courses(spark, sf).select(
        "l_orderkey", "l_linenumber", "course_id",
        staging.rating_round(F.col("avg_rating_score")).alias("rating"))


D7_TEXT_SQL = """CASE WHEN l_linenumber = 5 THEN 'not a time'
            WHEN l_linenumber % 2 = 1 THEN strftime(scraped_at, '%d/%m/%Y %H:%M')
            ELSE strftime(scraped_at, '%Y-%m-%d %H:%M') END"""


@register("d7_parse_ts", O.with_(O.FX_OFFERS) + f"""
SELECT l_orderkey, l_linenumber, course_id, scraped_text,
       COALESCE(try_strptime(scraped_text, '%d/%m/%Y %H:%M'),
                try_strptime(scraped_text, '%Y-%m-%d %H:%M')) AS scraped_at
FROM (SELECT *, {D7_TEXT_SQL} AS scraped_text FROM fx_offers)""")
def d7_parse_ts(spark, sf):
    """Scrape stamps in both text formats (and garbage) -> TIMESTAMP."""
    o = fixtures.fx_offers(spark, sf)
    ln = F.col("l_linenumber")
    text = (F.when(ln == 5, F.lit("not a time"))
             .when(ln % 2 == 1, F.date_format("scraped_at", "dd/MM/yyyy HH:mm"))
             .otherwise(F.date_format("scraped_at", "yyyy-MM-dd HH:mm")))
    return (o.withColumn("scraped_text", text)
             .select("l_orderkey", "l_linenumber", "course_id", "scraped_text",
                     parse_timestamp(F.col("scraped_text")).cast("timestamp_ntz").alias("scraped_at")))


@register("d8_dedupe", O.with_(O.FX_OFFERS) + """
SELECT course_id, scraped_at, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY course_id, scraped_at ORDER BY l_orderkey, l_linenumber) AS rn
  FROM fx_offers) WHERE rn = 1""")
def d8_dedupe(spark, sf):
    """One row per (course, scrape time), total tie-break."""
    o = fixtures.fx_offers(spark, sf).select("course_id", "scraped_at", "l_orderkey", "l_linenumber")
    return staging.dedupe(o, ["course_id", "scraped_at"], ["l_orderkey", "l_linenumber"])


@register("d9_rating_breakdown", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id,
""" + ",\n".join(
    f"CAST(TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[{i}].count') AS INTEGER) "
    f"AS BIGINT) AS rating_{i + 1}" for i in range(5)) + " FROM fx_courses")
def d9_rating_breakdown(spark, sf):
    """JSON array element i ``.count`` -> INT."""
    o = fixtures.fx_courses(spark, sf)
    return o.select("l_orderkey", "l_linenumber", "course_id",
                    *[c.alias(n) for n, c in staging.rating_counts(F.col("rating_distribution")).items()])


@register("d9_event_props", """
SELECT event_id, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS k FROM events""")
def d9_event_props(spark, sf):
    """D9 (object access): a member of JSON object text."""
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", staging.json_field(F.col("props"), "$.k", "int").alias("k"))


@register("d10_nullif", O.with_(O.FX_COURSES) + """
SELECT l_orderkey, l_linenumber, course_id, NULLIF(rating_distribution, 'None') AS rating_distribution
FROM fx_courses""")
def d10_nullif(spark, sf):
    """Text ``None`` -> NULL."""
    return fixtures.fx_courses(spark, sf).select(
        "l_orderkey", "l_linenumber", "course_id",
        staging.none_to_null(F.col("rating_distribution")).alias("rating_distribution"))


@register("d11_valid_instructor", O.with_(O.FX_INSTRUCTORS) + """
SELECT instructor_id, course_id FROM fx_instructors WHERE instructor_id IS NOT NULL AND instructor_id <> '0'""")
def d11_valid_instructor(spark, sf):
    """Drop NULL and ``0`` instructor ids."""
    return staging.valid_instructor(fixtures.fx_instructors(spark, sf)).select("instructor_id", "course_id")


@register("d12_rename", O.with_(O.FX_OFFERS) + """
SELECT l_orderkey, l_linenumber, course_id, _url AS course_url, _category AS category FROM fx_offers""")
def d12_rename(spark, sf):
    """Staging column names."""
    return fixtures.fx_offers(spark, sf).select(
        "l_orderkey", "l_linenumber", "course_id",
        F.col("_url").alias("course_url"), F.col("_category").alias("category"))


STG_COURSES_OUT = """
SELECT course_id, title, headline, language, level, duration_hours, published_date, last_updated_date,
       CAST(list_price AS DOUBLE) AS list_price, CAST(sale_price AS DOUBLE) AS sale_price,
       num_students, num_reviews, CAST(rating AS DOUBLE) AS rating, course_url, category, scraped_at,
       rating_distribution, CAST(rating_1 AS BIGINT) AS rating_1, CAST(rating_2 AS BIGINT) AS rating_2,
       CAST(rating_3 AS BIGINT) AS rating_3, CAST(rating_4 AS BIGINT) AS rating_4,
       CAST(rating_5 AS BIGINT) AS rating_5
FROM stg_courses"""


@register("d13_stg_courses", O.with_(*O.COURSE_BASE) + STG_COURSES_OUT)
def d13_stg_courses(spark, sf):
    """The composed course staging model."""
    return W(spark, sf).stg_courses


@register("d14_stg_instructors", O.with_(*O.INSTR_BASE) + """
SELECT instructor_id, instructor_name, job_title, course_id, total_students,
       CAST(instructor_rating AS DOUBLE) AS instructor_rating, num_of_courses, total_num_reviews
FROM stg_instructors""")
def d14_stg_instructors(spark, sf):
    """The instructor staging model."""
    return W(spark, sf).stg_instructors


@register("d15_stg_price_tracker", O.with_(O.FX_OFFERS, O.STG_PRICE) + """
SELECT course_id, title, CAST(list_price AS DOUBLE) AS list_price, CAST(sale_price AS DOUBLE) AS sale_price,
       scraped_at, course_url FROM stg_price_tracker""")
def d15_stg_price_tracker(spark, sf):
    """The price-tracker staging model."""
    return W(spark, sf).stg_price_tracker


# =============================================================================== F: marts

GOLD_DIMS = (*O.COURSE_BASE, O.BEST_COURSE, O.DIMS)


@register("f1_dim_category", O.with_(*GOLD_DIMS) + "SELECT category_id, category_name FROM dim_category")
def f1_dim_category(spark, sf):
    """distinct non-null categories numbered in byte order."""
    return W(spark, sf).dim_category


@register("f2_dim_language", O.with_(*GOLD_DIMS) + "SELECT language_id, language_name FROM dim_language")
def f2_dim_language(spark, sf):
    """distinct non-null languages numbered in byte order."""
    return W(spark, sf).dim_language


@register("f3_dim_level", O.with_(*GOLD_DIMS) + "SELECT level_id, level_name FROM dim_level")
def f3_dim_level(spark, sf):
    """distinct non-null levels numbered in byte order."""
    return W(spark, sf).dim_level


@register("f4_best_record", O.with_(*O.COURSE_BASE, O.BEST_COURSE) + STG_COURSES_OUT.replace(
    "FROM stg_courses", "FROM best_course"))
def f4_best_record(spark, sf):
    """per course, students first, then newest."""
    return marts.best_course_record(W(spark, sf).stg_courses)


@register("f5_dim_course", O.with_(*GOLD_DIMS) + """
SELECT course_id, title, headline, course_url, published_date, duration_hours,
       CAST(list_price AS DOUBLE) AS list_price, category_id, language_id, level_id FROM dim_course""")
def f5_dim_course(spark, sf):
    """best record per course with category, language and level ids (J1, checked broadcast)."""
    return W(spark, sf).dim_course


BOUNDS_SQL = """
bounds AS (
SELECT min(least(published_date, last_updated_date, CAST(scraped_at AS DATE))) AS start_date,
       max(greatest(published_date, last_updated_date, CAST(scraped_at AS DATE))) AS end_date
FROM stg_courses),
spine AS (
SELECT CAST(unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP),
                                   INTERVAL 1 DAY)) AS DATE) AS date_day FROM bounds)"""


@register("f6_date_bounds", O.with_(*O.COURSE_BASE, BOUNDS_SQL) + "SELECT start_date, end_date FROM bounds")
def f6_date_bounds(spark, sf):
    """earliest and latest of published, updated and scrape dates (A1)."""
    return marts.date_bounds(W(spark, sf).stg_courses)


@register("f7_date_spine", O.with_(*O.COURSE_BASE, BOUNDS_SQL) + "SELECT date_day FROM spine")
def f7_date_spine(spark, sf):
    """one row per day between the bounds."""
    return marts.date_spine(marts.date_bounds(W(spark, sf).stg_courses))


@register("f8_dim_date", O.with_(*O.COURSE_BASE, BOUNDS_SQL) + """
SELECT date_day AS date_key, CAST(year(date_day) AS BIGINT) AS year, CAST(month(date_day) AS BIGINT) AS month,
       CAST(day(date_day) AS BIGINT) AS day, CAST(quarter(date_day) AS BIGINT) AS quarter,
       CAST(isodow(date_day) AS BIGINT) AS day_of_week, monthname(date_day) AS month_name,
       dayname(date_day) AS day_name, isodow(date_day) IN (6, 7) AS is_weekend,
       strftime(date_day, '%Y-%m') AS year_month
FROM spine""")
def f8_dim_date(spark, sf):
    """F8: calendar attributes per day."""
    return W(spark, sf).dim_date


@register("f9_dim_instructor", O.with_(*O.INSTR_BASE) + """
SELECT instructor_id, instructor_name, job_title FROM (
  SELECT *, row_number() OVER (PARTITION BY instructor_id ORDER BY total_students DESC NULLS LAST,
            course_id, instructor_name, job_title) AS rn FROM stg_instructors) WHERE rn = 1""")
def f9_dim_instructor(spark, sf):
    """per instructor, the row with most students."""
    return W(spark, sf).dim_instructor


@register("f10_bridge", O.with_(*O.INSTR_BASE) + "SELECT DISTINCT course_id, instructor_id FROM stg_instructors")
def f10_bridge(spark, sf):
    """distinct (course, instructor) pairs (A2)."""
    return W(spark, sf).bridge_course_instructors


@register("f11_hash_key", O.with_(O.FX_OFFERS, O.STG_PRICE) + f"""
SELECT course_id, scraped_at, {O.hash_sql('course_id', 'scraped_at')} AS history_id,
       md5(CAST(course_id AS VARCHAR) || '-' || CAST(NULL AS VARCHAR)) AS null_key
FROM stg_price_tracker""")
def f11_hash_key(spark, sf):
    """MD5 of dash-joined text; NULL in, NULL out."""
    p = W(spark, sf).stg_price_tracker
    return p.select("course_id", "scraped_at",
                    hash_key(F.col("course_id").cast("string"), timestamp_text(F.col("scraped_at"))).alias("history_id"),
                    hash_key(F.col("course_id").cast("string"), F.lit(None).cast("string")).alias("null_key"))


@register("f12_course_snapshot", O.with_(*O.COURSE_BASE, O.BEST_COURSE) + f"""
SELECT {O.hash_sql('course_id', 'scraped_at')} AS snapshot_id, course_id, num_students, num_reviews,
       CAST(rating AS DOUBLE) AS rating, CAST(rating_1 AS BIGINT) AS rating_1, CAST(rating_2 AS BIGINT) AS rating_2,
       CAST(rating_3 AS BIGINT) AS rating_3, CAST(rating_4 AS BIGINT) AS rating_4,
       CAST(rating_5 AS BIGINT) AS rating_5, last_updated_date, scraped_at
FROM best_course""")
def f12_course_snapshot(spark, sf):
    """snapshot fact: best record per course with an MD5 key."""
    return W(spark, sf).fct_course_snapshot


@register("f13_discount_pct", O.with_(O.FX_OFFERS, O.STG_PRICE) + f"""
SELECT course_id, scraped_at, CAST(list_price AS DOUBLE) AS list_price, CAST(sale_price AS DOUBLE) AS sale_price,
       {O.DISCOUNT} AS discount_percentage FROM stg_price_tracker""")
def f13_discount_pct(spark, sf):
    """discount percentage of each price row (exact HALF_UP)."""
    p = W(spark, sf).stg_price_tracker
    return p.select("course_id", "scraped_at", "list_price", "sale_price",
                    discount_percentage(F.col("list_price"), F.col("sale_price")).alias("discount_percentage"))


@register("f14_all_time_low", O.with_(*O.PRICE_BASE) + """
SELECT course_id, recorded_at, CAST(sale_price AS DOUBLE) AS sale_price, is_lowest_price_ever
FROM fct_price_history""")
def f14_all_time_low(spark, sf):
    """all-time-low flag against the course's minimum positive price."""
    p = W(spark, sf).prices.select("course_id", "recorded_at", "sale_price")
    return marts.lowest_price_flag(p)


@register("f15_price_history", O.with_(*O.PRICE_BASE) + """
SELECT history_id, course_id, title, course_url, CAST(list_price AS DOUBLE) AS list_price,
       CAST(sale_price AS DOUBLE) AS sale_price, recorded_at, discount_percentage, is_lowest_price_ever
FROM fct_price_history""")
def f15_price_history(spark, sf):
    """price-history fact (key, discount, all-time low)."""
    return W(spark, sf).fct_price_history


# =============================================================================== G: serving (courses)

PER_COURSE_OUT = """
SELECT course_id, title, category, language, level, CAST(rating AS DOUBLE) AS rating, num_students,
       num_reviews, CAST(list_price AS DOUBLE) AS list_price, CAST(sale_price AS DOUBLE) AS sale_price,
       duration_hours, course_url, scraped_at, CAST(rating_1 AS BIGINT) AS rating_1,
       CAST(rating_2 AS BIGINT) AS rating_2, CAST(rating_3 AS BIGINT) AS rating_3,
       CAST(rating_4 AS BIGINT) AS rating_4, CAST(rating_5 AS BIGINT) AS rating_5"""
METRIC_OUT = """, CAST(est_revenue AS DOUBLE) AS est_revenue, CAST(pct_h AS DOUBLE) / 100 AS pct_review,
       price_tier, duration_tier, rating_tier"""


@register("g1_latest_courses", O.with_(*O.COURSE_BASE, O.LATEST) + PER_COURSE_OUT + " FROM latest")
def g1_latest_courses(spark, sf):
    """G1: latest titled record per course."""
    return serving.latest_courses(W(spark, sf).stg_courses)


@register("j2_course_instructor", O.with_(*O.GOLD_BASE) + PER_COURSE_OUT + """, i.instructor_name
FROM latest LEFT JOIN stg_instructors i USING (course_id)""")
def j2_course_instructor(spark, sf):
    """Latest course rows fanned out to their instructors."""
    w = W(spark, sf)
    return serving.course_instructors(serving.latest_courses(w.stg_courses), w.stg_instructors)


@register("g3_est_revenue", O.with_(*O.GOLD_BASE) + """
SELECT course_id, num_students, CAST(sale_price AS DOUBLE) AS sale_price, CAST(est_revenue AS DOUBLE) AS est_revenue
FROM metrics""")
def g3_est_revenue(spark, sf):
    """Estimated revenue = students x sale price."""
    m = serving.course_metrics(serving.latest_courses(W(spark, sf).stg_courses))
    return m.select("course_id", "num_students", "sale_price", "est_revenue")


@register("g4_pct_review", O.with_(*O.GOLD_BASE) + """
SELECT course_id, num_students, num_reviews, CAST(pct_h AS DOUBLE) / 100 AS pct_review FROM metrics""")
def g4_pct_review(spark, sf):
    """Reviews as a percent of students."""
    m = serving.course_metrics(serving.latest_courses(W(spark, sf).stg_courses))
    return m.select("course_id", "num_students", "num_reviews", "pct_review")


@register("g5_price_tier", O.with_(*O.GOLD_BASE) + """
SELECT course_id, CAST(sale_price AS DOUBLE) AS sale_price, price_tier FROM metrics""")
def g5_price_tier(spark, sf):
    """Price tier labels."""
    m = serving.course_metrics(serving.latest_courses(W(spark, sf).stg_courses))
    return m.select("course_id", "sale_price", "price_tier")


@register("g6_duration_tier", O.with_(*O.GOLD_BASE) + """
SELECT course_id, duration_hours, duration_tier FROM metrics""")
def g6_duration_tier(spark, sf):
    """Duration tier labels."""
    m = serving.course_metrics(serving.latest_courses(W(spark, sf).stg_courses))
    return m.select("course_id", "duration_hours", "duration_tier")


@register("g7_rating_tier", O.with_(*O.GOLD_BASE) + """
SELECT course_id, CAST(rating AS DOUBLE) AS rating, rating_tier FROM metrics""")
def g7_rating_tier(spark, sf):
    """Rating tier labels."""
    m = serving.course_metrics(serving.latest_courses(W(spark, sf).stg_courses))
    return m.select("course_id", "rating", "rating_tier")


@register("g8_course_mart", O.with_(*O.GOLD_BASE) + PER_COURSE_OUT + METRIC_OUT + """, i.instructor_name
FROM metrics LEFT JOIN stg_instructors i USING (course_id)""")
def g8_course_mart(spark, sf):
    """The dashboard's base table (one row per course x instructor row)."""
    w = W(spark, sf)
    return serving.course_mart(w.stg_courses, w.stg_instructors)


# Filter settings of the query set: a category, a tier and a rating tier present in the fixtures.
G9_ARGS = dict(category="Brand#13", price_tier="Very High Price (> 1.5M)", level=None,
               rating_tier="Good (4 - 5)")


@register("g9_filters", O.with_(*O.GOLD_BASE) + PER_COURSE_OUT + METRIC_OUT + """, instructor_name
FROM per_course WHERE category = 'Brand#13' AND price_tier = 'Very High Price (> 1.5M)'
  AND rating_tier = 'Good (4 - 5)'""")
def g9_filters(spark, sf):
    """Conjunctive dashboard filters ("All" = off)."""
    return serving.apply_filters(W(spark, sf).per_course, **G9_ARGS)


@register("g10_facets", O.with_(*O.GOLD_BASE) + """
SELECT DISTINCT category FROM per_course WHERE category IS NOT NULL""")
def g10_facets(spark, sf):
    """Sorted distinct categories for the filter box."""
    return serving.facets(W(spark, sf).per_course, "category")


@register("g11_dedupe_course", O.with_(*O.GOLD_BASE) + PER_COURSE_OUT + METRIC_OUT + """, instructor_name
FROM per_course""")
def g11_dedupe_course(spark, sf):
    """One row per course (first instructor by name)."""
    return W(spark, sf).per_course


def kpi_sql(where: str = "") -> str:
    return f"""
SELECT count(DISTINCT course_id) AS total_courses,
       CAST(COALESCE(sum(num_students), 0) AS BIGINT) AS total_enroll,
       CAST(COALESCE(sum(est_revenue), 0) AS DOUBLE) AS total_revenue,
       COALESCE(CAST(sum(sale_price) FILTER (WHERE sale_price > 0) AS DOUBLE)
                / count(sale_price) FILTER (WHERE sale_price > 0), 0) AS avg_price,
       COALESCE(CAST(sum(pct_h) FILTER (WHERE num_students > 0) AS DOUBLE) / 100
                / count(pct_h) FILTER (WHERE num_students > 0), 0) AS pct_review_avg,
       COALESCE(CAST(sum(rating) FILTER (WHERE rating > 0) AS DOUBLE)
                / count(rating) FILTER (WHERE rating > 0), 0) AS avg_rating
FROM per_course {where}"""


@register("g12_overview_kpis", O.with_(*O.GOLD_BASE) + kpi_sql())
def g12_overview_kpis(spark, sf):
    """G12 (flagship): overview KPIs over the whole model graph."""
    return serving.overview_kpis(W(spark, sf).per_course)


@register("g13_category_perf", O.with_(*O.GOLD_BASE) + """
SELECT category, count(DISTINCT course_id) AS total_courses, CAST(sum(num_students) AS BIGINT) AS total_enroll,
       count(DISTINCT instructor_name) AS total_instructors, CAST(sum(est_revenue) AS DOUBLE) AS total_revenue
FROM per_course WHERE category IS NOT NULL GROUP BY category""")
def g13_category_perf(spark, sf):
    """Courses, enrolments, instructors and revenue per category."""
    return serving.category_performance(W(spark, sf).per_course)


def _tier_list(labels):
    return ", ".join("'" + x + "'" for x in labels)


@register("g14_by_price", O.with_(*O.GOLD_BASE) + f"""
SELECT price_tier, count(DISTINCT course_id) AS course_count,
       CAST(list_position([{_tier_list(serving.PRICE_TIERS)}], price_tier) AS BIGINT) AS tier_order
FROM per_course GROUP BY price_tier""")
def g14_by_price(spark, sf):
    """Courses per price tier in tier order."""
    return serving.courses_by_price_tier(W(spark, sf).per_course)


@register("g15_by_level", O.with_(*O.GOLD_BASE) + """
SELECT level, count(DISTINCT course_id) AS course_count FROM per_course WHERE level IS NOT NULL GROUP BY level""")
def g15_by_level(spark, sf):
    """Courses per non-null level."""
    return serving.courses_by_level(W(spark, sf).per_course)


@register("g16_by_rating", O.with_(*O.GOLD_BASE) + """
SELECT rating_tier, count(DISTINCT course_id) AS course_count FROM per_course
WHERE rating_tier <> 'No Rating' GROUP BY rating_tier""")
def g16_by_rating(spark, sf):
    """Courses per rating tier without the no-rating bucket."""
    return serving.courses_by_rating(W(spark, sf).per_course)


@register("g17_by_duration", O.with_(*O.GOLD_BASE) + f"""
SELECT duration_tier, count(DISTINCT course_id) AS course_count,
       CAST(list_position([{_tier_list(serving.DURATION_TIERS)}], duration_tier) AS BIGINT) AS tier_order
FROM per_course WHERE duration_tier <> 'Unknown' GROUP BY duration_tier""")
def g17_by_duration(spark, sf):
    """Courses per duration tier, unknown dropped, tier order."""
    return serving.courses_by_duration(W(spark, sf).per_course)


@register("g18_share", O.with_(*O.GOLD_BASE) + """
SELECT level, course_count,
       """ + O.rdiv("course_count * 100", "sum(course_count) OVER ()", 1) + """ AS share_pct
FROM (SELECT level, count(DISTINCT course_id) AS course_count FROM per_course
      WHERE level IS NOT NULL GROUP BY level)""")
def g18_share(spark, sf):
    """Level shares of all leveled courses (percent labels of the donut)."""
    return serving.share_of_total(serving.courses_by_level(W(spark, sf).per_course))


@register("g19_best_courses", O.with_(*O.GOLD_BASE) + """
SELECT course_id, title, num_students, CAST(est_revenue AS DOUBLE) AS est_revenue, CAST(rating AS DOUBLE) AS rating,
       CAST(pct_h AS DOUBLE) / 100 AS pct_review, CAST(list_price AS DOUBLE) AS list_price, level, category,
       course_url, instructor_name
FROM per_course""")
def g19_best_courses(spark, sf):
    """Ranking by enrolments, no row cap."""
    return serving.best_courses(W(spark, sf).per_course)


G20_QUERY = "almond|(?:^| )blue"


@register("g20_search", O.with_(*O.GOLD_BASE) + f"""
SELECT course_id, title FROM per_course WHERE COALESCE(regexp_matches(title, '{G20_QUERY}', 'i'), false)""")
def g20_search(spark, sf):
    """Regex title search, case-insensitive."""
    return serving.search_title(W(spark, sf).per_course, G20_QUERY).select("course_id", "title")


@register("g21_filtered_kpis", O.with_(*O.GOLD_BASE) + """
SELECT total_courses, total_enroll, total_revenue, avg_rating FROM (""" + kpi_sql(
    "WHERE category = 'Brand#13' AND price_tier = 'Very High Price (> 1.5M)' AND rating_tier = 'Good (4 - 5)'") + ")")
def g21_filtered_kpis(spark, sf):
    """The ranking page's four KPIs after the G9 filters."""
    return serving.filtered_kpis(serving.apply_filters(W(spark, sf).per_course, **G9_ARGS))


# =============================================================================== G: serving (prices)

HIST_OUT = """
SELECT course_id, title, course_url, CAST(list_price AS DOUBLE) AS list_price,
       CAST(sale_price AS DOUBLE) AS sale_price, recorded_at, discount_percentage, is_lowest_price_ever, category"""
PH = O.with_(*O.ENRICHED)


@register("g2_price_history_enriched", PH + HIST_OUT + " FROM history")
def g2_price_history_enriched(spark, sf):
    """History + category through dim_course and dim_category (J3), in course/time order."""
    return serving.ordered_history(W(spark, sf).price_history_via_dims)


@register("g22_price_type", PH + HIST_OUT + " FROM history WHERE list_price > 0")
def g22_price_type(spark, sf):
    """Paid courses' price history."""
    return serving.price_type_filter(W(spark, sf).price_history, "Paid")


@register("g23_tracker_category", PH + HIST_OUT + " FROM history WHERE category = 'Brand#13'")
def g23_tracker_category(spark, sf):
    """Price history of one category."""
    return serving.tracker_category_filter(W(spark, sf).price_history, "Brand#13")


TOP2 = """
top2 AS (
SELECT course_id, sale_price, rn FROM (
  SELECT course_id, sale_price,
         row_number() OVER (PARTITION BY course_id ORDER BY recorded_at DESC NULLS LAST, sale_price) AS rn
  FROM history WHERE sale_price > 0) WHERE rn <= 2),
dropped AS (
SELECT course_id, max(CASE WHEN rn = 1 THEN sale_price END) AS last_price,
       max(CASE WHEN rn = 2 THEN sale_price END) AS previous_price
FROM top2 GROUP BY course_id HAVING max(CASE WHEN rn = 1 THEN sale_price END) < max(CASE WHEN rn = 2 THEN sale_price END))"""
PH2 = O.with_(*O.ENRICHED, TOP2)


@register("g25_dropped_courses", PH2 + """
SELECT course_id, CAST(last_price AS DOUBLE) AS last_price, CAST(previous_price AS DOUBLE) AS previous_price
FROM dropped""")
def g25_dropped_courses(spark, sf):
    """Courses whose last positive price fell below the one before."""
    return serving.dropped_courses(W(spark, sf).titled_prices)


@register("g24_drop_only", PH2 + HIST_OUT + " FROM history WHERE course_id IN (SELECT course_id FROM dropped)")
def g24_drop_only(spark, sf):
    """History rows of the dropped courses."""
    w = W(spark, sf)
    return serving.tracker_drop_only(w.prices, w.course_category)


@register("g26_selector", PH + """
SELECT course_id, title, title || '  (ID: ' || CAST(course_id AS VARCHAR) || ')' AS label FROM (
  SELECT course_id, title, row_number() OVER (PARTITION BY course_id ORDER BY recorded_at NULLS LAST, title) AS rn
  FROM history) WHERE rn = 1""")
def g26_selector(spark, sf):
    """Course picker entries labelled by title and id."""
    return serving.course_selector(W(spark, sf).titled_prices)


CURPREV = """
latest_row AS (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY course_id
               ORDER BY recorded_at DESC NULLS LAST, sale_price) AS rn FROM history) WHERE rn = 1),
cp AS (
SELECT l.course_id, l.title, l.course_url, l.category, l.sale_price AS current_price, l.list_price,
       l.discount_percentage, l.is_lowest_price_ever, l.recorded_at AS latest_at, t.sale_price AS previous_price
FROM latest_row l LEFT JOIN top2 t ON l.course_id = t.course_id AND t.rn = 2)"""
PH3 = O.with_(*O.ENRICHED, TOP2, CURPREV)
CP_OUT = """
SELECT course_id, title, course_url, category, CAST(current_price AS DOUBLE) AS current_price,
       CAST(list_price AS DOUBLE) AS list_price, discount_percentage, is_lowest_price_ever, latest_at,
       CAST(previous_price AS DOUBLE) AS previous_price"""
DROPPED_SQL = "(previous_price IS NOT NULL AND current_price > 0 AND current_price < previous_price)"


def pct_change_sql(old: str, new: str, scale: int = 1) -> str:
    return O.rdiv_signed(f"({O.cents(old)} - {O.cents(new)}) * 100", O.cents(old), scale)


@register("g27_current_previous", PH3 + CP_OUT + " FROM cp")
def g27_current_previous(spark, sf):
    """Current price and the previous positive price for every course."""
    return W(spark, sf).current_previous


@register("g28_display_discount", PH3 + CP_OUT + f""",
       CASE WHEN {DROPPED_SQL} THEN {pct_change_sql('previous_price', 'current_price')}
            ELSE discount_percentage END AS display_discount
FROM cp""")
def g28_display_discount(spark, sf):
    """Displayed discount (drop vs previous, else stored)."""
    return serving.display_discount(W(spark, sf).current_previous)


@register("g29_price_alerts", PH3 + f"""
SELECT course_id, title, CAST(current_price AS DOUBLE) AS current_price,
       CAST(previous_price AS DOUBLE) AS previous_price, CAST(list_price AS DOUBLE) AS list_price,
       COALESCE({DROPPED_SQL}, false) AS price_dropped,
       (is_lowest_price_ever AND current_price > 0) AS all_time_low,
       CAST(CASE WHEN {DROPPED_SQL} THEN previous_price - current_price END AS DOUBLE) AS drop_amount
FROM cp WHERE COALESCE({DROPPED_SQL}, false) OR (is_lowest_price_ever AND current_price > 0)""")
def g29_price_alerts(spark, sf):
    """Dropped or all-time-low courses with the drop amount."""
    return serving.price_alerts(W(spark, sf).current_previous)


CHART = """
chart AS (
SELECT h.* FROM history h
JOIN (SELECT course_id, count(*) FILTER (WHERE sale_price > 0) AS npos FROM history GROUP BY course_id) c
  USING (course_id)
WHERE c.npos <= 1 OR h.sale_price > 0)"""


@register("g30_chart_series", O.with_(*O.ENRICHED, CHART) + HIST_OUT + " FROM chart")
def g30_chart_series(spark, sf):
    """Chart rows (positive prices when more than one)."""
    return serving.chart_series(W(spark, sf).price_tracker)


@register("g31_lowest_points", O.with_(*O.ENRICHED, CHART) + HIST_OUT + " FROM chart WHERE is_lowest_price_ever")
def g31_lowest_points(spark, sf):
    """All-time-low markers of the chart rows."""
    return serving.lowest_points(W(spark, sf).price_tracker)


@register("g32_history_drop", PH + f"""
SELECT course_id, CAST(recorded_at AS DATE) AS recorded_date, CAST(list_price AS DOUBLE) AS list_price,
       CAST(sale_price AS DOUBLE) AS sale_price, CAST(prev_price AS DOUBLE) AS prev_price,
       CASE WHEN prev_price IS NOT NULL AND sale_price > 0 AND prev_price > sale_price
            THEN {pct_change_sql('prev_price', 'sale_price')} ELSE discount_percentage END AS discount_percentage,
       is_lowest_price_ever
FROM (SELECT *, lag(sale_price) OVER (PARTITION BY course_id ORDER BY recorded_at) AS prev_price FROM history)""")
def g32_history_drop(spark, sf):
    """Per-row drop vs the previous row, newest first."""
    w = W(spark, sf)
    return serving.history_with_drop(w.titled_prices, w.prices)


REF = "COALESCE(previous_price, list_price)"


@register("g33_alert_reasons", PH3 + f"""
SELECT course_id, title, CAST(current_price AS DOUBLE) AS current_price, CAST({REF} AS DOUBLE) AS reference_price,
       CASE WHEN {REF} > 0 THEN {pct_change_sql(REF, 'current_price')}
            WHEN list_price > 0 THEN {pct_change_sql('list_price', 'current_price')} ELSE 0 END AS drop_pct,
       COALESCE(NULLIF(concat_ws(', ',
           CASE WHEN {REF} <> 0 AND current_price < {REF} THEN '{serving.REASON_DROPPED}' END,
           CASE WHEN is_lowest_price_ever THEN '{serving.REASON_LOWEST}' END), ''),
           '{serving.REASON_OTHER}') AS reasons
FROM cp""")
def g33_alert_reasons(spark, sf):
    """Alert reason text and drop percent."""
    return serving.alert_reasons(W(spark, sf).current_previous)


@register("g34_alert_eligible", PH3 + f"""
SELECT course_id, COALESCE({DROPPED_SQL} OR (is_lowest_price_ever AND current_price > 0), false) AS alert_eligible
FROM cp""")
def g34_alert_eligible(spark, sf):
    """Whether an alert may be sent."""
    return serving.alert_eligible(W(spark, sf).current_previous)


# =============================================================================== X: display formats

CAT_TOTALS = """
cat_totals AS (
SELECT category, sum(num_students) AS total_enroll, sum(est_revenue) AS total_revenue
FROM per_course WHERE category IS NOT NULL GROUP BY category)"""


def _cat_totals(spark, sf):
    return (W(spark, sf).per_course.filter(F.col("category").isNotNull()).groupBy("category")
            .agg(F.sum("num_students").alias("total_enroll"), F.sum("est_revenue").alias("total_revenue")))


@register("x12_fmt_k", O.with_(*O.GOLD_BASE, CAT_TOTALS) + f"""
SELECT category, {O.fmt_k_sql('total_enroll')} AS enroll_text, {O.fmt_k_sql('total_revenue')} AS revenue_text,
       {O.fmt_k_sql('total_enroll / 100')} AS small_text
FROM cat_totals""")
def x12_fmt_k(spark, sf):
    """K / M abbreviations of per-category totals."""
    t = _cat_totals(spark, sf)
    small = (F.col("total_enroll").cast("decimal(20,0)") / 100).cast("decimal(20,2)")
    return t.select("category", fmt.fmt_k(F.col("total_enroll")).alias("enroll_text"),
                    fmt.fmt_k(F.col("total_revenue")).alias("revenue_text"),
                    fmt.fmt_k(small).alias("small_text"))


@register("x13_fmt_vnd", O.with_(*O.GOLD_BASE, CAT_TOTALS) + f"""
SELECT p.course_id, {O.fmt_vnd_sql('p.sale_price')} AS sale_text, {O.fmt_vnd_sql('p.est_revenue')} AS revenue_text,
       {O.fmt_vnd_sql('t.total_revenue')} AS category_revenue_text
FROM per_course p LEFT JOIN cat_totals t USING (category)""")
def x13_fmt_vnd(spark, sf):
    """Free / M d / T d / thousands of prices and revenues."""
    p = W(spark, sf).per_course
    t = _cat_totals(spark, sf).select("category", "total_revenue")
    j = p.join(t, "category", "left")
    return j.select("course_id", fmt.fmt_vnd(F.col("sale_price")).alias("sale_text"),
                    fmt.fmt_vnd(F.col("est_revenue")).alias("revenue_text"),
                    fmt.fmt_vnd(F.col("total_revenue")).alias("category_revenue_text"))


@register("x14_fmt_bn", O.with_(*O.GOLD_BASE, CAT_TOTALS) + f"""
SELECT p.course_id, {O.fmt_bn_sql('p.est_revenue')} AS revenue_text,
       {O.fmt_bn_sql('t.total_revenue * 1000')} AS scaled_text, {O.fmt_bn_sql('p.sale_price')} AS price_text
FROM per_course p LEFT JOIN cat_totals t USING (category)""")
def x14_fmt_bn(spark, sf):
    """0 / M d / B d / T d revenue labels."""
    p = W(spark, sf).per_course
    t = _cat_totals(spark, sf).select("category", "total_revenue")
    j = p.join(t, "category", "left")
    return j.select("course_id", fmt.fmt_bn(F.col("est_revenue")).alias("revenue_text"),
                    fmt.fmt_bn(F.col("total_revenue") * 1000).alias("scaled_text"),
                    fmt.fmt_bn(F.col("sale_price")).alias("price_text"))


@register("x15_display_format", O.with_(*O.GOLD_BASE) + f"""
SELECT course_id, title AS course,
       CASE WHEN num_students > 0 THEN {O.fmt_k_sql('num_students')} ELSE '0' END AS total_subscribers,
       {O.fmt_bn_sql('est_revenue')} AS total_revenue,
       CASE WHEN rating > 0 THEN {O.fixed_sql('rating', 2)} ELSE '-' END AS rating,
       CASE WHEN pct_h > 0 THEN {O._fixed_text('pct_h', 100, 2)} || '%' ELSE '-' END AS pct_review,
       CASE WHEN list_price > 0 THEN {O._thousands('list_price')} ELSE 'Free' END AS list_price
FROM per_course""")
def x15_display_format(spark, sf):
    """The ranking's display strings."""
    return serving.display_best_courses(serving.best_courses(W(spark, sf).per_course))


# =============================================================================== S: sources, sinks, ingest

from coursewise.operators import cleaning  # noqa: E402
from coursewise.session import read_table, work_dir  # noqa: E402
from coursewise.sources import files, ledger  # noqa: E402

PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"


@register("s1_scan_parquet", PART_SQL)
def s1_scan_parquet(spark, sf):
    """A landing folder of parquet files read with an explicit schema."""
    part = read_table(spark, sf, "part")
    root = work_dir(spark, "s1")
    files.write_parquet(part.repartition(3), root, "snappy")
    return files.read_parquet_dir(spark, root, part.schema).select(*PART_COLS)


@register("s2_recursive_scan", PART_SQL)
def s2_recursive_scan(spark, sf):
    """Parquet files at any depth under a root; other files ignored."""
    part = read_table(spark, sf, "part")
    root = work_dir(spark, "s2")
    even = F.coalesce(F.col("p_size") % 2 == 0, F.lit(False))
    files.write_parquet(part.filter(even), f"{root}/even", "snappy")
    files.write_parquet(part.filter(~even), f"{root}/odd/deeper", "snappy")
    files.write_csv(part, f"{root}/odd/not_parquet")
    return files.read_parquet_tree(spark, root, schema=part.schema).select(*PART_COLS)


CSV_SQL = """SELECT s_suppkey, 'say "' || s_name || '", ok' || chr(10) || '  next line ' AS s_name,
       CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier"""


def _awkward_suppliers(spark, sf):
    """Suppliers whose names hold quotes, commas, line breaks and spaces at the end."""
    name = F.concat(F.lit('say "'), "s_name", F.lit('", ok\n  next line '))
    return read_table(spark, sf, "supplier").select("s_suppkey", name.alias("s_name"), "s_nationkey", "s_acctbal")


@register("s3_csv_roundtrip", CSV_SQL)
def s3_csv_roundtrip(spark, sf):
    """S3: CSV with header read back with an explicit schema; quotes, commas and line breaks survive, though a file is read by many tasks."""
    supp = _awkward_suppliers(spark, sf)
    return files.read_csv_split(spark, files.write_csv(supp, work_dir(spark, "s3")), supp.schema)


@register("s4_csv_to_parquet", """
SELECT 'part' AS table_name, count(*) AS row_count FROM part
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'not_there', NULL""")
def s4_csv_to_parquet(spark, sf):
    """Named CSVs converted to named parquet targets, rows reported; a missing CSV is reported and skipped."""
    root = work_dir(spark, "s4")
    mapping = {f"{root}/parquet/not_there": (f"{root}/csv/not_there", "a string")}
    for name, t in (("part", read_table(spark, sf, "part")), ("supplier", _awkward_suppliers(spark, sf))):
        files.write_csv(t, f"{root}/csv/{name}")
        mapping[f"{root}/parquet/{name}"] = (f"{root}/csv/{name}", t.schema)
    rep = files.csv_to_parquet(spark, mapping)
    return rep.select(F.regexp_extract("target", r"([^/]+)$", 1).alias("table_name"), "row_count")


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_shipdate"]


@register("s5_parquet_gzip", "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS "
          "l_linenumber, l_quantity, l_extendedprice, l_discount, l_shipdate FROM lineitem")
def s5_parquet_gzip(spark, sf):
    """Gzip-compressed batch output read back."""
    li = read_table(spark, sf, "lineitem").select(*LI_COLS)
    path = files.write_parquet(li, work_dir(spark, "s5"), "gzip")
    return spark.read.parquet(path)


BATCH = "TEST_dashboard_group1_p1-2_20240101_000000"


@register("s6_route_files", O.with_(O.FX_COURSES, O.FX_OFFERS, O.FX_INSTRUCTORS) + """
SELECT 'courses' AS target, count(*) AS row_count FROM fx_courses
UNION ALL SELECT 'price_tracker', count(*) FROM fx_offers
UNION ALL SELECT 'instructors', count(*) FROM fx_instructors
UNION ALL SELECT NULL, count(*) FROM part""")
def s6_route_files(spark, sf):
    """Routing of landed files to raw tables by object name."""
    root = work_dir(spark, "s6")
    files.write_parquet(fixtures.fx_courses(spark, sf), f"{root}/dashboard/{BATCH}_courses.parquet")
    files.write_parquet(fixtures.fx_instructors(spark, sf), f"{root}/dashboard/{BATCH}_instructors.parquet")
    files.write_parquet(fixtures.fx_offers(spark, sf),
                        f"{root}/tracker/PROD_tracker_group1_p1-2_20240101_000000_courses.parquet")
    files.write_parquet(read_table(spark, sf, "part"), f"{root}/misc/notes_other.parquet")
    landed = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(root)
    # a file is routed once, not each of its rows
    per_file = landed.groupBy(F.col("_metadata.file_path").alias("_source_file")).agg(F.count(F.lit(1)).alias("n"))
    return ledger.route_by_filename(per_file).groupBy("target").agg(F.sum("n").alias("row_count"))


@register("s7_pending_files", O.with_(O.FX_LISTING, O.FX_LEDGER) + """
SELECT filename FROM fx_listing WHERE filename NOT IN (SELECT filename FROM fx_ledger WHERE status = 'SUCCESS')""")
def s7_pending_files(spark, sf):
    """Listed files without a successful load."""
    return ledger.pending_files(fixtures.fx_listing(spark, sf), fixtures.fx_ledger(spark, sf))


LATEST_LEDGER = """
latest_ledger AS (
SELECT filename, status, loaded_at, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY filename ORDER BY loaded_at DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM fx_ledger) WHERE rn = 1)"""


def _latest_ledger(spark, sf):
    return ledger.upsert_ledger(fixtures.fx_ledger(spark, sf),
                                order=[F.col("loaded_at").desc_nulls_last(), F.col("o_orderkey").desc()])


@register("s8_ledger_upsert", O.with_(O.FX_LEDGER, LATEST_LEDGER) + "SELECT * FROM latest_ledger")
def s8_ledger_upsert(spark, sf):
    """Insert-or-replace per file name (newest record wins)."""
    return _latest_ledger(spark, sf)


@register("s9_append_raw", """
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
       CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice FROM part""")
def s9_append_raw(spark, sf):
    """Two appended batches, the second with an extra column; union by name."""
    part = read_table(spark, sf, "part")
    path = work_dir(spark, "s9")
    small = F.coalesce(F.col("p_size") <= 25, F.lit(True))
    ledger.append_raw(part.filter(small).drop("p_retailprice"), path)
    ledger.append_raw(part.filter(~small), path)
    return ledger.read_raw(spark, path).select(*PART_COLS)


@register("s11_load_report", O.with_(O.FX_LEDGER, LATEST_LEDGER) + """
SELECT status, count(*) AS n_files, CAST(NULL AS BIGINT) AS n_rows, min(loaded_at) AS first_loaded,
       max(loaded_at) AS last_loaded FROM latest_ledger GROUP BY status""")
def s11_load_report(spark, sf):
    """Success / failed counts over the current ledger."""
    return ledger.load_report(_latest_ledger(spark, sf))


@register("s13_export_csv", """
SELECT 'nation' AS table_name, count(*) AS row_count FROM nation
UNION ALL SELECT 'region', count(*) FROM region
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'nested', NULL""")
def s13_export_csv(spark, sf):
    """Tables exported as CSV with header; rows written per table, line breaks or not; one that CSV cannot hold is reported."""
    tables = {n: read_table(spark, sf, n) for n in ("nation", "region", "customer")}
    tables |= {"supplier": _awkward_suppliers(spark, sf), "nested": read_table(spark, sf, "nation").select(F.struct("n_name").alias("n"))}
    return files.export_csv(spark, tables, work_dir(spark, "s13")).select("table_name", "row_count")


@register("s14_materialize", O.with_(*O.PRICE_BASE) + """
SELECT history_id, course_id, title, course_url, CAST(list_price AS DOUBLE) AS list_price,
       CAST(sale_price AS DOUBLE) AS sale_price, recorded_at, discount_percentage, is_lowest_price_ever
FROM fct_price_history""")
def s14_materialize(spark, sf):
    """A mart materialised as a table (rebuild) and read back."""
    out = W(spark, sf).build(work_dir(spark, "s14"), ("fct_price_history",))
    return spark.read.parquet(out["fct_price_history"]).select(*marts.PRICE_HISTORY_COLUMNS)


@register("s15_partitioned_layout", O.with_(O.FX_OFFERS) + """
SELECT course_id, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_orderkey, strftime(scraped_at, '%Y-%m') AS ingest_month,
       'tracker' AS job, 'PROD' AS mode FROM fx_offers WHERE year(scraped_at) = 1995""")
def s15_partitioned_layout(spark, sf):
    """Batches partitioned by job/mode/month; a month filter prunes folders."""
    offers = fixtures.fx_offers(spark, sf).select("course_id", "l_linenumber", "l_orderkey",
                                                   F.col("scraped_at").alias("_scraped_at"))
    laid = files.batch_layout(offers, "tracker", "PROD", "group1", 1, 2)
    path = files.write_partitioned(laid, work_dir(spark, "s15"))
    back = spark.read.parquet(path)
    return (back.filter(F.col("ingest_month").startswith("1995-"))
                .select("course_id", "l_linenumber", "l_orderkey", "ingest_month", "job", "mode"))


# =============================================================================== C: bronze cleaning

MESSY = {"course_id": " Course ID", "title": "TITLE ", "original_price": "Original Price",
         "discount_price": "Discount  Price", "_category": " _Category"}


@register("c1_normalize_columns", O.with_(O.FX_OFFERS) + """
SELECT course_id, title, CAST(original_price AS DOUBLE) AS original_price,
       CAST(discount_price AS DOUBLE) AS discount__price, _category FROM fx_offers""")
def c1_normalize_columns(spark, sf):
    """Header clean-up of a CSV-style frame."""
    o = fixtures.fx_offers(spark, sf).select(*[F.col(k).alias(v) for k, v in MESSY.items()])
    return cleaning.normalize_columns(o)


@register("c2_nested_to_json", """
SELECT p_partkey, to_json(struct_pack(p_partkey := p_partkey, p_name := p_name, p_size := p_size)) AS meta,
       to_json([p_brand, p_type]) AS tags FROM part""")
def c2_nested_to_json(spark, sf):
    """Nested columns written as JSON text."""
    part = read_table(spark, sf, "part")
    nested = part.select("p_partkey", F.struct("p_partkey", "p_name", "p_size").alias("meta"),
                         F.array("p_brand", "p_type").alias("tags"))
    return cleaning.nested_to_json(nested)


NAN_SQL = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, course_id,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE num_students END AS num_students,
       num_reviews, avg_rating_score, course_duration_seconds FROM fx_courses"""


@register("c3_nan_to_null", O.with_(O.FX_COURSES) + NAN_SQL)
def c3_nan_to_null(spark, sf):
    """NaN in float columns -> NULL."""
    c = fixtures.fx_courses(spark, sf)
    c = c.withColumn("num_students", F.when(F.col("l_linenumber") == 3, F.lit(float("nan")))
                                      .otherwise(F.col("num_students")))
    return cleaning.nan_to_null(c.select("l_orderkey", "l_linenumber", "course_id", "num_students",
                                         "num_reviews", "avg_rating_score", "course_duration_seconds"))


@register("c4_try_numeric", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END AS qty FROM lineitem""")
def c4_try_numeric(spark, sf):
    """C4: text numbers with junk -> DOUBLE, junk -> NULL."""
    li = read_table(spark, sf, "lineitem")
    t = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_linenumber") == 5, F.lit("n/a"))
                   .otherwise(F.col("l_quantity").cast("string")).alias("qty"))
    return cleaning.to_numeric(t, ["qty"])


@register("c5_split_parent_child", """
SELECT l_orderkey * 10 + l_linenumber AS course_id, CAST(l_suppkey AS VARCHAR) AS instructor_id, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
UNION ALL
SELECT l_orderkey * 10 + l_linenumber, 'P' || CAST(l_partkey AS VARCHAR), l_quantity / 2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND l_linenumber % 2 = 0""")
def c5_split_parent_child(spark, sf):
    """Nested records -> child rows with the parent id; id-less records dropped.

    One nested record per line item (its own one or two instructors), so no
    list is gathered across rows.
    """
    li = read_table(spark, sf, "lineitem")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    first = F.struct(F.col("l_suppkey").cast("string").alias("instructor_id"), F.col("l_quantity"))
    second = F.struct(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("instructor_id"),
                      (F.col("l_quantity") / 2).alias("l_quantity"))
    rec = j.select(
        F.struct(F.when(F.col("o_orderstatus") != "P", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
                 .alias("course_id"), "o_orderstatus", "o_totalprice").alias("course_data"),
        F.when(F.col("l_linenumber") % 2 == 0, F.array(first, second)).otherwise(F.array(first))
         .alias("instructors"))
    _, children = cleaning.split_parent_child(rec)
    return children


@register("c6_flatten", """
SELECT p_partkey AS "course_data.course_id", p_name AS "course_data.title",
       p_brand AS "course_data.meta.brand", CAST(p_size AS BIGINT) AS "course_data.meta.size" FROM part""")
def c6_flatten(spark, sf):
    """Nested record -> dotted leaf columns."""
    part = read_table(spark, sf, "part")
    nested = part.select(F.struct(F.col("p_partkey").alias("course_id"), F.col("p_name").alias("title"),
                                  F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
                                  .alias("meta")).alias("course_data"))
    return cleaning.flatten(nested)


@register("c7_fill_defaults", O.with_(O.FX_OFFERS) + """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, course_id,
       CAST(COALESCE(original_price, 0) AS DOUBLE) AS original_price,
       CAST(COALESCE(discount_price, 0) AS DOUBLE) AS discount_price FROM fx_offers""")
def c7_fill_defaults(spark, sf):
    """NULL prices -> 0."""
    o = fixtures.fx_offers(spark, sf).select("l_orderkey", "l_linenumber", "course_id",
                                             "original_price", "discount_price")
    return cleaning.fill_defaults(o, ["original_price", "discount_price"])


# =============================================================================== E: page extraction

from coursewise.operators import pages as P  # noqa: E402

E1_SQL = r"""
WITH src AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base,
         CASE WHEN regexp_matches(html, '<(h1|h2|div|span)\b[^>]*>\s*All [^<]*courses\s*<')
              THEN substr(html, strpos(html, regexp_extract(html, '<(h1|h2|div|span)\b[^>]*>\s*All [^<]*courses\s*<', 0)))
              ELSE html END AS section
  FROM pages),
hrefs AS (SELECT page_id, base, unnest(regexp_extract_all(section, '<a\s[^>]*?href="([^"]*)"', 1)) AS href FROM src),
norm AS (
  SELECT page_id, base,
         regexp_replace(split_part(CASE WHEN starts_with(href, '/') THEN base || href ELSE href END, '?', 1),
                        '/+$', '') || '/' AS link
  FROM hrefs WHERE contains(href, '/')),
links AS (SELECT DISTINCT page_id, link FROM norm WHERE starts_with(link, base || '/'))
"""


def _links(spark, sf):
    return P.extract_links(read_table(spark, sf, "pages"), path_filter="/")


@register("e1_extract_links", E1_SQL + "SELECT page_id, link FROM links")
def e1_extract_links(spark, sf):
    """Links of every page (path filter '/'), distinct per page."""
    return _links(spark, sf)


@register("e2_normalize_url", r"""
SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site,
       regexp_replace(split_part(url, '?', 1), '/+$', '') || '/' AS normalized
FROM pages""")
def e2_normalize_url(spark, sf):
    """Page URLs without query string, one trailing slash."""
    pg = read_table(spark, sf, "pages")
    site = P.site_of(F.col("url"))
    return pg.select("page_id", "url", site.alias("site"), P.normalize_url(F.col("url"), site).alias("normalized"))


@register("e3_dedupe_links", E1_SQL + "SELECT DISTINCT link FROM links")
def e3_dedupe_links(spark, sf):
    """The link set over all pages."""
    return P.dedupe_links(_links(spark, sf))


@register("e4_clean_price", O.with_(O.FX_OFFERS) + """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(discount_price AS DOUBLE) AS price
FROM fx_offers""")
def e4_clean_price(spark, sf):
    """Price text (currency sign, thousands commas, 'Free') -> number."""
    o = fixtures.fx_offers(spark, sf)
    d = F.col("discount_price")
    text = (F.when(d == 0, F.lit("Free"))
             .when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("₫"), F.format_number(d, 2)))
             .otherwise(F.concat(F.lit("$ "), F.format_number(d, 2), F.lit(" "))))
    return o.select("l_orderkey", "l_linenumber", P.clean_price(text).alias("price"))


FX_PAGES = """
fx_pages AS (
SELECT l_orderkey * 10 + l_linenumber AS page_id, CAST(l_partkey + 100000 AS VARCHAR) AS course_id,
       trim(p_name) AS title, l_linenumber AS ln, l_suppkey, p_type, l_quantity, l_orderkey, p_size,
       CAST(CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_extendedprice * 20 AS DECIMAL(18,2)) END AS DOUBLE) AS L,
       CAST(CASE WHEN l_linenumber = 7 THEN NULL WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice * 20 * (1 - l_discount) AS DECIMAL(18,2)) END AS DOUBLE) AS P
FROM lineitem JOIN part ON l_partkey = p_partkey),
fx_cands AS (
SELECT *, list_distinct(list_filter(CASE ln
    WHEN 1 THEN [P]
    WHEN 2 THEN list_filter([L, P], lambda x: x > 0)
    WHEN 3 THEN list_filter([P], lambda x: x > 0)
    WHEN 4 THEN list_filter([L], lambda x: x > 0)
    WHEN 5 THEN [P, L]
    WHEN 6 THEN list_filter([L, P], lambda x: x > 0)
    ELSE CAST([] AS DOUBLE[]) END, lambda x: x IS NOT NULL)) AS c
FROM fx_pages),
fx_prices AS (SELECT *, list_max(c) AS original_price, list_min(c) AS discount_price FROM fx_cands)"""


def _course_pages(spark, sf):
    return fixtures.fx_course_pages(spark, sf)


@register("e5_price_candidates", O.with_(FX_PAGES) + """
SELECT page_id, CAST(len(c) AS BIGINT) AS n_candidates, list_max(c) AS max_candidate, list_min(c) AS min_candidate
FROM fx_cands""")
def e5_price_candidates(spark, sf):
    """E5: price candidates from meta tag, JSON-LD, payload JSON and visible text."""
    parts = P.with_page_parts(_course_pages(spark, sf))
    cands = F.array_distinct(P.price_candidates_of_parts())
    return parts.select("page_id", F.size(cands).cast("bigint").alias("n_candidates"),
                                           F.array_max(cands).alias("max_candidate"),
                                           F.array_min(cands).alias("min_candidate"))


@register("e6_list_sale_price", O.with_(FX_PAGES) + "SELECT page_id, original_price, discount_price FROM fx_prices")
def e6_list_sale_price(spark, sf):
    """(list, sale) = (max, min) of distinct candidates; one value -> both."""
    parts = P.with_page_parts(_course_pages(spark, sf))
    lp, sp = P.list_and_sale_price(P.price_candidates_of_parts())
    return parts.select("page_id", lp.alias("original_price"), sp.alias("discount_price"))


@register("e7_page_payload", O.with_(FX_PAGES) + """
SELECT page_id,
       (ln = 2 OR ln = 5 OR (ln = 3 AND P IS NOT NULL) OR (ln = 4 AND L IS NOT NULL)) AS has_payload,
       CASE WHEN ln = 2 OR ln = 5 OR (ln = 3 AND P IS NOT NULL) OR (ln = 4 AND L IS NOT NULL)
            THEN title END AS payload_title
FROM fx_pages""")
def e7_page_payload(spark, sf):
    """The course payload of each page (body JSON, next-data script or JSON-LD item),
    reported as found / not found and the title it carries."""
    payload = P.payload_of_parts()
    return P.with_page_parts(_course_pages(spark, sf)).select(
        "page_id", payload.isNotNull().alias("has_payload"),
        F.get_json_object(payload, "$.title").alias("payload_title"))


@register("e8_id_title", r"""
SELECT page_id, NULLIF(regexp_extract(html, 'courseId[^\d]*(\d{5,8})', 1), '') AS course_id,
       CASE WHEN regexp_matches(html, '<title.*?>(.*?)</title>')
            THEN trim(replace(replace(regexp_extract(html, '<title.*?>(.*?)</title>', 1), ' | Courses', ''),
                              '&trade;', '™')) END AS title
FROM pages""")
def e8_id_title(spark, sf):
    """Course id and title of the driver's web pages."""
    pg = read_table(spark, sf, "pages")
    return P.with_page_parts(pg).select("page_id", P.parts_course_id().alias("course_id"), P.parts_title().alias("title"))


@register("e9_instructors", O.with_(FX_PAGES) + """
SELECT page_id, CAST(l_suppkey AS VARCHAR) AS instructor_id, 'Instructor ' || CAST(l_suppkey AS VARCHAR) AS name,
       p_type AS job_title, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS num_students FROM fx_pages WHERE ln = 5""")
def e9_instructors(spark, sf):
    """Instructor rows from the page payload."""
    pg = _course_pages(spark, sf)
    parts = P.with_page_parts(pg)
    ins = parts.select("page_id", F.explode(P.instructors_of(P.payload_of_parts())).alias("i"))
    return ins.select("page_id", "i.instructor_id", "i.name", "i.job_title", "i.num_students")


@register("e10_counts", O.with_(FX_PAGES) + """
SELECT page_id, CAST(l_quantity * 1000 AS BIGINT) + ln AS num_students,
       CAST(CAST(l_quantity / 10 AS DECIMAL(4,1)) AS DOUBLE) AS avg_rating_score,
       CAST(l_orderkey % 100000 AS BIGINT) AS num_reviews FROM fx_pages""")
def e10_counts(spark, sf):
    """Students, rating and reviews from page text."""
    pg = P.with_page_parts(_course_pages(spark, sf))
    return pg.select("page_id", *[v.alias(k) for k, v in P.counts_of_parts().items()])


@register("e11_iso_duration", """
SELECT p_partkey, text, CAST(p_size * 3600 + (p_partkey % 60) * 60 + CASE WHEN p_partkey % 7 = 0 THEN 0
       ELSE p_partkey % 50 END AS BIGINT) AS seconds
FROM (SELECT *, 'PT' || CAST(p_size AS VARCHAR) || 'H' || CAST(p_partkey % 60 AS VARCHAR) || 'M'
               || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_partkey % 50 AS VARCHAR) || 'S' END AS text
      FROM part)""")
def e11_iso_duration(spark, sf):
    """ISO-8601 durations -> seconds."""
    part = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    text = F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("H"), (k % 60).cast("string"), F.lit("M"),
                    F.when(k % 7 == 0, F.lit("")).otherwise(F.concat((k % 50).cast("string"), F.lit("S"))))
    return part.select("p_partkey", text.alias("text"), P.iso_duration_seconds(text).alias("seconds"))


@register("e12_course_records", O.with_(FX_PAGES) + """
SELECT page_id, course_id, title, original_price, discount_price,
       CAST(CAST(l_quantity * 1000 AS BIGINT) + ln AS DOUBLE) AS num_students,
       CAST(CAST(l_orderkey % 100000 AS BIGINT) AS DOUBLE) AS num_reviews,
       CAST(CAST(l_quantity / 10 AS DECIMAL(4,1)) AS DOUBLE) AS avg_rating_score,
       CAST(CASE WHEN ln = 5 THEN 1 ELSE 0 END AS BIGINT) AS n_instructors
FROM fx_prices
WHERE ln = 2 OR ln = 5 OR (ln = 3 AND P IS NOT NULL) OR (ln = 4 AND L IS NOT NULL)""")
def e12_course_records(spark, sf):
    """Full nested course records (flattened here for comparison)."""
    rec = P.course_records(_course_pages(spark, sf))
    return rec.select("page_id", "course_data.course_id", "course_data.title", "course_data.original_price",
                      "course_data.discount_price", "course_data.num_students", "course_data.num_reviews",
                      "course_data.avg_rating_score", F.size("instructors").cast("bigint").alias("n_instructors"))


@register("e13_price_records", O.with_(FX_PAGES) + """
SELECT page_id, course_id, title, original_price, discount_price FROM fx_prices""")
def e13_price_records(spark, sf):
    """Price-only records (id, title, list, sale)."""
    return P.price_records(_course_pages(spark, sf))


@register("e1_listing_links", f"""
SELECT s_suppkey AS page_id, '{fixtures.PAGE_SITE}/course/' || x || '-' || CAST(s_suppkey AS VARCHAR) || '/' AS link
FROM supplier, (VALUES ('first'), ('second'), ('third')) t(x) WHERE x <> 'first' OR s_suppkey % 5 IN (1, 2)""")
def e1_listing_links(spark, sf):
    """Course links of listing pages with and without the marker, quotes and capitals of every kind."""
    return P.extract_links(fixtures.fx_listing_pages(spark, sf))


FORMS_SQL = """
WITH f AS (SELECT p_partkey AS page_id, p_partkey % 9 AS kind, CAST(p_partkey AS VARCHAR) AS k, CAST(p_size AS BIGINT) AS size,
                  CAST(p_partkey + 200000 AS VARCHAR) AS own_id FROM part)
"""


@register("e12_page_forms", FORMS_SQL + """
SELECT page_id, own_id AS course_id,
       CASE kind WHEN 0 THEN 'Name ' WHEN 1 THEN 'Next ' WHEN 2 THEN 'Mod ' WHEN 4 THEN 'Por ' WHEN 6 THEN 'T6 ' WHEN 7 THEN 'Big ' ELSE 'Café ''' END || k || CASE kind WHEN 8 THEN ''' &amp; ♥' ELSE '' END AS title,
       CASE WHEN kind = 0 THEN 'About ' || k END AS headline, CASE WHEN kind = 0 THEN 'en' END AS language,
       CASE WHEN kind = 0 THEN 'Beginner' END AS level, CASE WHEN kind = 0 THEN '2024-01-02' END AS publishes_date,
       CAST(CASE kind WHEN 0 THEN size * 3600 + 1800 WHEN 1 THEN size END AS DOUBLE) AS course_duration_seconds,
       CAST(CASE kind WHEN 0 THEN page_id + 0.5 WHEN 6 THEN 20 WHEN 8 THEN 1500 END AS DOUBLE) AS original_price,
       CAST(CASE kind WHEN 0 THEN page_id + 0.5 WHEN 6 THEN 10 WHEN 8 THEN 99.5 END AS DOUBLE) AS discount_price,
       CAST(CASE kind WHEN 1 THEN size WHEN 2 THEN size WHEN 4 THEN size * 1000 WHEN 8 THEN CAST('1' || size AS BIGINT) END AS DOUBLE) AS num_students,
       CAST(CASE kind WHEN 0 THEN size WHEN 1 THEN size WHEN 2 THEN page_id WHEN 4 THEN page_id END AS DOUBLE) AS num_reviews,
       CAST(CASE kind WHEN 0 THEN 4.5 WHEN 1 THEN 3.5 WHEN 2 THEN 2.5 WHEN 4 THEN 4.7 WHEN 8 THEN CAST('4.' || k AS DOUBLE) END AS DOUBLE) AS avg_rating_score,
       CASE WHEN kind = 1 THEN '[{"rating":1,"count":' || CAST(size AS VARCHAR) || '}]' END AS rating_distribution,
       CAST(CASE kind WHEN 0 THEN 2 WHEN 6 THEN 1 WHEN 7 THEN 1 ELSE 0 END AS BIGINT) AS n_instructors,
       CASE kind WHEN 0 THEN 'Ann ' || k WHEN 6 THEN 'School ' || k WHEN 7 THEN 'Au ' || k END AS first_instructor
FROM f WHERE kind NOT IN (3, 5)""")
def e12_page_forms(spark, sf):
    """Records of pages in every form, those without a payload left out."""
    rec = P.course_records(fixtures.fx_page_forms(spark, sf))
    names = ["course_id", "title", "headline", "language", "level", "publishes_date", "course_duration_seconds", "original_price",
             "discount_price", "num_students", "num_reviews", "avg_rating_score", "rating_distribution"]
    return rec.select("page_id", *[f"course_data.{c}" for c in names], F.size("instructors").cast("bigint").alias("n_instructors"),
                      F.get(F.col("instructors"), F.lit(0))["name"].alias("first_instructor"))


@register("e13_page_forms", FORMS_SQL + """
SELECT page_id, CASE kind WHEN 1 THEN '7' ELSE own_id END AS course_id,
       CASE kind WHEN 0 THEN 'T0 ' || k WHEN 1 THEN 'T1 ' || k WHEN 2 THEN 'Root ' || k WHEN 3 THEN 'Attr ' || k WHEN 6 THEN 'T6 ' || k WHEN 8 THEN 'T8 ' || k END AS title,
       CAST(CASE kind WHEN 0 THEN page_id + 0.5 WHEN 3 THEN 1000 WHEN 6 THEN 20 WHEN 8 THEN 1500 END AS DOUBLE) AS original_price,
       CAST(CASE kind WHEN 0 THEN page_id + 0.5 WHEN 3 THEN 20 WHEN 6 THEN 10 WHEN 8 THEN 99.5 END AS DOUBLE) AS discount_price
FROM f WHERE kind <> 5""")
def e13_page_forms(spark, sf):
    """Price records of pages in every form, id attribute first."""
    return P.price_records(fixtures.fx_page_forms(spark, sf))


@register("e14_rating_json", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE l_linenumber % 3 WHEN 0 THEN NULL
            WHEN 1 THEN to_json([{'rating': 1, 'count': l_linenumber}])
            ELSE to_json([{'rating': 1, 'count': l_linenumber}, {'rating': 2, 'count': CAST(l_quantity AS INTEGER)}])
       END AS rating_distribution
FROM lineitem""")
def e14_rating_json(spark, sf):
    """Rating-distribution list -> JSON text when non-empty."""
    li = read_table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    one = F.struct(F.lit(1).alias("rating"), ln.alias("count"))
    two = F.struct(F.lit(2).alias("rating"), F.col("l_quantity").cast("int").alias("count"))
    arr = (F.when(ln % 3 == 0, F.array().cast("array<struct<rating:int,count:int>>"))
            .when(ln % 3 == 1, F.array(one)).otherwise(F.array(one, two)))
    return li.select("l_orderkey", "l_linenumber", P.rating_dist_from_array(arr).alias("rating_distribution"))


LOOKUP_SQL = """
lookup AS (
SELECT CAST(p_partkey + 100000 AS VARCHAR) AS course_id,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_retailprice * 20 END AS list_amount,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_retailprice * 10 END AS discount_amount,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_retailprice * 15 END AS current_amount
FROM part)"""


def _price_lookup(spark, sf):
    part = read_table(spark, sf, "part")
    s, r = F.col("p_size"), F.col("p_retailprice")
    return part.select((F.col("p_partkey") + fixtures.PAGE_ID_BASE).cast("string").alias("course_id"),
                       F.when(s % 4 == 0, F.lit(None)).otherwise(r * 20).alias("list_amount"),
                       F.when(s % 3 == 0, F.lit(None)).otherwise(r * 10).alias("discount_amount"),
                       F.when(s % 5 == 0, F.lit(None)).otherwise(r * 15).alias("current_amount"))


@register("e15_merge_price", O.with_(FX_PAGES, LOOKUP_SQL) + """
SELECT page_id, f.course_id, title,
       CASE WHEN need THEN COALESCE(list_amount, current_amount, original_price) ELSE original_price END AS original_price,
       CASE WHEN need THEN COALESCE(discount_amount, current_amount, discount_price) ELSE discount_price END
           AS discount_price
FROM (SELECT *, (original_price IS NULL OR discount_price IS NULL OR original_price = discount_price) AS need
      FROM fx_prices) f LEFT JOIN lookup l ON f.course_id = l.course_id""")
def e15_merge_price(spark, sf):
    """Prices completed from a second source when missing or equal."""
    return P.merge_price_lookup(P.price_records(_course_pages(spark, sf)), _price_lookup(spark, sf))


@register("e16_merge_instructors", """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y%m%d')) AS course_id,
       CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'L' || CAST(l_partkey AS VARCHAR)
            ELSE CAST(l_suppkey AS VARCHAR) END AS instructor_id
FROM lineitem""")
def e16_merge_instructors(spark, sf):
    """Instructor lists replaced by a non-empty lookup list (empty lookups keep the record's)."""
    li = read_table(spark, sf, "lineitem")
    # (order, line, part, ship day) is unique in the driver's line items
    cid = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey",
                      F.date_format("l_shipdate", "yyyyMMdd")).alias("course_id")
    recs = li.select(cid, F.array(F.struct(F.col("l_suppkey").cast("string").alias("instructor_id")))
                     .alias("instructors"))
    arr_t = "array<struct<instructor_id:string>>"
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 3
    lookup = li.select(cid, F.when(k == 0, F.array(F.struct(
        F.concat(F.lit("L"), F.col("l_partkey").cast("string")).alias("instructor_id"))))
        .when(k == 1, F.array().cast(arr_t)).alias("instructors"))
    merged = P.merge_instructor_lookup(recs, lookup)
    return merged.select("course_id", F.explode("instructors").alias("i")).select("course_id", "i.instructor_id")


_CATS = [c for cats in P.CATEGORY_GROUPS.values() for c in cats]


def _sql_str(s):
    return "'" + s.replace("'", "''") + "'"


@register("e17_category_group", f"""
SELECT p_partkey, category, CASE {' '.join(f"WHEN category = {_sql_str(c)} THEN '{g}'"
                                           for g, cs in P.CATEGORY_GROUPS.items() for c in cs)} END AS category_group
FROM (SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN 'Other' ELSE
      list_extract([{', '.join(_sql_str(c) for c in _CATS)}], CAST(p_partkey % 10 + 1 AS INTEGER)) END AS category
      FROM part)""")
def e17_category_group(spark, sf):
    """Crawl category -> crawl group (literal lookup; unknown -> NULL)."""
    part = read_table(spark, sf, "part")
    names = F.array(*[F.lit(c) for c in _CATS])
    cat = F.when(F.col("p_size") % 11 == 0, F.lit("Other")).otherwise(
        F.element_at(names, (F.col("p_partkey") % 10 + 1).cast("int")))
    return part.select("p_partkey", cat.alias("category"), P.category_group(cat).alias("category_group"))


# =============================================================================== V: data quality, H: trends

from coursewise.operators import quality, trends  # noqa: E402


@register("v1_unique", O.with_(O.FX_OFFERS) + """
SELECT course_id, scraped_at, count(*) AS n_rows FROM fx_offers GROUP BY course_id, scraped_at HAVING count(*) > 1""")
def v1_unique(spark, sf):
    """V1: duplicate (course, scrape time) pairs in the raw offers."""
    return quality.check_unique(fixtures.fx_offers(spark, sf), ["course_id", "scraped_at"])


V2_COLS = ["level", "num_students", "discount_price", "rating_distribution"]


@register("v2_not_null", O.with_(O.FX_COURSES) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM fx_courses"
    for c in V2_COLS))
def v2_not_null(spark, sf):
    """V2: NULL counts of course columns."""
    return quality.check_not_null(fixtures.fx_courses(spark, sf), V2_COLS)


@register("v3_relationship", """
SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
GROUP BY o_custkey""")
def v3_relationship(spark, sf):
    """V3: orders whose customer is missing."""
    return quality.check_relationship(read_table(spark, sf, "orders"),
                                      read_table(spark, sf, "customer"), "o_custkey", "c_custkey")


@register("v3_orphans", """
SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12) GROUP BY o_custkey""")
def v3_orphans(spark, sf):
    """V3: orders whose customer is not among those of the first nations."""
    few = read_table(spark, sf, "customer").filter("c_nationkey < 12")
    return quality.check_relationship(read_table(spark, sf, "orders"), few, "o_custkey", "c_custkey")


@register("v5_out_of_range", """
SELECT 'rating' AS column_name, count(*) FILTER (WHERE l_linenumber <= 2) AS rejects FROM lineitem
UNION ALL SELECT 'students', count(*) FILTER (WHERE l_linenumber <= 2) FROM lineitem
UNION ALL SELECT 'duration', count(*) FILTER (WHERE l_linenumber = 1) FROM lineitem""")
def v5_out_of_range(spark, sf):
    """V5 over D5, D6 and E11: values beyond their types are NULL (or the default) and counted, never an error."""
    ln, q = F.col("l_linenumber"), F.col("l_quantity")
    raw = read_table(spark, sf, "lineitem").select(
        F.when(ln == 1, F.lit(1000.0)).when(ln == 2, F.lit(1e9)).otherwise(q / 10).alias("rating"),
        F.when(ln == 1, F.lit("Infinity")).when(ln == 2, F.lit("1e20")).otherwise(q.cast("string")).alias("students"),
        F.when(ln == 1, F.lit("PT" + "9" * 30 + "H")).otherwise(F.lit("PT5M")).alias("duration"))
    count = staging.count_default(F.col("students"))
    return quality.cast_rejects(raw, {"rating": ("rating", staging.rating_round(F.col("rating"))),
                                      "students": ("students", F.when(count > 0, count)),
                                      "duration": ("duration", P.iso_duration_seconds(F.col("duration")))})


@register("v4_accepted_values", """
SELECT o_orderstatus, count(*) AS n_rows FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus""")
def v4_accepted_values(spark, sf):
    """V4: order states outside the accepted set."""
    return quality.check_accepted_values(read_table(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


@register("v5_cast_rejects", O.with_(O.FX_COURSES) + """
SELECT 'published_date' AS column_name,
       count(*) FILTER (WHERE NULLIF(trim(publishes_date), '') IS NOT NULL
                        AND try_strptime(trim(publishes_date), '%d/%m/%Y') IS NULL) AS rejects FROM fx_courses
UNION ALL
SELECT 'rating_1', count(*) FILTER (WHERE NULLIF(trim(rating_distribution), '') IS NOT NULL
                        AND TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[0].count') AS INTEGER)
                            IS NULL) FROM fx_courses""")
def v5_cast_rejects(spark, sf):
    """V5: raw values that fail their cast (text 'None' JSON counts as a reject)."""
    from coursewise.functions.dates import parse_date
    c = fixtures.fx_courses(spark, sf)
    return quality.cast_rejects(c, {
        "published_date": ("publishes_date", parse_date(F.col("publishes_date"))),
        "rating_1": ("rating_distribution", staging.rating_counts(F.col("rating_distribution"))["rating_1"]),
    })


@register("h1_student_growth", O.with_(*O.COURSE_BASE) + """
SELECT course_id, scraped_at, num_students, prev_students, num_students - prev_students AS growth
FROM (SELECT course_id, scraped_at, num_students,
             lag(num_students) OVER (PARTITION BY course_id ORDER BY scraped_at) AS prev_students FROM stg_courses)""")
def h1_student_growth(spark, sf):
    """H1: student growth between consecutive snapshots."""
    return trends.student_growth(W(spark, sf).stg_courses)


@register("h2_price_by_month", O.with_(*O.COURSE_BASE, BOUNDS_SQL, *O.PRICE_BASE[:1], O.STG_PRICE,
                                        O.PRICE_HISTORY) + """
SELECT strftime(d.date_day, '%Y-%m') AS year_month, count(*) AS n_prices,
       CAST(sum(sale_price) AS DOUBLE) / count(sale_price) AS avg_sale_price,
       CAST(min(sale_price) AS DOUBLE) AS min_sale_price, CAST(max(sale_price) AS DOUBLE) AS max_sale_price,
       count(*) FILTER (WHERE is_lowest_price_ever) AS n_all_time_lows
FROM fct_price_history f JOIN spine d ON CAST(f.recorded_at AS DATE) = d.date_day
GROUP BY 1""")
def h2_price_by_month(spark, sf):
    """H2: price statistics per calendar month."""
    w = W(spark, sf)
    return trends.price_by_month(w.fct_price_history, w.dim_date)


# =============================================================================== streaming

from coursewise.streaming import alerts as stream_alerts  # noqa: E402
from coursewise.streaming import incremental  # noqa: E402

OFFER_COLS = ["course_id", "title", "original_price", "discount_price", "_url", "_category", "scraped_at",
              "l_orderkey", "l_linenumber"]


def _land_offers(spark, sf, landing: str, second: bool) -> None:
    """Land the offers as two tracker batches (years up to 1996, then the rest)."""
    o = fixtures.fx_offers(spark, sf)
    early = F.coalesce(F.year("scraped_at") <= 1996, F.lit(False))
    part = o.filter(~early) if second else o.filter(early)
    tag = "B" if second else "A"
    files.write_parquet(part, f"{landing}/PROD_tracker_group1_p1-1_{tag}_courses.parquet", "gzip")


def _write_text(spark, path: str, text: str) -> None:
    """A file that is not what its name says."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


@register("s10_incremental_load", O.with_(O.FX_OFFERS) + """
SELECT course_id, title, CAST(original_price AS DOUBLE) AS original_price,
       CAST(discount_price AS DOUBLE) AS discount_price, _url, _category, scraped_at, l_orderkey,
       CAST(l_linenumber AS BIGINT) AS l_linenumber FROM fx_offers""".replace("scraped_at, l_orderkey,", "scraped_at, l_orderkey, CASE WHEN year(scraped_at) > 1996 THEN 'late' END AS batch_note,"))
def s10_incremental_load(spark, sf):
    """Two landing runs over a tree of folders; a damaged file loads once it is repaired, an empty file
    and names in capitals load too, a file with other column names and one more column keeps its columns,
    and each file is loaded exactly once."""
    root = work_dir(spark, "s10")
    landing, raw = f"{root}/landing", f"{root}/raw"
    offers, inst = fixtures.fx_offers(spark, sf), fixtures.fx_instructors(spark, sf)
    year = F.coalesce(F.year("scraped_at"), F.lit(0))
    damaged = f"{landing}/tracker/2024/PROD_tracker_group1_p3-3_C_courses.parquet"
    files.write_parquet(inst, f"{landing}/dashboard/TEST_dashboard_group1_p1-1_A_instructors.parquet")
    files.write_parquet(offers.filter(year <= 1994), f"{landing}/tracker/PROD_tracker_group1_p1-1_A_courses.parquet", "gzip")
    files.write_parquet(offers.filter(F.lit(False)), f"{landing}/tracker/PROD_tracker_group1_p4-4_D_courses.parquet")
    _write_text(spark, f"{damaged}/part-0.parquet", "not a parquet file")
    schemas = {"price_tracker": offers.schema, "instructors": inst.schema}
    incremental.incremental_load(spark, landing, schemas, raw)
    files.write_parquet(offers.filter((year > 1994) & (year <= 1996)), damaged)
    late = offers.filter(year > 1996).withColumnsRenamed({"course_id": "Course ID", "title": " Title"}).withColumn("Batch Note", F.lit("late"))
    files.write_parquet(late, f"{landing}/tracker/PROD_TRACKER_GROUP1_P2-2_B_COURSES.PARQUET", "gzip")
    incremental.incremental_load(spark, landing, schemas, raw)
    return incremental.read_raw_table(spark, raw, "price_tracker").select(*OFFER_COLS, "batch_note")


G35_SQL = O.with_(O.FX_OFFERS) + f"""
, obs AS (
SELECT * FROM (
  SELECT course_id, trim(title) AS title, COALESCE(original_price, 0) AS list_price,
         COALESCE(discount_price, original_price, 0) AS sale_price, scraped_at,
         row_number() OVER (PARTITION BY course_id, scraped_at ORDER BY l_orderkey, l_linenumber) AS rn
  FROM fx_offers) WHERE rn = 1 AND title IS NOT NULL),
hist AS (
SELECT 0 AS batch_id, * FROM obs WHERE year(scraped_at) <= 1996
UNION ALL SELECT 1 AS batch_id, * FROM obs),
touched AS (
SELECT DISTINCT CASE WHEN year(scraped_at) <= 1996 THEN 0 ELSE 1 END AS batch_id, course_id FROM obs),
latest AS (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, course_id
                                             ORDER BY scraped_at DESC NULLS LAST, sale_price) AS rl FROM hist)
WHERE rl = 1),
pos AS (
SELECT batch_id, course_id, sale_price, row_number() OVER (PARTITION BY batch_id, course_id
       ORDER BY scraped_at DESC NULLS LAST, sale_price) AS rp FROM hist WHERE sale_price > 0),
mins AS (
SELECT batch_id, course_id, min(sale_price) AS min_pos FROM hist WHERE sale_price > 0 GROUP BY batch_id, course_id),
cp AS (
SELECT l.batch_id, l.course_id, l.title, l.sale_price AS current_price, l.list_price,
       COALESCE(l.sale_price > 0 AND l.sale_price <= m.min_pos, false) AS is_lowest_price_ever,
       p.sale_price AS previous_price
FROM latest l
JOIN touched t ON l.batch_id = t.batch_id AND l.course_id = t.course_id
LEFT JOIN pos p ON p.batch_id = l.batch_id AND p.course_id = l.course_id AND p.rp = 2
LEFT JOIN mins m ON m.batch_id = l.batch_id AND m.course_id = l.course_id)
SELECT CAST(batch_id AS BIGINT) AS batch_id, course_id, title, CAST(current_price AS DOUBLE) AS current_price,
       CAST({REF} AS DOUBLE) AS reference_price,
       CASE WHEN {REF} > 0 THEN {pct_change_sql(REF, 'current_price')}
            WHEN list_price > 0 THEN {pct_change_sql('list_price', 'current_price')} ELSE 0 END AS drop_pct,
       COALESCE(NULLIF(concat_ws(', ',
           CASE WHEN {REF} <> 0 AND current_price < {REF} THEN '{serving.REASON_DROPPED}' END,
           CASE WHEN is_lowest_price_ever THEN '{serving.REASON_LOWEST}' END), ''),
           '{serving.REASON_OTHER}') AS reasons,
       true AS alert_eligible,
       COALESCE({DROPPED_SQL}, false) AS price_dropped,
       (is_lowest_price_ever AND current_price > 0) AS all_time_low,
       CAST(CASE WHEN {DROPPED_SQL} THEN previous_price - current_price END AS DOUBLE) AS drop_amount
FROM cp
WHERE COALESCE({DROPPED_SQL} OR (is_lowest_price_ever AND current_price > 0), false)"""


@register("g35_alert_feed", G35_SQL)
def g35_alert_feed(spark, sf):
    """Alert rows of two landed price batches (years up to 1996, then the rest), from the
    stream's per-course state."""
    root = work_dir(spark, "g35")
    landing = f"{root}/landing"
    schema = fixtures.fx_offers(spark, sf).schema
    for second in (False, True):
        _land_offers(spark, sf, landing, second)
        if not second:  # a damaged file beside the others
            _write_text(spark, f"{landing}/deep/PROD_TRACKER_group1_p9-9_X_COURSES.parquet", "not a parquet file")
        # each run has a checkpoint of its own: what was applied is known without it
        stream_alerts.run_alert_feed(spark, landing, schema, f"{root}/raw", f"{root}/out", f"{root}/checkpoint-{second}",
                                     tie_break=["l_orderkey", "l_linenumber"])
    return stream_alerts.read_alerts(spark, f"{root}/out")


@register("t4_top_k", O.with_(*O.GOLD_BASE) + """
SELECT course_id, title, num_students, CAST(est_revenue AS DOUBLE) AS est_revenue FROM per_course
ORDER BY num_students DESC, course_id LIMIT 10""")
def t4_top_k(spark, sf):
    """T4: top-10 courses by enrolments (the limit is the report)."""
    pc = W(spark, sf).per_course.select("course_id", "title", "num_students", "est_revenue")
    return serving.top_k(pc, 10, [F.col("num_students").desc(), F.col("course_id")])
