"""Dashboard queries (G1-G34) computed for all courses at once.

The reference answers each page in one Python process on at most 5000 rows;
here every page is a DataFrame over the full silver/gold tables.  Per-course
"loops" become windows or aggregates keyed by course.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursewise.functions import fmt
from coursewise.functions.prices import MONEY, discount_percentage
from coursewise.functions.tiers import (DURATION_TIERS, PRICE_TIERS, duration_tier, price_tier,
                                        rating_tier, tier_rank)
from coursewise.operators.common import best_row, top_n_per_key
from coursewise.operators.skew import lag_in_range, lookup_join

# ============================================================================ courses


LATEST_COLUMNS = ["course_id", "title", "category", "language", "level", "rating", "num_students",
                  "num_reviews", "list_price", "sale_price", "duration_hours", "course_url",
                  "scraped_at", "rating_1", "rating_2", "rating_3", "rating_4", "rating_5"]


def latest_courses(stg_courses: DataFrame) -> DataFrame:
    """G1: latest titled record per course; rows with a student count first."""
    titled = stg_courses.filter(F.col("title").isNotNull())
    n = F.col("num_students").cast("double")
    no_students = F.when(n.isNotNull() & ~F.isnan(n), 0).otherwise(1)
    best = best_row(titled, ["course_id"],
                    [no_students.asc(), F.col("scraped_at").desc_nulls_last(),
                     F.col("title").asc(), F.col("sale_price").asc_nulls_last()])
    return best.select(*LATEST_COLUMNS)


def course_metrics(df: DataFrame) -> DataFrame:
    """C7 + G3-G7: defaults, revenue estimate, review share and tier labels."""
    filled = df.withColumns({
        "num_students": F.coalesce(F.col("num_students").cast("bigint"), F.lit(0).cast("bigint")),
        "num_reviews": F.coalesce(F.col("num_reviews").cast("bigint"), F.lit(0).cast("bigint")),
        "rating": F.coalesce(F.col("rating"), F.lit(0).cast("decimal(4,1)")),
        "sale_price": F.coalesce(F.col("sale_price"), F.lit(0).cast(MONEY)),
        "list_price": F.coalesce(F.col("list_price"), F.lit(0).cast(MONEY)),
        "duration_hours": F.coalesce(F.col("duration_hours"), F.lit(0).cast("decimal(12,1)")),
    })
    return filled.withColumns({
        "est_revenue": est_revenue(F.col("num_students"), F.col("sale_price")),
        "pct_review": pct_review(F.col("num_reviews"), F.col("num_students")),
        "price_tier": price_tier(F.col("sale_price")),
        "duration_tier": duration_tier(F.col("duration_hours")),
        "rating_tier": rating_tier(F.col("rating")),
    })


def est_revenue(students: Column, price: Column) -> Column:
    """Students x sale price (exact decimal)."""
    return students.cast("decimal(20,0)") * price.cast(MONEY)


def pct_review(reviews: Column, students: Column) -> Column:
    """Reviews / students x 100, two decimals, 0 without students."""
    r = F.round(reviews.cast("decimal(20,0)") * 100 / students.cast("decimal(20,0)"), 2)
    return F.when(students > 0, r).otherwise(F.lit(0)).cast("decimal(20,2)")


def course_instructors(courses: DataFrame, stg_instructors: DataFrame) -> DataFrame:
    """Left join USING (course_id); one row per (course, instructor row)."""
    inst = stg_instructors.select("course_id", "instructor_name")
    return courses.join(inst, "course_id", "left")


def course_mart(stg_courses: DataFrame, stg_instructors: DataFrame) -> DataFrame:
    """Latest course rows x instructors with metrics (the dashboard's base table)."""
    return course_metrics(course_instructors(latest_courses(stg_courses), stg_instructors))


def dedupe_course(stg_courses: DataFrame, stg_instructors: DataFrame) -> DataFrame:
    """One row per course with one instructor (first by name, NULL last) (Q14).

    Instead of fanning out and de-duplicating, instructors are reduced to one
    name per course by a partial aggregate and joined 1:1.
    """
    first_name = (stg_instructors.groupBy("course_id")
                                 .agg(F.min("instructor_name").alias("instructor_name")))
    return course_metrics(latest_courses(stg_courses)).join(first_name, "course_id", "left")


def apply_filters(df: DataFrame, category: str | None = None, price_tier: str | None = None,
                  level: str | None = None, rating_tier: str | None = None) -> DataFrame:
    """Conjunctive equality filters; None or "All" switches one off."""
    wanted = {"category": category, "price_tier": price_tier, "level": level,
              "rating_tier": rating_tier}
    preds = [F.col(c) == v for c, v in wanted.items() if v is not None and v != "All"]
    return df.filter(reduce(lambda a, b: a & b, preds)) if preds else df


def facets(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values of a column."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def _avg(c: Column, cond: Column) -> Column:
    """Mean of ``c`` where ``cond`` (exact sum / count), 0 for no rows (Q16)."""
    s = F.sum(F.when(cond, c)).cast("double")
    n = F.count(F.when(cond, c)).cast("double")
    return F.coalesce(F.try_divide(s, n), F.lit(0.0))


def overview_kpis(per_course: DataFrame) -> DataFrame:
    """Courses, enrolments, revenue, average paid price, review share, rating."""
    return per_course.agg(
        F.count_distinct("course_id").alias("total_courses"),
        F.coalesce(F.sum("num_students"), F.lit(0)).cast("bigint").alias("total_enroll"),
        F.coalesce(F.sum("est_revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        _avg(F.col("sale_price"), F.col("sale_price") > 0).alias("avg_price"),
        _avg(F.col("pct_review"), F.col("num_students") > 0).alias("pct_review_avg"),
        _avg(F.col("rating"), F.col("rating") > 0).alias("avg_rating"),
    )


def filtered_kpis(per_course: DataFrame) -> DataFrame:
    """The four KPIs of the ranking page."""
    return per_course.agg(
        F.count_distinct("course_id").alias("total_courses"),
        F.coalesce(F.sum("num_students"), F.lit(0)).cast("bigint").alias("total_enroll"),
        F.coalesce(F.sum("est_revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        _avg(F.col("rating"), F.col("rating") > 0).alias("avg_rating"),
    )


def category_performance(per_course: DataFrame) -> DataFrame:
    """Per category courses, enrolments, instructors and revenue."""
    return (per_course.filter(F.col("category").isNotNull())
            .groupBy("category")
            .agg(F.count_distinct("course_id").alias("total_courses"),
                 F.sum("num_students").cast("bigint").alias("total_enroll"),
                 F.count_distinct("instructor_name").alias("total_instructors"),
                 F.sum("est_revenue").alias("total_revenue"))
            .orderBy(F.col("total_enroll").desc(), F.col("category")))


def _count_by(per_course: DataFrame, col: str) -> DataFrame:
    return (per_course.filter(F.col(col).isNotNull()).groupBy(col)
                      .agg(F.count_distinct("course_id").alias("course_count")))


def courses_by_price_tier(per_course: DataFrame, order: list[str] = PRICE_TIERS) -> DataFrame:
    """Courses per price tier in tier order."""
    return (_count_by(per_course, "price_tier")
            .withColumn("tier_order", tier_rank(F.col("price_tier"), order).cast("bigint"))
            .orderBy("tier_order"))


def courses_by_level(per_course: DataFrame) -> DataFrame:
    """Courses per non-null level."""
    return _count_by(per_course, "level").orderBy("level")


def courses_by_rating(per_course: DataFrame, skip: str = "No Rating") -> DataFrame:
    """Courses per rating tier without the no-rating bucket."""
    return _count_by(per_course.filter(F.col("rating_tier") != skip), "rating_tier").orderBy("rating_tier")


def courses_by_duration(per_course: DataFrame, order: list[str] = DURATION_TIERS,
                        skip: str = "Unknown") -> DataFrame:
    """Courses per duration tier, unknown dropped, tier order."""
    return (_count_by(per_course.filter(F.col("duration_tier") != skip), "duration_tier")
            .withColumn("tier_order", tier_rank(F.col("duration_tier"), order).cast("bigint"))
            .orderBy("tier_order"))


def share_of_total(counts: DataFrame, count_col: str = "course_count",
                   digits: int = 1) -> DataFrame:
    """Percent of the total per row (W6), on an already aggregated, small frame."""
    total = F.sum(count_col).over(Window.partitionBy())
    pct = F.round(F.col(count_col).cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)"), digits)
    return counts.withColumn("share_pct", pct.cast(f"decimal(10,{digits})"))


BEST_COLUMNS = ["course_id", "title", "num_students", "est_revenue", "rating", "pct_review",
                "list_price", "level", "category", "course_url", "instructor_name"]


def best_courses(per_course: DataFrame) -> DataFrame:
    """Ranking by enrolments (T1); a global range-partitioned sort, no row cap."""
    return (per_course.select(*BEST_COLUMNS)
            .orderBy(F.col("num_students").desc(), F.col("course_id")))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """T4: the first ``k`` rows under a total order (planned as TakeOrderedAndProject:
    each task keeps its own top k, the driver merges k rows per task)."""
    return df.orderBy(*order).limit(k)


def display_best_courses(best: DataFrame) -> DataFrame:
    """The ranking's display strings."""
    return best.select(
        "course_id",
        F.col("title").alias("course"),
        F.when(F.col("num_students") > 0, fmt.fmt_k(F.col("num_students"))).otherwise(F.lit("0"))
         .alias("total_subscribers"),
        fmt.fmt_bn(F.col("est_revenue")).alias("total_revenue"),
        F.when(F.col("rating") > 0, fmt.fixed(F.col("rating"), 2)).otherwise(F.lit("-")).alias("rating"),
        F.when(F.col("pct_review") > 0, F.concat(fmt.fixed(F.col("pct_review"), 2), F.lit("%")))
         .otherwise(F.lit("-")).alias("pct_review"),
        F.when(F.col("list_price") > 0, fmt.thousands(F.col("list_price"))).otherwise(F.lit("Free"))
         .alias("list_price"),
    )


def search_title(df: DataFrame, query: str, regex: bool = True, col: str = "title") -> DataFrame:
    """Case-insensitive search; the query is a regex by default (Q17), NULL never matches."""
    if regex:
        return df.filter(F.coalesce(F.col(col).rlike("(?i)" + query), F.lit(False)))
    return df.filter(F.coalesce(F.lower(F.col(col)).contains(query.lower()), F.lit(False)))


# ============================================================================ prices

HISTORY_COLUMNS = ["course_id", "title", "course_url", "list_price", "sale_price", "recorded_at",
                   "discount_percentage", "is_lowest_price_ever", "category"]


def price_history_enriched(fct_price_history: DataFrame, dim_course: DataFrame,
                           dim_category: DataFrame) -> DataFrame:
    """Price history with category name; titled rows.

    The category name is looked up once per course, so history rows meet one
    join, which deals out the rows of courses that have many.
    """
    return _with_category(fct_price_history, category_names(dim_course, dim_category))


def category_names(dim_course: DataFrame, dim_category: DataFrame) -> DataFrame:
    """(course_id, category) through the surrogate key."""
    names = dim_category.select("category_id", F.col("category_name").alias("category"))
    return dim_course.select("course_id", "category_id").join(names, "category_id", "left").select("course_id", "category")


def _with_category(fct_price_history: DataFrame, categories: DataFrame) -> DataFrame:
    return lookup_join(fct_price_history.filter(F.col("title").isNotNull()), categories, "course_id").select(*HISTORY_COLUMNS)


def price_history_with_category(fct_price_history: DataFrame, stg_courses: DataFrame) -> DataFrame:
    """G2 without the surrogate-key round trip: category_id -> category_name is
    the identity on the best course record's category, so joining that
    category directly gives the same rows while skipping the dimension build
    (and its sizing pass).  Used when the gold dimensions are not materialised."""
    from coursewise.operators.marts import best_course_record
    return _with_category(fct_price_history, best_course_record(stg_courses).select("course_id", "category"))


def price_tracker(prices: DataFrame, categories: DataFrame, *more: DataFrame) -> DataFrame:
    """G2 with F14 straight from price rows: ``HISTORY_COLUMNS``, ``n_positive`` and the columns of ``more``.

    ``prices`` are price rows before any join; what a course adds to its rows
    (minimum and number of positive prices, category, and the further tables
    of ``more``, all one row a course) is put together first, so rows meet one
    join on the course, in which courses with many rows are dealt out.
    """
    from coursewise.operators.marts import at_lowest
    titled, positive = F.col("title").isNotNull(), F.col("sale_price") > 0
    lookup = prices.groupBy("course_id").agg(F.min(F.when(positive, F.col("sale_price"))).alias("__low"), F.count_if(titled & positive).alias("n_positive"))
    for table in (categories, *more):
        lookup = lookup.join(table, "course_id", "left")
    rows = lookup_join(prices.filter(titled).select("course_id", "title", "course_url", "list_price", "sale_price", "recorded_at"), lookup, "course_id")
    rows = rows.withColumns({"discount_percentage": discount_percentage(F.col("list_price"), F.col("sale_price")),
                             "is_lowest_price_ever": at_lowest(F.col("sale_price"), F.col("__low"))})
    extra = [c for table in more for c in table.columns if c != "course_id"]
    return rows.select(*HISTORY_COLUMNS, "n_positive", *extra)


def ordered_history(history: DataFrame) -> DataFrame:
    """G2 presentation order (course, time); applied only where the rows are shown."""
    return history.orderBy("course_id", "recorded_at")


def price_type_filter(history: DataFrame, kind: str = "All") -> DataFrame:
    """Free (list <= 0) / Paid (list > 0) / All."""
    if kind == "Free":
        return history.filter(F.col("list_price") <= 0)
    if kind == "Paid":
        return history.filter(F.col("list_price") > 0)
    return history


def tracker_category_filter(history: DataFrame, category: str = "All") -> DataFrame:
    """Category equality, "All" switches it off."""
    return history if category in (None, "All") else history.filter(F.col("category") == category)


def _time_desc() -> list[Column]:
    return [F.col("recorded_at").desc_nulls_last(), F.col("sale_price").asc_nulls_last()]


def dropped_courses(history: DataFrame) -> DataFrame:
    """Courses whose last positive price is below the one before.

    The two newest positive rows per course come from a ``row_number <= 2``
    group limit (partial limit before the shuffle), then one row per course.
    ``history`` needs course_id, sale_price and recorded_at only: give it rows
    that were not joined on course_id, or the limit cannot run ahead of a shuffle.
    """
    top2 = top_n_per_key(history.filter(F.col("sale_price") > 0), ["course_id"], _time_desc(), 2, "rn")
    pair = (top2.groupBy("course_id")
                .agg(F.max(F.when(F.col("rn") == 1, F.col("sale_price"))).alias("last_price"),
                     F.max(F.when(F.col("rn") == 2, F.col("sale_price"))).alias("previous_price")))
    return pair.filter(F.col("last_price") < F.col("previous_price"))


def drop_only(history: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """History rows of the courses found by G25 (J5), ``prices`` being its rows before any join."""
    dropped = dropped_courses(history if prices is None else prices)
    return lookup_join(history, dropped.select("course_id"), "course_id", "inner")


def tracker_drop_only(prices: DataFrame, categories: DataFrame) -> DataFrame:
    """G24 straight from price rows: whether a course dropped is one more column of the one lookup."""
    dropped = dropped_courses(prices.filter(F.col("title").isNotNull())).select("course_id", F.lit(True).alias("dropped"))
    return price_tracker(prices, categories, dropped).filter("dropped").select(*HISTORY_COLUMNS)


def course_selector(history: DataFrame) -> DataFrame:
    """One entry per course (its earliest titled row) labelled ``title  (ID: n)``."""
    first = best_row(history, ["course_id"], [F.col("recorded_at").asc_nulls_last(),
                                               F.col("title").asc_nulls_last()])
    label = F.format_string("%s  (ID: %s)", F.col("title"), F.col("course_id").cast("string"))
    return first.select("course_id", "title", label.alias("label")).orderBy("title", "course_id")


def current_and_previous_price(prices: DataFrame, categories: DataFrame) -> DataFrame:
    """Per course the latest row (any price) and the second-latest positive price (Q20).

    ``prices`` are price rows before any join (course_id, title, course_url,
    list_price, sale_price, recorded_at); ``categories`` (course_id, category)
    is joined once per course.  The latest titled row and the minimum positive
    price of all rows are one partial aggregate, so a course with a third of
    the rows is a few rows a task at the shuffle, and the all-time-low flag of
    the latest row needs no join of rows.
    """
    titled = F.col("title").isNotNull()
    positive = F.col("sale_price") > 0
    # nulls sort first in a struct: the newest time wins, then the lowest price
    newest = F.struct("recorded_at", (-F.col("sale_price")).alias("cheapest"))
    row = F.struct("title", "course_url", "sale_price", "list_price", "recorded_at")
    latest = (prices.groupBy("course_id")
                    .agg(F.max(F.when(titled, F.struct(newest.alias("o"), row.alias("r")))).alias("first"),
                         F.min(F.when(positive, F.col("sale_price"))).alias("low"))
                    .filter(F.col("first").isNotNull())
                    .select("course_id", "first.r.*", "low"))
    top2 = top_n_per_key(prices.filter(titled & positive).select("course_id", "sale_price", "recorded_at"),
                         ["course_id"], _time_desc(), 2, "rn")
    prev = top2.filter(F.col("rn") == 2).select("course_id", F.col("sale_price").alias("previous_price"))
    out = latest.join(prev, "course_id", "left").join(categories, "course_id", "left")
    low = F.coalesce(positive & (F.col("sale_price") <= F.col("low")), F.lit(False))
    return out.select("course_id", "title", "course_url", "category", F.col("sale_price").alias("current_price"), "list_price",
                      discount_percentage(F.col("list_price"), F.col("sale_price")).alias("discount_percentage"),
                      low.alias("is_lowest_price_ever"), F.col("recorded_at").alias("latest_at"), "previous_price")


def _dropped(cp: DataFrame) -> Column:
    return (F.col("previous_price").isNotNull() & (F.col("current_price") > 0)
            & (F.col("current_price") < F.col("previous_price")))


def _pct_change(old: Column, new: Column, digits: int) -> Column:
    """round((old - new) / old x 100, digits) on exact decimals."""
    return F.round((old - new).cast("decimal(20,2)") * 100 / old.cast("decimal(20,2)"), digits)


def display_discount(cp: DataFrame) -> DataFrame:
    """Drop versus the previous price when it fell, else the stored discount."""
    d = F.when(_dropped(cp), _pct_change(F.col("previous_price"), F.col("current_price"), 1)) \
         .otherwise(F.col("discount_percentage").cast("decimal(20,1)"))
    return cp.withColumn("display_discount", d.cast("decimal(20,1)"))


def price_alerts(cp: DataFrame) -> DataFrame:
    """Courses whose price dropped or sits at its all-time low, with the drop amount."""
    flagged = cp.select(
        "course_id", "title", "current_price", "previous_price", "list_price",
        _dropped(cp).alias("price_dropped"),
        (F.col("is_lowest_price_ever") & (F.col("current_price") > 0)).alias("all_time_low"),
        F.when(_dropped(cp), F.col("previous_price") - F.col("current_price")).alias("drop_amount"))
    return flagged.filter(F.col("price_dropped") | F.col("all_time_low"))


def chart_series(history: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Positive-price rows when a course has more than one, else all its rows.

    The per-course count is a partial aggregate that rows look up; ``prices``
    are the history's rows before any join.  A ``price_tracker`` has it already.
    """
    if "n_positive" not in history.columns:
        n_pos = (history if prices is None else prices).groupBy("course_id").agg(F.count_if(F.col("sale_price") > 0).alias("n_positive"))
        history = lookup_join(history, n_pos, "course_id", "inner")
    return history.filter((F.col("n_positive") <= 1) | (F.col("sale_price") > 0)).drop("n_positive")


def lowest_points(history: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """The all-time-low markers of the chart series."""
    return chart_series(history, prices).filter(F.col("is_lowest_price_ever"))


def history_with_drop(prices: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Per row the drop versus the previous row when it fell, else the discount; newest first.

    ``prices`` are price rows before any join; the row before is found in
    balanced ranges of course and time (W4), so that no task holds a whole
    course.  ``of`` are the rows that the all-time low is taken over (``prices``
    if not given).
    """
    from coursewise.operators.marts import lowest_price_flag
    rows = prices.select("course_id", "recorded_at", "list_price", "sale_price")
    h = lowest_price_flag(lag_in_range(rows, ["course_id"], "recorded_at", "sale_price", "prev_price"), of=rows if of is None else of)
    fell = (F.col("prev_price").isNotNull() & (F.col("sale_price") > 0)
            & (F.col("prev_price") > F.col("sale_price")))
    discount = discount_percentage(F.col("list_price"), F.col("sale_price"))
    pct = F.when(fell, _pct_change(F.col("prev_price"), F.col("sale_price"), 1)) \
           .otherwise(F.round(discount.cast("decimal(20,1)"), 1))
    return (h.select("course_id", F.to_date("recorded_at").alias("recorded_date"), "list_price",
                     "sale_price", "prev_price", pct.cast("decimal(20,1)").alias("discount_percentage"),
                     "is_lowest_price_ever")
             .orderBy("course_id", F.col("recorded_date").desc()))


# Alert reason texts of the price-alert mail, in mail order.
REASON_DROPPED = "Dang giam gia"
REASON_LOWEST = "Re nhat lich su"
REASON_OTHER = "Co bien dong gia"


def alert_reasons(cp: DataFrame) -> DataFrame:
    """Reason text and drop percent of an alert; the reference price falls back to list."""
    ref = F.coalesce(F.col("previous_price"), F.col("list_price"))
    cur = F.col("current_price")
    pct = (F.when(ref > 0, _pct_change(ref, cur, 1))
             .when(F.col("list_price") > 0, _pct_change(F.col("list_price"), cur, 1))
             .otherwise(F.lit(0)))
    reasons = F.concat_ws(", ",
                          F.when((ref != 0) & (cur < ref), F.lit(REASON_DROPPED)),
                          F.when(F.col("is_lowest_price_ever"), F.lit(REASON_LOWEST)))
    return cp.select("course_id", "title", "current_price", ref.alias("reference_price"),
                     pct.cast("decimal(20,1)").alias("drop_pct"),
                     F.when(reasons != "", reasons).otherwise(F.lit(REASON_OTHER)).alias("reasons"))


def alert_eligible(cp: DataFrame) -> DataFrame:
    """An alert may go out when the price dropped or is at a positive all-time low."""
    ok = _dropped(cp) | (F.col("is_lowest_price_ever") & (F.col("current_price") > 0))
    return cp.select("course_id", F.coalesce(ok, F.lit(False)).alias("alert_eligible"))
