"""Hand-written edge rows for the semantics that bite."""

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import functions as F

from coursewise.functions import fmt
from coursewise.functions.dates import parse_date, parse_timestamp
from coursewise.functions.keys import hash_key
from coursewise.functions.prices import clean_price
from coursewise.functions.tiers import duration_tier, price_tier, rating_tier
from coursewise.operators import cleaning, marts, pages, quality, serving, staging

COURSE_COLS = ("course_id string, title string, headline string, language string, level string, "
               "course_duration_seconds double, publishes_date string, lasted_updated_date string, "
               "original_price double, discount_price double, num_students double, num_reviews double, "
               "avg_rating_score double, rating_distribution string, _url string, _category string, "
               "_scraped_datetime string")


def course(cid, ts, students=10.0, price=100.0, disc=80.0, rating=4.5, dist=None, title=" T ",
           pub="01/02/2024", level="Beginner", lang="English", cat="Web", dur=7200.0, reviews=1.0):
    return (cid, title, " h ", lang, level, dur, pub, "1/2/2024", price, disc, students, reviews, rating,
            dist, "/course/x/", cat, ts)


def test_nan_null_zero_students_and_best_record(spark):
    rows = [course("1", "01/05/2026 10:00", students=float("nan")),
            course("1", "02/05/2026 10:00", students=None),
            course("1", "2026-05-03 04:59", students=0.0),
            course("1", "2026-04-01 00:00", students=7.0)]
    stg = staging.stg_courses(spark.createDataFrame(rows, COURSE_COLS))
    got = {r.scraped_at: r.num_students for r in stg.collect()}
    assert sorted(got.values()) == [0, 0, 0, 7]  # NaN and NULL default to 0 (Q2, Q3)
    best = marts.best_course_record(stg).collect()
    assert len(best) == 1 and best[0].num_students == 7  # students first, then recency (F4)


def test_timestamp_formats_and_garbage(spark):
    df = spark.createDataFrame([("03/05/2026 04:59",), ("2026-05-03 04:59",), ("garbage",), (None,)], "t string")
    got = [r.ts for r in df.select(parse_timestamp(F.col("t")).alias("ts")).collect()]
    assert got[0] == got[1] == dt.datetime(2026, 5, 3, 4, 59)
    assert got[2] is None and got[3] is None


def test_dates_one_or_two_digits_blank_invalid(spark):
    df = spark.createDataFrame([("1/2/2024",), ("01/02/2024",), ("  ",), (None,), ("31/02/2024",)], "d string")
    got = [r.d for r in df.select(parse_date(F.col("d")).alias("d")).collect()]
    assert got == [dt.date(2024, 2, 1), dt.date(2024, 2, 1), None, None, None]


def test_rating_json_variants(spark):
    df = spark.createDataFrame([("None",), (None,), ("[]",),
                                ('[{"count":1},{"count":2},{"count":3},{"count":4},{"count":5}]',),
                                ("not json",)], "j string")
    out = df.select(*[c.alias(n) for n, c in staging.rating_counts(F.col("j")).items()]).collect()
    assert [tuple(r) for r in out[:3]] == [(None,) * 5] * 3
    assert tuple(out[3]) == (1, 2, 3, 4, 5)
    assert tuple(out[4]) == (None,) * 5


def _history(spark, rows):
    df = spark.createDataFrame(rows, "course_id long, title string, list_price decimal(18,2), "
                                     "sale_price decimal(18,2), scraped_at timestamp, course_url string")
    return marts.fct_price_history(df).withColumn("category", F.lit("c"))


def _ts(d):
    return dt.datetime(2026, 1, d)


def test_price_path_previous_and_lowest(spark):
    path = [100, 80, 80, 0, 90, 70]
    rows = [(1, "a", Decimal(100), Decimal(p), _ts(i + 1), "/c/1/") for i, p in enumerate(path)]
    rows += [(2, "b", Decimal(0), Decimal(50), _ts(1), "/c/2/")]            # one-row course, list 0
    rows += [(3, "c", Decimal(10), Decimal(0), _ts(d), "/c/3/") for d in (1, 2)]  # only zero prices
    h = _history(spark, rows)
    cp = {r.course_id: r for r in serving.current_and_previous_price(h.drop("category"), h.select("course_id", "category").distinct()).collect()}
    assert cp[1].current_price == 70 and cp[1].previous_price == 90  # Q20: previous positive
    assert cp[2].previous_price is None and cp[3].previous_price is None
    lows = {(r.course_id, r.recorded_at.day) for r in h.filter("is_lowest_price_ever").collect()}
    assert lows == {(1, 6), (2, 1)}  # Q19 all-time minimum, positive only
    assert {r.course_id for r in serving.dropped_courses(h).collect()} == {1}
    disc = {r.course_id: r.discount_percentage for r in h.collect() if r.recorded_at.day == 1}
    assert disc[2] == 0  # list price 0 -> 0 %
    drop = {(r.recorded_date.day): r.discount_percentage for r in serving.history_with_drop(h)
            .filter("course_id = 1").collect()}
    assert drop[2] == Decimal("20.0") and drop[6] == Decimal("22.2")


def test_sale_above_list_and_half_rounding(spark):
    df = spark.createDataFrame([(Decimal("100"), Decimal("120")), (Decimal("200"), Decimal("199"))],
                               "l decimal(18,2), s decimal(18,2)")
    from coursewise.functions.prices import discount_percentage
    got = [r.d for r in df.select(discount_percentage(F.col("l"), F.col("s")).alias("d")).collect()]
    assert got == [Decimal(-20), Decimal(1)]  # 0.5 rounds half away from zero (Q11)


def test_tier_boundaries(spark):
    vals = [0, 400000, 800000, 1500000]
    df = spark.createDataFrame([(float(v),) for v in vals], "p double")
    got = [r.t for r in df.select(price_tier(F.col("p")).alias("t")).collect()]
    assert got == ["Free", "Mid Price (400K - 800K)", "High Price (800K - 1.5M)", "Very High Price (> 1.5M)"]
    df = spark.createDataFrame([(float(v),) for v in (0, 3, 8, 15, 24, 25)], "h double")
    got = [r.t for r in df.select(duration_tier(F.col("h")).alias("t")).collect()]
    assert got == ["Unknown", "Very Short (<= 3h)", "Short (3h - 8h)", "Medium (8h - 15h)",
                   "Long (15h - 24h)", "Very Long (> 24h)"]
    df = spark.createDataFrame([(float(v),) for v in (0, 3.0, 4.0, 2.9)], "r double")
    got = [r.t for r in df.select(rating_tier(F.col("r")).alias("t")).collect()]
    assert got == ["No Rating", "Fair (3 - 3.9)", "Good (4 - 5)", "Poor (under 3)"]


def test_empty_input_kpis_are_zero(spark):
    rows = [course("1", "01/05/2026 10:00")]
    stg = staging.stg_courses(spark.createDataFrame(rows, COURSE_COLS)).limit(0)
    inst = spark.createDataFrame([], "instructor_id string, instructor_name string, job_title string, "
                                     "course_id string, total_students double")
    k = serving.overview_kpis(serving.dedupe_course(stg, inst)).collect()[0]
    assert k.total_courses == 0 and k.avg_price == 0.0 and k.avg_rating == 0.0
    assert not math.isnan(k.pct_review_avg)  # Q16


def test_search_is_regex_case_insensitive_and_null_safe(spark):
    df = spark.createDataFrame([("Learn C++",), ("(intro)",), ("PyThOn basics",), (None,)], "title string")
    assert [r.title for r in serving.search_title(df, "python").collect()] == ["PyThOn basics"]
    assert [r.title for r in serving.search_title(df, "c\\+\\+").collect()] == ["Learn C++"]
    assert [r.title for r in serving.search_title(df, "(", regex=False).collect()] == ["(intro)"]


def test_instructor_filter_and_bridge(spark):
    raw = spark.createDataFrame([(None, " a ", "x", "1", 5.0, 4.0), ("0", "b", "x", "1", 5.0, 4.0),
                                 ("7", " c ", "x", "1", 5.0, 4.44), ("7", "c", "x", "1", 5.0, 4.44)],
                                "instructor_id string, name string, job_title string, course_id string, "
                                "num_students double, avg_rating_score double")
    stg = staging.stg_instructors(raw)
    assert stg.count() == 2 and marts.bridge_course_instructors(stg).count() == 1


def test_hash_key_null_in_null_out(spark):
    df = spark.createDataFrame([("1", dt.datetime(2024, 5, 4, 10, 20))], "c string, t timestamp")
    r = df.select(hash_key(F.col("c"), F.date_format("t", "yyyy-MM-dd HH:mm:ss")).alias("k"),
                  hash_key(F.col("c"), F.lit(None).cast("string")).alias("n")).collect()[0]
    assert len(r.k) == 32 and r.n is None


def test_clean_price_and_formats(spark):
    df = spark.createDataFrame([("₫1,299,000",), ("$12.99",), ("Free",), ("n/a",), (None,)], "t string")
    assert [r.p for r in df.select(clean_price(F.col("t")).alias("p")).collect()] == [1299000.0, 12.99, 0.0,
                                                                                       None, None]
    v = spark.createDataFrame([(Decimal("1234500"),), (Decimal("999"),), (Decimal("1500"),)], "v decimal(20,2)")
    assert [r.k for r in v.select(fmt.fmt_k(F.col("v")).alias("k")).collect()] == ["1.23M", "999", "1.5K"]
    assert [r.k for r in v.select(fmt.fmt_vnd(F.col("v")).alias("k")).collect()] == ["1M d", "999 d", "1,500 d"]


def test_pages_sources(spark):
    html = [
        '<html><head><title>A | Courses</title><meta property="product:price" content="₫1,000"></head></html>',
        '<html><script type="application/ld+json">{"@type":"Course","offers":[{"price":"5"},{"price":"0"}]}'
        '</script></html>',
        '<html><script type="application/ld+json">{"@graph":[{"@type":"Course","offers":{"price":"7"}}]}'
        '</script></html>',
        "<html><body data-module-args='{\"course_id\":\"123456\",\"serverSideProps\":{\"course\":"
        "{\"title\":\"Mod\",\"price_text_data\":{\"amount\":3,\"list_price\":{\"amount\":9}}}}}'></body></html>",
        '<html><div data-purpose="course-price-text"><span>₫2,000</span><span>₫1,500</span></div></html>',
        "<html><title>No price &trade;</title></html>",
        '<html><script type="application/ld+json">{broken</script></html>',
    ]
    df = spark.createDataFrame([(i, "https://x.example.com/c/", h) for i, h in enumerate(html)],
                               "page_id long, url string, html string")
    parts = pages.with_page_parts(df)
    lp, sp = pages.list_and_sale_price(pages.price_candidates_of_parts())
    got = [(r.l, r.s) for r in parts.select(lp.alias("l"), sp.alias("s")).orderBy("page_id").collect()]
    assert got == [(1000, 1000), (5, 5), (7, 7), (9, 3), (2000, 1500), (None, None), (None, None)]
    recs = pages.price_records(df).orderBy("page_id").collect()
    # a price record takes its title from the title tag or the payload's own level, not from the course in it
    assert [(r.course_id, r.title) for r in recs] == [("123456", None)]
    full = pages.course_records(df).orderBy("page_id").collect()
    assert [(r.page_id, r.course_data.course_id, r.course_data.title) for r in full] == [(1, None, None), (2, None, None), (3, "123456", "Mod")]


def test_links_marker_and_normalization(spark):
    html = ('<a href="/course/zero/">before</a><h2>All Python courses</h2>'
            '<a href="/course/a/?x=1">a</a><a href="https://other.example/course/b">b</a>'
            '<a href="/course/a">dup</a><a href="/about">no</a>')
    df = spark.createDataFrame([(1, "https://site.example/listing", html)], "page_id long, url string, html string")
    links = [r.link for r in pages.extract_links(df).collect()]
    assert links == ["https://site.example/course/a/"]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k long, v string")
    assert quality.check_unique(df, ["k"]).collect()[0].n_rows == 2
    nn = {r.column_name: r.null_count for r in quality.check_not_null(df, ["k", "v"]).collect()}
    assert nn == {"k": 0, "v": 1}
    assert quality.check_accepted_values(df, "v", ["a"]).collect()[0].v == "b"


def test_cleaning_helpers(spark):
    df = spark.createDataFrame([(1.0, float("nan"), "x")], "`A b ` double, c double, d string")
    out = cleaning.nan_to_null(cleaning.normalize_columns(df))
    assert out.columns == ["a_b", "c", "d"] and out.collect()[0].c is None


def test_route_names(spark):
    from coursewise.sources.ledger import route_of
    names = ["s3a://b/dashboard/PROD_dashboard_g1_p1-2_20240101_000000_courses.parquet",
             "/x/TEST_tracker_g1_p1-1_20240101_courses.parquet/part-0.parquet",
             "/x/PROD_dashboard_g1_p1-2_20240101_000000_Instructors.parquet",
             "/x/notes.parquet", "/x/courses.csv"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r.t for r in df.select(route_of(F.col("p")).alias("t")).collect()]
    assert got == ["courses", "price_tracker", "instructors", None, None]


def test_pending_files_retries_failed(spark):
    from coursewise.sources.ledger import pending_files, upsert_ledger
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "filename string")
    led = spark.createDataFrame([("a", "SUCCESS", dt.datetime(2024, 1, 1)), ("b", "FAILED", dt.datetime(2024, 1, 1))],
                                "filename string, status string, loaded_at timestamp")
    assert sorted(r.filename for r in pending_files(listing, led).collect()) == ["b", "c"]
    upd = spark.createDataFrame([("b", "SUCCESS", dt.datetime(2024, 1, 2))],
                                "filename string, status string, loaded_at timestamp")
    cur = upsert_ledger(led, upd)
    assert {r.filename: r.status for r in cur.collect()} == {"a": "SUCCESS", "b": "SUCCESS"}
