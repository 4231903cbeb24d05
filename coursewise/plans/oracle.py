"""DuckDB SQL oracles: independent re-statements of each query in plain SQL.

DuckDB divides decimals in DOUBLE, so exact rounded ratios are written with
integer arithmetic: round_half_up(n / d) = (2n + d) // (2d) for n >= 0, d > 0.
Outputs use BIGINT / DOUBLE / VARCHAR / BOOLEAN / DATE / TIMESTAMP only.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixtures (FIXTURES.md B)

FX_OFFERS = """
fx_offers AS (
SELECT l_partkey AS course_id,
       concat('  ', p_name, ' ') AS title,
       CASE WHEN l_tax = 0 THEN NULL
            ELSE CAST(l_extendedprice * 20 AS DECIMAL(18,2)) END AS original_price,
       CASE WHEN l_linenumber = 7 THEN NULL
            WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice * 20 * (1 - l_discount) AS DECIMAL(18,2)) END AS discount_price,
       concat('/course/', CAST(l_partkey AS STRING), '/') AS _url,
       p_brand AS _category, l_shipdate AS scraped_at, l_orderkey, l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FX_COURSES = """
fx_courses AS (
SELECT l_partkey AS course_id,
       concat(' ', p_name) AS title,
       concat(p_type, ' ', p_brand, ' ') AS headline,
       n_name AS language,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS level,
       CAST(p_size * 1800 AS DOUBLE) AS course_duration_seconds,
       CASE WHEN l_linenumber = 6 THEN ' '
            ELSE concat(lpad(CAST(day(o_orderdate) AS STRING),2,'0'),'/',
                        lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'/',
                        CAST(year(o_orderdate) AS STRING)) END AS publishes_date,
       concat(lpad(CAST(day(l_shipdate) AS STRING),2,'0'),'/',
              lpad(CAST(month(l_shipdate) AS STRING),2,'0'),'/',
              CAST(year(l_shipdate) AS STRING)) AS lasted_updated_date,
       CAST(l_extendedprice * 20 AS DECIMAL(18,2)) AS original_price,
       CASE WHEN l_linenumber = 7 THEN NULL
            WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice * 20 * (1 - l_discount) AS DECIMAL(18,2)) END AS discount_price,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS num_students,
       CAST(l_linenumber AS DOUBLE) AS num_reviews,
       l_quantity / 10.0 AS avg_rating_score,
       CASE WHEN l_linenumber = 7 THEN 'None'
            ELSE concat('[{"rating":1,"count":', CAST(l_linenumber AS STRING),
                        '},{"rating":2,"count":', CAST(p_size AS STRING), '}]') END AS rating_distribution,
       concat('/course/', CAST(l_partkey AS STRING), '/') AS _url,
       p_brand AS _category, l_shipdate AS scraped_at, l_orderkey, l_linenumber
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey)"""

FX_INSTRUCTORS = """
fx_instructors AS (
SELECT CAST(s_suppkey AS STRING) AS instructor_id, concat(' ', s_name) AS name,
       n_name AS job_title, l_partkey AS course_id,
       sum(l_quantity) AS num_students, CAST(avg(l_quantity)/10 AS DOUBLE) AS avg_rating_score
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY s_suppkey, s_name, n_name, l_partkey)"""

FX_LISTING = """
fx_listing AS (SELECT c_name AS filename FROM customer)"""

FX_LEDGER = """
fx_ledger AS (
SELECT c_name AS filename,
       CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       o_orderdate AS loaded_at, o_orderkey
FROM orders JOIN customer ON o_custkey = c_custkey)"""


def rdiv(n: str, d: str, scale: int = 0) -> str:
    """round(n / d, scale) HALF_UP for integer n >= 0 and d > 0, as DOUBLE."""
    m = 10 ** scale
    q = f"((2 * CAST({n} AS HUGEINT) * {m} + CAST({d} AS HUGEINT)) // (2 * CAST({d} AS HUGEINT)))"
    return f"(CAST({q} AS DOUBLE) / {m})" if scale else f"CAST({q} AS DOUBLE)"


def rdiv_signed(n: str, d: str, scale: int = 0) -> str:
    """round(n / d, scale) half away from zero for any integer n and d > 0, as DOUBLE."""
    m = 10 ** scale
    a = f"CAST(abs({n}) AS HUGEINT)"
    q = f"((2 * {a} * {m} + CAST({d} AS HUGEINT)) // (2 * CAST({d} AS HUGEINT)))"
    return f"(sign({n}) * CAST({q} AS DOUBLE) / {m})"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS HUGEINT)"


# ---------------------------------------------------------------- silver

STG_COURSES = """
stg_typed AS (
SELECT course_id, trim(title) AS title, trim(headline) AS headline, language, level,
       round(course_duration_seconds / 3600.0, 1) AS duration_hours,
       CAST(try_strptime(NULLIF(trim(publishes_date), ''), '%d/%m/%Y') AS DATE) AS published_date,
       CAST(try_strptime(NULLIF(trim(lasted_updated_date), ''), '%d/%m/%Y') AS DATE) AS last_updated_date,
       COALESCE(original_price, 0) AS list_price,
       COALESCE(discount_price, original_price, 0) AS sale_price,
       CAST(trunc(COALESCE(CASE WHEN isnan(num_students) THEN NULL ELSE num_students END, 0)) AS BIGINT) AS num_students,
       CAST(trunc(COALESCE(CASE WHEN isnan(num_reviews) THEN NULL ELSE num_reviews END, 0)) AS BIGINT) AS num_reviews,
       round(CAST(avg_rating_score AS DECIMAL(10,3)), 1) AS rating,
       rating_distribution, _url AS course_url, _category AS category, scraped_at,
       row_number() OVER (PARTITION BY course_id, scraped_at ORDER BY l_orderkey, l_linenumber) AS rn
FROM fx_courses),
stg_courses AS (
SELECT course_id, title, headline, language, level, duration_hours, published_date,
       last_updated_date, list_price, sale_price, num_students, num_reviews, rating, course_url,
       category, scraped_at, rating_distribution,
       TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[0].count') AS INTEGER) AS rating_1,
       TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[1].count') AS INTEGER) AS rating_2,
       TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[2].count') AS INTEGER) AS rating_3,
       TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[3].count') AS INTEGER) AS rating_4,
       TRY_CAST(json_extract_string(NULLIF(rating_distribution, 'None'), '$[4].count') AS INTEGER) AS rating_5
FROM stg_typed WHERE rn = 1)"""

STG_INSTRUCTORS = """
stg_instructors AS (
SELECT instructor_id, trim(name) AS instructor_name, job_title, course_id,
       num_students AS total_students,
       round(CAST(avg_rating_score AS DECIMAL(10,3)), 1) AS instructor_rating,
       CAST(NULL AS DOUBLE) AS num_of_courses, CAST(NULL AS DOUBLE) AS total_num_reviews
FROM fx_instructors
WHERE instructor_id IS NOT NULL AND instructor_id <> '0')"""

STG_PRICE = """
stg_price_typed AS (
SELECT course_id, trim(title) AS title,
       COALESCE(original_price, 0) AS list_price,
       COALESCE(discount_price, original_price, 0) AS sale_price,
       scraped_at, _url AS course_url,
       row_number() OVER (PARTITION BY course_id, scraped_at ORDER BY l_orderkey, l_linenumber) AS rn
FROM fx_offers),
stg_price_tracker AS (
SELECT course_id, title, list_price, sale_price, scraped_at, course_url FROM stg_price_typed WHERE rn = 1)"""

# ---------------------------------------------------------------- gold

BEST_COURSE = """
best_course AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY course_id
            ORDER BY CASE WHEN num_students > 0 THEN 1 ELSE 0 END DESC, scraped_at DESC NULLS LAST) AS rn
  FROM stg_courses) WHERE rn = 1)"""

DIMS = """
dim_category AS (
SELECT row_number() OVER (ORDER BY category) AS category_id, category AS category_name
FROM (SELECT DISTINCT category FROM stg_courses WHERE category IS NOT NULL)),
dim_language AS (
SELECT row_number() OVER (ORDER BY language) AS language_id, language AS language_name
FROM (SELECT DISTINCT language FROM stg_courses WHERE language IS NOT NULL)),
dim_level AS (
SELECT row_number() OVER (ORDER BY level) AS level_id, level AS level_name
FROM (SELECT DISTINCT level FROM stg_courses WHERE level IS NOT NULL)),
dim_course AS (
SELECT b.course_id, b.title, b.headline, b.course_url, b.published_date, b.duration_hours,
       b.list_price, c.category_id, g.language_id, v.level_id
FROM best_course b
LEFT JOIN dim_category c ON b.category = c.category_name
LEFT JOIN dim_language g ON b.language = g.language_name
LEFT JOIN dim_level v ON b.level = v.level_name)"""

TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S') || '+00'"


def hash_sql(id_col: str, ts_col: str) -> str:
    return f"md5(CAST({id_col} AS VARCHAR) || '-' || {TS_TEXT.format(c=ts_col)})"


# discount: round((1 - sale/list) * 100) = round((list - sale) * 100 / list) on cents
DISCOUNT = ("CASE WHEN list_price > 0 THEN "
            + rdiv_signed(f"({cents('list_price')} - {cents('sale_price')}) * 100", cents("list_price"))
            + " ELSE 0 END")

PRICE_HISTORY = f"""
fct_base AS (
SELECT {hash_sql('course_id', 'scraped_at')} AS history_id, course_id, title, course_url,
       list_price, sale_price, scraped_at AS recorded_at, {DISCOUNT} AS discount_percentage
FROM stg_price_tracker),
fct_price_history AS (
SELECT history_id, course_id, title, course_url, list_price, sale_price, recorded_at, discount_percentage,
       COALESCE(sale_price > 0 AND sale_price <= min(CASE WHEN sale_price > 0 THEN sale_price END)
                OVER (PARTITION BY course_id), false) AS is_lowest_price_ever
FROM fct_base)"""

# latest titled record per course, metrics
PCT_H = ("CASE WHEN num_students > 0 THEN (2 * CAST(num_reviews AS HUGEINT) * 10000 + num_students) "
         "// (2 * CAST(num_students AS HUGEINT)) ELSE 0 END")

LATEST = """
latest AS (
SELECT course_id, title, category, language, level, rating, num_students, num_reviews, list_price,
       sale_price, duration_hours, course_url, scraped_at, rating_1, rating_2, rating_3, rating_4, rating_5
FROM (SELECT *, row_number() OVER (PARTITION BY course_id
             ORDER BY scraped_at DESC NULLS LAST, title, sale_price) AS rn
      FROM stg_courses WHERE title IS NOT NULL) WHERE rn = 1)"""

METRICS = f"""
metrics AS (
SELECT *, num_students * sale_price AS est_revenue,
       {PCT_H} AS pct_h,
       CASE WHEN sale_price <= 0 THEN 'Free' WHEN sale_price < 400000 THEN 'Low Price (< 400K)'
            WHEN sale_price < 800000 THEN 'Mid Price (400K - 800K)'
            WHEN sale_price < 1500000 THEN 'High Price (800K - 1.5M)'
            ELSE 'Very High Price (> 1.5M)' END AS price_tier,
       CASE WHEN duration_hours <= 0 THEN 'Unknown' WHEN duration_hours <= 3 THEN 'Very Short (<= 3h)'
            WHEN duration_hours <= 8 THEN 'Short (3h - 8h)' WHEN duration_hours <= 15 THEN 'Medium (8h - 15h)'
            WHEN duration_hours <= 24 THEN 'Long (15h - 24h)' ELSE 'Very Long (> 24h)' END AS duration_tier,
       CASE WHEN rating <= 0 THEN 'No Rating' WHEN rating >= 4 THEN 'Good (4 - 5)'
            WHEN rating >= 3 THEN 'Fair (3 - 3.9)' ELSE 'Poor (under 3)' END AS rating_tier
FROM latest),
first_instructor AS (
SELECT course_id, min(instructor_name) AS instructor_name FROM stg_instructors GROUP BY course_id),
per_course AS (
SELECT m.*, f.instructor_name FROM metrics m LEFT JOIN first_instructor f USING (course_id))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


COURSE_BASE = (FX_COURSES, STG_COURSES)
INSTR_BASE = (FX_INSTRUCTORS, STG_INSTRUCTORS)
GOLD_BASE = (FX_COURSES, STG_COURSES, FX_INSTRUCTORS, STG_INSTRUCTORS, LATEST, METRICS)
PRICE_BASE = (FX_OFFERS, STG_PRICE, PRICE_HISTORY)
ENRICHED = (FX_COURSES, STG_COURSES, BEST_COURSE, DIMS, FX_OFFERS, STG_PRICE, PRICE_HISTORY, """
history AS (
SELECT f.course_id, f.title, f.course_url, f.list_price, f.sale_price, f.recorded_at,
       f.discount_percentage, f.is_lowest_price_ever, c.category_name AS category
FROM fct_price_history f
LEFT JOIN dim_course d ON f.course_id = d.course_id
LEFT JOIN dim_category c ON d.category_id = c.category_id
WHERE f.title IS NOT NULL)""")


# ---------------------------------------------------------------- display formatting

def _fixed_text(c: str, unit_cents: int, digits: int) -> str:
    """Text of round(c / unit_cents, digits) HALF_UP with exactly ``digits`` decimals (c >= 0)."""
    m = 10 ** digits
    q = f"((2 * CAST({c} AS HUGEINT) * {m} + {unit_cents}) // (2 * CAST({unit_cents} AS HUGEINT)))"
    if digits == 0:
        return f"CAST({q} AS VARCHAR)"
    return f"(CAST({q} // {m} AS VARCHAR) || '.' || lpad(CAST({q} % {m} AS VARCHAR), {digits}, '0'))"


def _thousands(v: str) -> str:
    return f"format('{{:,}}', CAST(trunc({v}) AS BIGINT))"


def fmt_k_sql(v: str) -> str:
    c = cents(v)
    return (f"CASE WHEN {v} >= 1000000 THEN {_fixed_text(c, 100_000_000, 2)} || 'M' "
            f"WHEN {v} >= 1000 THEN {_fixed_text(c, 100_000, 1)} || 'K' "
            f"ELSE CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR) END")


def fmt_vnd_sql(v: str) -> str:
    c = cents(v)
    return (f"CASE WHEN {v} <= 0 THEN 'Free' "
            f"WHEN {v} >= 1000000000 THEN {_fixed_text(c, 100_000_000_000, 2)} || 'T d' "
            f"WHEN {v} >= 1000000 THEN {_fixed_text(c, 100_000_000, 0)} || 'M d' "
            f"ELSE {_thousands(v)} || ' d' END")


def fmt_bn_sql(v: str) -> str:
    c = cents(v)
    return (f"CASE WHEN {v} <= 0 THEN '0' "
            f"WHEN {v} >= 1000000000000 THEN {_fixed_text(c, 100_000_000_000_000, 2)} || 'T d' "
            f"WHEN {v} >= 1000000000 THEN {_fixed_text(c, 100_000_000_000, 1)} || 'B d' "
            f"WHEN {v} >= 1000000 THEN {_fixed_text(c, 100_000_000, 0)} || 'M d' "
            f"ELSE {_thousands(v)} END")


def fixed_sql(v: str, digits: int) -> str:
    return _fixed_text(cents(v), 100, digits)
