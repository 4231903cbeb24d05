"""Course-shaped inputs derived from the driver tables (FIXTURES.md, part B).

The driver ships TPC-H-like tables; these functions re-shape them into the
bronze schemas the engine consumes (offers, course pages, instructors, a file
listing and a load ledger).  Everything is a lazy DataFrame over the parquet
scans, so Catalyst prunes columns and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursewise.operators.skew import PLACE, placed_join
from coursewise.session import read_table

MONEY = "decimal(18,2)"


def _dmy(c):
    """DD/MM/YYYY text of a date or timestamp column."""
    return F.concat(
        F.lpad(F.dayofmonth(c).cast("string"), 2, "0"), F.lit("/"),
        F.lpad(F.month(c).cast("string"), 2, "0"), F.lit("/"),
        F.year(c).cast("string"),
    )


def _sale_price():
    return (F.when(F.col("l_linenumber") == 7, F.lit(None).cast(MONEY))
            .when(F.col("l_discount") == 0, F.lit(0).cast(MONEY))
            .otherwise((F.col("l_extendedprice") * 20 * (1 - F.col("l_discount"))).cast(MONEY)))


def _with_part(rows: DataFrame, li: DataFrame, part: DataFrame, place: bool) -> DataFrame:
    """Rows of line items with their part; ``place`` leaves those of a part and ship time together (``skew.placed``)."""
    part = part.withColumnRenamed("p_partkey", "l_partkey")
    return placed_join(rows, part, "l_partkey", ["l_shipdate"], li) if place else rows.join(part, "l_partkey")


def fx_offers(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    """Price-tracker bronze rows: one offer per line item; ``place`` adds ``skew.PLACE`` for staging."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    j = _with_part(li, li, part, place)
    return j.select(
        F.col("l_partkey").alias("course_id"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("title"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast(MONEY))
         .otherwise((F.col("l_extendedprice") * 20).cast(MONEY)).alias("original_price"),
        _sale_price().alias("discount_price"),
        F.concat(F.lit("/course/"), F.col("l_partkey").cast("string"), F.lit("/")).alias("_url"),
        F.col("p_brand").alias("_category"),
        F.col("l_shipdate").alias("scraped_at"),
        "l_orderkey", "l_linenumber", *[PLACE] * place,
    )


def fx_courses(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    """Course-page bronze rows (one scrape per line item); ``place`` adds ``skew.PLACE`` for staging.

    Line items are shuffled as they are, by order and by part; the texts of
    parts and nations come last and are in no shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders")
    supp = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    rows = li.join(supp, li.l_suppkey == supp.s_suppkey).join(orders, li.l_orderkey == orders.o_orderkey)
    j = _with_part(rows, li, part, place).join(nation, F.col("s_nationkey") == nation.n_nationkey)
    ln = F.col("l_linenumber")
    return j.select(
        F.col("l_partkey").alias("course_id"),
        F.concat(F.lit(" "), "p_name").alias("title"),
        F.concat("p_type", F.lit(" "), "p_brand", F.lit(" ")).alias("headline"),
        F.col("n_name").alias("language"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("level"),
        (F.col("p_size") * 1800).cast("double").alias("course_duration_seconds"),
        F.when(ln == 6, F.lit(" ")).otherwise(_dmy(F.col("o_orderdate"))).alias("publishes_date"),
        _dmy(F.col("l_shipdate")).alias("lasted_updated_date"),
        (F.col("l_extendedprice") * 20).cast(MONEY).alias("original_price"),
        _sale_price().alias("discount_price"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity")).alias("num_students"),
        ln.cast("double").alias("num_reviews"),
        (F.col("l_quantity") / 10.0).alias("avg_rating_score"),
        F.when(ln == 7, F.lit("None")).otherwise(F.concat(
            F.lit('[{"rating":1,"count":'), ln.cast("string"),
            F.lit('},{"rating":2,"count":'), F.col("p_size").cast("string"),
            F.lit("}]"))).alias("rating_distribution"),
        F.concat(F.lit("/course/"), F.col("l_partkey").cast("string"), F.lit("/")).alias("_url"),
        F.col("p_brand").alias("_category"),
        F.col("l_shipdate").alias("scraped_at"),
        "l_orderkey", "l_linenumber", *[PLACE] * place,
    )


def fx_instructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructor bronze rows: one per (supplier, part) pair.

    Line items are added up by their keys before the supplier's texts come to
    them.  Suppliers that come several times count as often (``times``).
    """
    li = read_table(spark, sf_dir, "lineitem")
    supp = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    pairs = li.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"),
                                                     (F.avg("l_quantity") / 10).cast("double").alias("avg_rating_score"))
    people = (supp.join(nation, supp.s_nationkey == nation.n_nationkey)
                  .groupBy("s_suppkey", "s_name", "n_name").agg(F.count(F.lit(1)).alias("times")))
    return (pairs.join(people, pairs.l_suppkey == people.s_suppkey)
                 .select(F.col("s_suppkey").cast("string").alias("instructor_id"),
                         F.concat(F.lit(" "), "s_name").alias("name"),
                         F.col("n_name").alias("job_title"),
                         F.col("l_partkey").alias("course_id"),
                         (F.col("quantity") * F.col("times")).alias("num_students"), "avg_rating_score"))


def fx_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names seen in the landing folder."""
    return read_table(spark, sf_dir, "customer").select(F.col("c_name").alias("filename"))


def fx_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-ledger records (several attempts per file)."""
    orders = read_table(spark, sf_dir, "orders")
    cust = read_table(spark, sf_dir, "customer")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .select(F.col("c_name").alias("filename"),
                    F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
                    F.col("o_orderdate").alias("loaded_at"),
                    "o_orderkey"))


# Tie-break columns that make (course, scrape time) duplicates totally ordered.
FIXTURE_TIE_BREAK = ["l_orderkey", "l_linenumber"]


PAGE_SITE = "https://courses.example.com"
PAGE_ID_BASE = 100000


def _num(c):
    """Price text with thousands separators and two decimals."""
    return F.format_number(c, 2)


def fx_course_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course pages rendered from the offers: one page per line item.

    Each line number puts the price in a different place (meta tag, JSON-LD
    object / @graph / list, body payload JSON, visible price text, nowhere),
    so the extraction jobs see every source.  Counts appear as page text.
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    list_price = F.when(F.col("l_tax") == 0, F.lit(None).cast(MONEY)).otherwise((F.col("l_extendedprice") * 20).cast(MONEY))
    ln, L, p = F.col("l_linenumber"), F.col("__list"), F.col("__sale")
    # a price stands in a page several times: it is computed once, for pages that show it
    j = li.join(part, li.l_partkey == part.p_partkey).withColumns({
        "__list": F.when(ln.isin(2, 4, 5, 6), list_price), "__sale": F.when(ln.isin(1, 2, 3, 5, 6), _sale_price())})
    cid = (F.col("l_partkey") + PAGE_ID_BASE).cast("string")
    title = F.trim(F.col("p_name"))

    def offer(v):
        return F.when(v.isNotNull(), F.concat(F.lit('{"price":"'), v.cast("string"), F.lit('"}')))

    meta = F.when((ln == 1) & p.isNotNull(), F.concat(
        F.lit('<meta property="product:price" content="'),
        F.when(p == 0, F.lit("Free")).otherwise(F.concat(F.lit("₫"), _num(p))), F.lit('">')))
    ld_body = (F.when(ln == 2, F.concat(F.lit('{"@type":"Course","name":"'), title, F.lit('","offers":['),
                                        F.concat_ws(",", offer(L), offer(p)), F.lit("]}")))
                .when((ln == 3) & p.isNotNull(), F.concat(
                    F.lit('{"@graph":[{"@type":"WebPage","name":"home"},{"@type":"Course","name":"'), title,
                    F.lit('","offers":'), offer(p), F.lit("}]}")))
                .when((ln == 4) & L.isNotNull(), F.concat(
                    F.lit('[{"@type":"Product","name":"'), title, F.lit('","offers":'), offer(L), F.lit("}]"))))
    ld = F.when(ld_body.isNotNull(), F.concat(F.lit('<script type="application/ld+json">'), ld_body,
                                              F.lit("</script>")))

    def amount(v):
        return F.when(v.isNotNull(), F.concat(F.lit('{"amount":'), v.cast("string"), F.lit("}")))

    prices = F.concat_ws(",", F.when(p.isNotNull(), F.concat(F.lit('"amount":'), p.cast("string"))),
                         F.when(L.isNotNull(), F.concat(F.lit('"list_price":'), amount(L))))
    payload = F.concat(
        F.lit('{"course_id":"'), cid, F.lit('","serverSideProps":{"course":{"title":"'), title,
        F.lit('","price_text_data":{'), prices, F.lit('},"visible_instructors":[{"id":"'),
        F.col("l_suppkey").cast("string"), F.lit('","display_name":"Instructor '),
        F.col("l_suppkey").cast("string"), F.lit('","job_title":"'), F.col("p_type"),
        F.lit('","num_students":'), F.col("l_quantity").cast("bigint").cast("string"), F.lit("}]}}}"))
    body_attr = F.when(ln == 5, F.concat(F.lit(' data-module-args="'), F.replace(payload, F.lit('"'), F.lit("&quot;")),
                                         F.lit('"'))).otherwise(F.lit(""))

    def span(v):
        return F.when(v.isNotNull(), F.concat(F.lit("<span>₫"), _num(v), F.lit("</span>")))

    visible = F.when(ln == 6, F.concat(F.lit('<div data-purpose="course-price-text">'),
                                       F.concat_ws("", span(L), span(p)), F.lit("</div>")))
    students = (F.col("l_quantity") * 1000).cast("bigint") + ln
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), title, F.lit(" | Courses</title>"),
        F.coalesce(meta, F.lit("")), F.coalesce(ld, F.lit("")), F.lit("</head><body"), body_attr, F.lit(">"),
        F.lit("<h1>"), title, F.lit("</h1>"), F.coalesce(visible, F.lit("")),
        F.lit('<div data-purpose="enrollment">'), F.format_number(students, 0), F.lit(" students</div>"),
        F.lit('<span data-purpose="rating-number">'), (F.col("l_quantity") / 10).cast("decimal(4,1)").cast("string"),
        F.lit("</span>"), F.lit('<a data-purpose="rating">('), F.format_number(F.col("l_orderkey") % 100000, 0),
        F.lit(" ratings)</a>"), F.lit('<script>window.app={courseId: "'), cid, F.lit('"};</script>'),
        F.lit("</body></html>"))
    return j.select(
        (F.col("l_orderkey") * 10 + ln).alias("page_id"),
        F.concat(F.lit(PAGE_SITE + "/course/"), cid, F.lit("/")).alias("url"),
        F.col("p_brand").alias("category"),
        html.alias("html"))


# Page forms, one per part in turn; K stands for the part key, S for its size, I for the page's course id.
PAGE_FORMS = [
    """<html><head>
<title>T0 K | Courses</title>
<script type='application/ld+json'>
{
  "@context": "x", "@type": "Course", "name": "Name K", "description": "About K",
  "inLanguage": "en", "educationalLevel": "Beginner", "datePublished": "2024-01-02",
  "hasCourseInstance": {"courseWorkload": "PTSH30M", "instructor": [{"name": "Ann K"}, {"name": "Bob"}]},
  "aggregateRating": {"ratingValue": 4.5, "ratingCount": S},
  "offers": {"price": "K.5"}
}
</script></head><body>courseId = I</body></html>""",
    """<html><title>T1 K | Courses</title><body><script id="__NEXT_DATA__" type="application/json">
{"props": {"pageProps": {"course_id": "I",
  "course": {"id": 7, "title": "Next K", "numStudents": S, "content_length_video": S},
  "reviews": {"averageRating": 3.5, "numberOfReviews": S, "ratingDistribution": [{"rating": 1, "count": S}]}}}}
</script></body></html>""",
    """<html><body class=a data-module-args="{&quot;course_id&quot;:&quot;I&quot;,&quot;title&quot;:&quot;Root K&quot;,&quot;componentProps&quot;:{
&quot;course&quot;:{&quot;title&quot;:&quot;Mod K&quot;,&quot;num_students&quot;:S},&quot;reviews&quot;:{&quot;averageRating&quot;:2.5,&quot;numberOfReviews&quot;:K}}}"></body></html>""",
    """<html><head><title>
  Attr K | Courses
</title></head><BODY class="x" data-clp-course-id="I">
<div data-purpose="course-price-text">
<span>Now</span>
<span><b>1,0</b>00</span></div>
<DIV class='p' data-purpose='course-price-text'><SPAN>₫20</SPAN></DIV></BODY></html>""",
    """<html><body data-module-args='{"course_id":"I","portal_data":{"course":{"title":"Por K"}}}'>
<p class="big enrollment-count x">
<span>S,000</span> students</p><span data-purpose='rating-number'><i>4</i>.7</span>
<a href="#r" data-purpose="rating">(
<b>K</b> ratings)</a></body></html>""",
    """<html><title>None</title><body>nothing here</body></html>""",
    """<html><title>T6 K | Courses</title><script type="application/ld+json">[{"@type":"WebSite"},
{"@type":"Product","name":"","provider":{"name":"School K"},"offers":[{"price":10},{"price":"20"}]}]</script><body>var courseId=I;</body></html>""",
    """<html><script type="application/ld+json">{"@graph":[{"@type":"Course","name":"Big K","author":[{"name":"Au K"}],
"hasCourseInstance":{"courseWorkload":"PT99999999999999999999H"}}]}</script><body>courseId:I</body></html>""",
    """<html><head><meta data-x="a > b" content="99&#46;5" name=price property='product:price'><title>T8 K | Courses</title></head>
<body data-x='<div data-purpose="enrollment">9</div>' data-module-args='{"course_id":"I","componentProps":{"course":{"title":"Caf&eacute; &#x27;K&#x27; &amp;amp; &hearts;"}}}'>
<div data-purpose="course-price-text"><div class="old"><span>was</span><div><span>₫ <span>1,50</span>0</span></div></div><!-- <span>7</span> --><span>Free</span></div>
<div class="c" data-purpose=enrollment><div>total</div><div>1&#44;S students</div></div>
<span data-purpose="rating-number"><span>Rated</span> <span>4.K</span></span></body></html>""",
]


def fx_page_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course pages in every form the extraction knows, one per part: blocks over several lines,
    JSON-LD or an id attribute alone, two price blocks, tags within numbers, no payload at all, attributes in
    another order, elements within elements of the same name, and references of every kind."""
    # a small file makes many pages: the rows are dealt out before they become pages, or a few tasks would parse them all
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    part = part.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *part.columns)
    key = F.col("p_partkey")
    html = F.lit(None).cast("string")
    for i, form in enumerate(PAGE_FORMS):
        # the letters stand alone or between signs in the forms, never inside a word
        text = F.regexp_replace(F.lit(form), r"\bK\b", key.cast("string"))
        text = F.regexp_replace(text, r"\bI\b", (key + 2 * PAGE_ID_BASE).cast("string"))
        text = F.regexp_replace(text, r"\bS\b|(?<=PT)S(?=H)", F.col("p_size").cast("string"))
        html = F.when(key % len(PAGE_FORMS) == i, text).otherwise(html)
    return part.select(key.alias("page_id"), F.concat(F.lit(PAGE_SITE + "/course/"), key.cast("string"), F.lit("/")).alias("url"),
                       F.col("p_brand").alias("category"), html.alias("html"))


def fx_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages, one per supplier: with a marker in a heading, around and between tags, in a paragraph (which
    is none) or without one; links in double and single quotes, capitals, absolute, elsewhere, with a query."""
    supp = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    marker = F.element_at(F.array(F.lit("<h2 class='m'>\n All Python courses</h2>"), F.lit("<p>All Python courses</p>"), F.lit(""),
                                  F.lit("<div>🙂<p>All</p></div><div><b>All the</b> best <i>Python courses</i></div>"), F.lit("<H1><b> All courses </b></H1>")),
                          (F.col("s_suppkey") % 5 + 1).cast("int"))
    html = F.concat(F.lit('<html><body><a class="n" href="/course/first-'), k, F.lit('/">x</a>'), marker,
                    F.lit("<A data-x='1' HREF='/course/second-"), k, F.lit("?a=1&amp;b=2'>y</A><a\nhref=\"" + PAGE_SITE + "/course/third-"), k,
                    F.lit('//">z</a><a href="https://other.example.com/course/x/">o</a><a href="/about/">a</a><a data-href="/course/no/">n</a></body></html>'))
    return supp.select(F.col("s_suppkey").alias("page_id"), F.lit(PAGE_SITE + "/list?p=1").alias("url"), html.alias("html"))
