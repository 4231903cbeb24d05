"""Page extraction (E1-E17) as set-based jobs over a ``pages(page_id, url, html)`` table.

The reference parses one page at a time in Python; here each field is a
Catalyst string/JSON expression evaluated per row inside whole-stage codegen,
so a batch of pages is one scan.  Malformed pages give NULL fields.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursewise.functions import markup
from coursewise.functions.prices import clean_price

# --------------------------------------------------------------------------- links

# the href value of an anchor: in double quotes, single quotes or bare, tag and attribute in any case
ANCHOR_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Listing marker "All ... courses" opening the course section of a listing page, and its tags.
# An element's text is that of its pieces between tags, each without white space around it: "All " has to begin the
# first piece and " courses" to end the last one, within the element.
MARKER = (r"(?s)<(?<tag>(?i:h1|h2|div|span))\b[^>]*+>(?:\s++|<(?!/?\k<tag>\b)[^>]*+>)*+"
          r"(?:All (?:[^<]* )?courses|All [^<]*[^<\s][^<]*<(?:(?!</?\k<tag>\b).)*>[^<]*[^<\s][^<]* courses)"
          r"\s*+(?:</(?!\k<tag>\b)[^>]*+>\s*+)*+</\k<tag>\b")


def site_of(url: Column) -> Column:
    """scheme://host of a URL."""
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def normalize_url(href: Column, base: Column) -> Column:
    """Absolute URL without query string, exactly one trailing ``/``."""
    absolute = F.when(href.startswith("/"), F.concat(base, href)).otherwise(href)
    no_query = F.split_part(absolute, F.lit("?"), F.lit(1))
    return F.concat(F.regexp_replace(no_query, "/+$", ""), F.lit("/"))


def extract_links(pages: DataFrame, path_filter: str = "/course/", host_col: str | None = None) -> DataFrame:
    """Per page, the distinct sorted links whose href contains ``path_filter``.

    When a heading, div or span reads "All ... courses" only anchors after it
    count.  Relative links are resolved against the page's own site; the
    result must stay on that site and under ``path_filter``.
    """
    base = F.col(host_col) if host_col else site_of(F.col("url"))
    at = pages.select("page_id", F.col("html").alias("__html"), base.alias("__base"),
                      _found(F.col("html"), f"({MARKER}.*)").alias("__section"))
    section = F.coalesce("__section", "__html")
    hrefs = F.transform(F.regexp_extract_all(section, F.lit(ANCHOR_HREF), 1),
                        lambda h: markup.unescape(F.regexp_replace(h, "^[\"']|[\"']$", "")))
    site = F.col("__base")
    links = F.filter(F.transform(F.filter(hrefs, lambda h: h.contains(path_filter)), lambda h: normalize_url(h, site)),
                     lambda u: u.startswith(F.concat(site, F.lit(path_filter))))
    return at.select("page_id", F.explode(F.array_sort(F.array_distinct(links))).alias("link"))


def dedupe_links(links: DataFrame, col: str = "link") -> DataFrame:
    """The set of links over a batch of pages."""
    return links.select(col).dropDuplicates([col])


# --------------------------------------------------------------------------- prices

@dataclass(frozen=True)
class Site:
    """What a site calls things on its course pages; set it once for a real site."""

    meta_price: str = "product:price"
    price_text: str = "course-price-text"
    title_suffix: str = " | Courses"


SITE = Site()
# JSON-LD item types that describe a course, and the members read from one.
ITEM_TYPES = ["Course", "Product"]
_LD_MEMBERS = ["@type", "name", "description", "inLanguage", "educationalLevel", "datePublished",
               "hasCourseInstance", "provider", "author", "aggregateRating", "offers"]
_LD_ITEM = "struct<" + ",".join(f"`{m}`:string" for m in _LD_MEMBERS) + ">"
# Where a course, its reviews and its prices are found in the page's JSON.
COURSE_PATHS = ["$.serverSideProps.course", "$.componentProps.course", "$.portal_data.course"]
REVIEW_PATHS = ["$.serverSideProps.reviewsRatings", "$.componentProps.reviews"]
PRICE_PATHS = ["$.price_text_data.amount", "$.price_text_data.list_price.amount",
               "$.discount.list_price.amount", "$.base_price.amount"]


def _found(html: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, NULL without one."""
    return markup.let(F.regexp_extract(html, pattern, group), lambda got: F.when(got != "", got))


def _attr(name: str, value: str) -> str:
    return rf"""{name}\s*=\s*["']{re.escape(value)}["']"""


TITLE = r"<title.*?>(.*?)</title>"


def _script(attribute: str) -> str:
    return rf"(?is)<script\b[^>]*{attribute}[^>]*>(.*?)</script"


def _json(text: Column, path: str) -> Column:
    """A JSON member that says something: empty text, list and object count as missing (Q22)."""
    return markup.let(F.get_json_object(text, path), lambda got: F.when(~got.isin("", "{}", "[]"), got))


def _arr(*cols: Column) -> Column:
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


def _title_text(title: Column, site: Site) -> Column:
    plain = F.replace(F.replace(title, F.lit(site.title_suffix), F.lit("")), F.lit("&trade;"), F.lit("™"))
    return F.regexp_replace(plain, r"^\s+|\s+$", "")


def _ld_instructors(item: Column) -> Column:
    """A JSON-LD item's people as payload instructors: the instance's instructors, else the provider, else the authors."""
    def named(text):
        people = F.from_json(text, "array<struct<name:string>>")
        return F.transform(F.filter(people, lambda p: p.isNotNull()), lambda p: F.struct(F.coalesce(p["name"], F.lit("")).alias("title")))

    of_course = named(F.get_json_object(item["hasCourseInstance"], "$.instructor"))
    provider = _json(item["provider"], "$.name")
    return F.coalesce(F.when(F.size(of_course) > 0, of_course),
                      F.when(provider.isNotNull(), F.array(F.struct(provider.alias("title")))), named(item["author"]))


def with_page_parts(pages: DataFrame, site: Site = SITE, payload_only: bool = False) -> DataFrame:
    """Every block of a page cut out once, then parsed.

    A projection runs each regular expression over the HTML once; the next
    ones read the short strings it gives.  They reference earlier columns
    several times, so Catalyst keeps the projections apart instead of
    re-inlining the HTML scans.  Blocks may span lines.  With ``payload_only``
    pages without a payload are dropped before the rest is cut out.
    """
    html, low, shown = F.col("html"), F.col("__low"), F.col("__shown")
    cut = pages.withColumn("__low", F.lower(html)).withColumns({
        "__ld_block": markup.if_in(low, "application/ld+json", F.trim(F.regexp_replace(
            _found(html, _script(_attr("type", "application/ld+json"))), r"^\s+|\s+$", ""))),
        "__body": markup.first_tag(html, r"(?is)<body(?=[\s/>])"),
        "__next": markup.if_in(low, "__NEXT_DATA__", _found(html, _script(_attr("id", "__NEXT_DATA__")))),
        "__meta": markup.if_in(low, site.meta_price, markup.attribute(
            markup.first_tag(html, markup.opening("property", re.escape(site.meta_price), "meta")), "content")),
    })
    cut = cut.withColumns({"__module": markup.attribute(F.col("__body"), "data-module-args"), "__clp_id": markup.attribute(F.col("__body"), "data-clp-course-id")})
    block, module, nxt = F.col("__ld_block"), F.col("__module"), F.col("__next")
    items = (F.when(block.startswith("["), F.from_json(block, f"array<{_LD_ITEM}>"))
              .when(block.contains('"@graph"'), F.from_json(block, f"struct<`@graph`:array<{_LD_ITEM}>>").getField("@graph"))
              .when(block.startswith("{"), F.array(F.from_json(block, _LD_ITEM))))
    parsed = cut.withColumns({
        "__ld": F.filter(items, lambda it: it["@type"].isin(*ITEM_TYPES)),
        "__course": F.coalesce(*[_json(module, p) for p in COURSE_PATHS]),
        "__module_reviews": F.coalesce(*[_json(module, p) for p in REVIEW_PATHS]),
        # the next-data script speaks for a page without a body payload only
        "__next_course": F.when(module.isNull(), _json(nxt, "$.props.pageProps.course")),
        "__next_reviews": F.when(module.isNull(), _json(nxt, "$.props.pageProps.reviews")),
        "__next_id": F.when(module.isNull(), _json(nxt, "$.props.pageProps.course_id")),
    })
    parsed = parsed.withColumn("__item", F.get("__ld", F.lit(0)))
    it = F.col("__item")
    from_ld = F.to_json(F.struct(
        it["name"].alias("title"), it["description"].alias("headline"), _ld_instructors(it).alias("visibleInstructors"),
        F.get_json_object(it["hasCourseInstance"], "$.courseWorkload").alias("estimatedContentLength_text"),
        it["inLanguage"].alias("localeSimpleEnglishTitle"), it["educationalLevel"].alias("instructionalLevel"),
        it["datePublished"].alias("lastUpdateDate")))
    ld_reviews = F.to_json(F.struct(F.get_json_object(it["aggregateRating"], "$.ratingValue").alias("averageRating"),
                                    F.get_json_object(it["aggregateRating"], "$.ratingCount").alias("numberOfReviews")))
    own = F.coalesce("__course", "__next_course")
    parsed = parsed.withColumns({
        "__row": F.monotonically_increasing_id(),  # see _above
        "__payload": F.coalesce(own, F.when(it.isNotNull(), from_ld)),
        "__review_data": F.when(own.isNull() & it.isNotNull(), ld_reviews).otherwise(F.coalesce("__module_reviews", "__next_reviews")),
    })
    if payload_only:
        parsed = _above(parsed, F.col("__payload").isNotNull())
    return parsed.withColumn("__shown", markup.visible(html)).withColumn("__shown_low", F.lower(shown)).withColumns({
        "__price_blocks": F.coalesce(markup.if_in(F.col("__shown_low"), site.price_text, markup.elements(
            shown, markup.opening("data-purpose", re.escape(site.price_text), "div"))), F.array().cast("array<string>")),
        "__title_tag": markup.let(F.regexp_extract(html, TITLE, 0), lambda tag: F.when(tag != "", _title_text(F.regexp_extract(tag, TITLE, 1), site))),
        "__title_dom": _title_text(markup.unescape(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title", 1)), site),
        "__cid_text": _found(html, r"courseId[^\d]*(\d{5,8})"),
        "__students": markup.text(F.coalesce(markup.first_element(shown, markup.opening("data-purpose", "enrollment")),
                                             markup.if_in(F.col("__shown_low"), "enrollment-count", markup.first_element(
                                                 shown, markup.opening("class", r"[^\"'>]*enrollment-count[^\"'>]*"))))),
        "__rating": markup.text(markup.first_element(shown, markup.opening("data-purpose", "rating-number"))),
        "__reviews": markup.text(markup.first_element(shown, markup.opening("data-purpose", "rating", "a"))),
    })


def _above(parts: DataFrame, keep: Column) -> DataFrame:
    """Parts filtered where they are: asking for the row number too keeps the filter above the parsing.

    Pushed down to the scan, or into a join's condition, it would bring a copy of every expression along.
    """
    return parts.filter(keep & (F.col("__row") >= 0))


def parts_course_id() -> Column:
    """E8 over page parts: payload id, else the ``courseId`` text."""
    return F.coalesce(_json(F.col("__module"), "$.course_id"), F.col("__next_id"), F.col("__cid_text"))


def parts_title() -> Column:
    """E8 over page parts: payload title, else the title tag without the site suffix."""
    return F.coalesce(_json(F.col("__payload"), "$.title"), F.col("__title_tag"))


def price_candidates_of_parts() -> Column:
    """E5 over page parts: meta tag, JSON-LD offers (> 0), body payload and every visible price text (> 0)."""
    def offer_prices(it):
        o = F.trim(it["offers"])
        lst = F.when(o.startswith("["), F.from_json(o, "array<struct<price:string>>")) \
               .otherwise(F.array(F.from_json(o, "struct<price:string>")))
        return F.transform(F.coalesce(lst, F.array().cast("array<struct<price:string>>")),
                           lambda x: x["price"].try_cast("double"))

    items = F.coalesce(F.col("__ld"), F.array().cast(f"array<{_LD_ITEM}>"))
    ld = F.filter(F.flatten(F.transform(items, offer_prices)), lambda p: p > 0)
    module = _arr(*[F.get_json_object("__course", p).try_cast("double") for p in PRICE_PATHS])
    spans = F.flatten(F.transform("__price_blocks", lambda b: markup.elements(b, r"(?is)<span(?=[\s/>])")))
    texts = F.transform(spans, lambda t: markup.text(t, strip=True))
    visible = F.filter(F.transform(F.filter(texts, lambda t: t.rlike(r"\d")), clean_price),
                       lambda p: p.isNotNull() & (p > 0))
    return F.concat(_arr(clean_price(F.col("__meta"))), ld, module, visible)


def payload_of_parts() -> Column:
    """E7 over page parts: body JSON, else the next-data script, else a JSON-LD course."""
    return F.col("__payload")


def list_and_sale_price(cands: Column) -> tuple[Column, Column]:
    """Distinct candidates; one value -> both prices; several -> (max, min); none -> NULLs."""
    d = F.array_distinct(F.filter(cands, lambda x: x.isNotNull()))
    n = F.size(d)
    return (F.when(n > 0, F.array_max(d)), F.when(n > 0, F.array_min(d)))


# --------------------------------------------------------------------------- identity, counts



# Members of an instructor in the payload, under all their names.
INSTRUCTOR = T.StructType([T.StructField(n, t) for n, t in [
    ("id", T.StringType()), ("display_name", T.StringType()), ("title", T.StringType()),
    ("job_title", T.StringType()), ("total_num_students", T.DoubleType()), ("num_students", T.DoubleType()),
    ("avg_rating_recent", T.DoubleType()), ("rating", T.DoubleType()),
    ("total_num_taught_courses", T.DoubleType()), ("num_published_courses", T.DoubleType()),
    ("total_num_reviews", T.DoubleType()), ("num_reviews", T.DoubleType())]])


def _nz(*cols: Column) -> Column:
    """Python ``a or b``: 0, '' and NULL count as missing (Q22)."""
    return F.coalesce(*[markup.let(c, lambda v: F.when(~v.cast("string").isin("0", "0.0", ""), v)) for c in cols])


def instructors_of(payload: Column) -> Column:
    """The first non-empty of four instructor list locations, fields under their aliases."""
    arr_t = T.ArrayType(INSTRUCTOR)
    # Where the list of instructors may be
    locs = ["$.instructors.instructors_info", "$.visible_instructors", "$.visibleInstructors", "$.instructors"]
    lists = [F.from_json(F.get_json_object(payload, p), arr_t) for p in locs]
    chosen = F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists], F.array().cast(arr_t))
    return F.transform(chosen, lambda i: F.struct(
        i["id"].alias("instructor_id"),
        _nz(i["display_name"], i["title"]).alias("name"),
        i["job_title"].alias("job_title"),
        _nz(i["total_num_students"], i["num_students"]).alias("num_students"),
        _nz(i["avg_rating_recent"], i["rating"]).alias("avg_rating_score"),
        _nz(i["total_num_taught_courses"], i["num_published_courses"]).alias("num_of_courses"),
        _nz(i["total_num_reviews"], i["num_reviews"]).alias("total_num_reviews")))


def _digits(text: Column) -> Column:
    num = F.regexp_extract(text, r"([\d,\.]+)", 1)
    return F.when(num != "", F.translate(num, ",.", "")).try_cast("bigint")


def counts_of_parts() -> dict[str, Column]:
    """E10 over page parts: students, rating and reviews from the payload, the review data, or page text."""
    payload, reviews = F.col("__payload"), F.col("__review_data")

    def number(text, path, dtype):
        return F.get_json_object(text, path).try_cast(dtype)

    return {
        "num_students": F.coalesce(_nz(number(payload, "$.numStudents", "bigint"), number(payload, "$.num_students", "bigint")),
                                   _digits(F.col("__students"))),
        "avg_rating_score": F.coalesce(_nz(number(payload, "$.rating", "double"), number(reviews, "$.averageRating", "double")),
                                       _found(F.col("__rating"), r"([\d\.]+)").try_cast("double")),
        "num_reviews": F.coalesce(_nz(number(payload, "$.numReviews", "bigint"), number(payload, "$.num_reviews", "bigint"),
                                      number(reviews, "$.numberOfReviews", "bigint")), _digits(F.col("__reviews"))),
    }


def iso_duration_seconds(text: Column) -> Column:
    """``PT#H#M#S`` -> seconds (missing parts are 0; other text, or more than fits a BIGINT -> NULL)."""
    def part(unit, seconds):
        v = F.regexp_extract(text, r"(\d+)" + unit, 1)
        return F.when(v == "", F.lit(0).cast("bigint")).otherwise(F.try_multiply(v.try_cast("bigint"), F.lit(seconds).cast("bigint")))
    return F.when(text.startswith("PT"), F.try_add(F.try_add(part("H", 3600), part("M", 60)), part("S", 1)))


# --------------------------------------------------------------------------- records

def course_records(pages: DataFrame, category_col: str = "category",
                   stamp: Column | None = None, site: Site = SITE) -> DataFrame:
    """Full nested course record (course_data + instructors) per page with a payload."""
    parts = with_page_parts(pages, site, payload_only=True)
    parts = parts.withColumn("__cands", price_candidates_of_parts())
    payload, reviews = F.col("__payload"), F.col("__review_data")
    list_p, sale_p = list_and_sale_price(F.col("__cands"))
    counts = counts_of_parts()
    dur = F.coalesce(_nz(F.get_json_object(payload, "$.contentLengthVideo").try_cast("double"),
                         F.get_json_object(payload, "$.content_length_video").try_cast("double")),
                     iso_duration_seconds(F.get_json_object(payload, "$.estimatedContentLength_text"))
                     .cast("double"))
    stamp = stamp if stamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm")
    course = F.struct(
        parts_course_id().alias("course_id"), parts_title().alias("title"),
        F.get_json_object(payload, "$.headline").alias("headline"),
        F.get_json_object(payload, "$.localeSimpleEnglishTitle").alias("language"),
        F.coalesce(_json(payload, "$.instructionalLevel"),
                   F.get_json_object(payload, "$.instructional_level_simple")).alias("level"),
        dur.alias("course_duration_seconds"),
        F.coalesce(_json(payload, "$.publishedDate"), _json(payload, "$.published_time"),
                   F.get_json_object(payload, "$.lastUpdateDate")).alias("publishes_date"),
        F.coalesce(_json(payload, "$.lastUpdateDate"),
                   F.get_json_object(payload, "$.last_update_date")).alias("lasted_updated_date"),
        list_p.alias("original_price"), sale_p.alias("discount_price"),
        counts["num_students"].cast("double").alias("num_students"),
        counts["num_reviews"].cast("double").alias("num_reviews"),
        counts["avg_rating_score"].alias("avg_rating_score"),
        rating_dist_json(F.get_json_object(reviews, "$.ratingDistribution")).alias("rating_distribution"),
        F.col("url").alias("_url"),
        (F.col(category_col) if category_col in pages.columns else F.lit(None).cast("string")).alias("_category"),
        stamp.alias("_scraped_datetime"),
    )
    return parts.select("page_id", course.alias("course_data"), instructors_of(payload).alias("instructors"))


def price_records(pages: DataFrame, site: Site = SITE) -> DataFrame:
    """Price-only record (id, title, list and sale price) per page with an id.

    The body's id attribute comes first (its title is the title tag, N/A
    without one), then the ``courseId`` text, then the body payload or the
    next-data course.
    """
    parts = with_page_parts(pages, site).withColumn("__cands", price_candidates_of_parts())
    list_p, sale_p = list_and_sale_price(F.col("__cands"))
    module, clp = F.col("__module"), F.col("__clp_id")
    next_course = F.col("__next_course")
    cid = F.coalesce(clp, F.col("__cid_text"), _json(module, "$.course_id"), _json(next_course, "$.id"))
    title = F.when(clp.isNotNull(), F.coalesce(F.nullif(F.col("__title_dom"), F.lit("")), F.lit("N/A"))).otherwise(
        F.coalesce(F.nullif(F.col("__title_tag"), F.lit("")), _json(module, "$.title"), _json(next_course, "$.title"), F.col("__title_tag")))
    out = parts.select("page_id", cid.alias("course_id"), title.alias("title"),
                       list_p.alias("original_price"), sale_p.alias("discount_price"), "__row")
    return _above(out, F.col("course_id").isNotNull()).drop("__row")


def rating_dist_json(dist: Column) -> Column:
    """JSON text of a non-empty distribution list (given as JSON text), else NULL."""
    return F.when(F.coalesce(F.json_array_length(dist), F.lit(0)) > 0, dist)


def rating_dist_from_array(arr: Column) -> Column:
    """E14 for an array column: ``to_json`` when non-empty."""
    return F.when(F.size(arr) > 0, F.to_json(arr))


def merge_price_lookup(records: DataFrame, lookup: DataFrame, key: str = "course_id") -> DataFrame:
    """Fill prices from a second source when missing or equal.

    ``lookup`` holds one row per course: list_amount, discount_amount,
    current_amount.  Applied only when the record's prices are missing or
    the same: list <- list_amount else current_amount; sale <- discount_amount,
    else current_amount.
    """
    j = records.join(lookup, key, "left")
    need = (F.col("original_price").isNull() | F.col("discount_price").isNull()
            | (F.col("original_price") == F.col("discount_price")))
    new_list = F.coalesce(F.col("list_amount"), F.col("current_amount"), F.col("original_price"))
    new_sale = F.coalesce(F.col("discount_amount"), F.col("current_amount"), F.col("discount_price"))
    return (j.withColumns({"original_price": F.when(need, new_list).otherwise(F.col("original_price")),
                           "discount_price": F.when(need, new_sale).otherwise(F.col("discount_price"))})
             .drop("list_amount", "discount_amount", "current_amount"))


def merge_instructor_lookup(records: DataFrame, lookup: DataFrame, key: str = "course_id",
                            col: str = "instructors") -> DataFrame:
    """Replace a record's instructor list when the lookup has a non-empty one."""
    lk = lookup.select(key, F.col(col).alias("__lk"))
    j = records.join(lk, key, "left")
    return j.withColumn(col, F.when(F.size(F.col("__lk")) > 0, F.col("__lk")).otherwise(F.col(col))).drop("__lk")


# --------------------------------------------------------------------------- category groups

# Crawl categories and the group each belongs to.
CATEGORY_GROUPS = {
    "group1": ["Web Development", "Software Engineering"],
    "group2": ["Programming Languages", "Database Design & Development", "Software Testing",
               "No-Code Development"],
    "group3": ["Data Science", "Mobile Development", "Game Development", "Software Development Tools"],
}


def category_group(category: Column, groups: dict[str, list[str]] = CATEGORY_GROUPS) -> Column:
    """Literal lookup category -> group (NULL when unknown)."""
    pairs = []
    for g, cats in groups.items():
        for c in cats:
            pairs += [F.lit(c), F.lit(g)]
    return F.try_element_at(F.create_map(*pairs), category)
