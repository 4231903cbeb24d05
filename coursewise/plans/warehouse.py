"""The model graph: bronze inputs -> silver -> gold, built lazily per input folder.

``Warehouse`` wires the operators the way the reference's model graph does
(stg_courses feeds four dimensions, the snapshot fact and dim_date;
stg_instructors feeds dim_instructor and the bridge; stg_price_tracker feeds
the price-history fact).  Each property is a lazy DataFrame; ``build`` writes
the gold tables (overwrite = rebuild and swap) below a target folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursewise.operators import marts, serving, staging
from coursewise.plans import fixtures
from coursewise.session import work_dir


class _Later:
    """A frame that is put together when it is first used: a mart that writes its input writes nothing before."""

    def __init__(self, build: Callable[[], DataFrame]):
        self._build = build

    @cached_property
    def _frame(self) -> DataFrame:
        return self._build()

    def __getattr__(self, name: str):
        return getattr(self._frame, name)

    def __getitem__(self, item):
        return self._frame[item]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str,
                 courses: DataFrame | None = None, instructors: DataFrame | None = None,
                 offers: DataFrame | None = None, tie_break: list[str] | None = None,
                 silver: dict[str, DataFrame] | None = None, gold: dict[str, DataFrame] | None = None,
                 cache_silver: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.cache_silver = cache_silver
        self._courses, self._instructors, self._offers = courses, instructors, offers
        self._silver, self._gold = silver or {}, gold or {}
        self.tie_break = tie_break if tie_break is not None else (
            fixtures.FIXTURE_TIE_BREAK if courses is None else None)

    # bronze -------------------------------------------------------------
    @cached_property
    def raw_courses(self) -> DataFrame:
        return self._courses if self._courses is not None else fixtures.fx_courses(self.spark, self.sf_dir, place=True)

    @cached_property
    def raw_instructors(self) -> DataFrame:
        return (self._instructors if self._instructors is not None
                else fixtures.fx_instructors(self.spark, self.sf_dir))

    @cached_property
    def raw_offers(self) -> DataFrame:
        return self._offers if self._offers is not None else fixtures.fx_offers(self.spark, self.sf_dir, place=True)

    # silver -------------------------------------------------------------
    def _silver_frame(self, name: str, build) -> DataFrame:
        """A staging model: the written one when given, else built from bronze.

        ``cache_silver`` persists built silver for sessions that query many
        marts interactively; it is off by default because filling the cache
        costs more than the recomputation it saves for a single query (measured
        at sf0.1).  Full builds write silver instead (``build``).
        """
        if name in self._silver:
            return self._silver[name]
        df = build()
        return df.persist() if self.cache_silver else df

    @cached_property
    def stg_courses(self) -> DataFrame:
        return self._silver_frame("stg_courses", lambda: staging.stg_courses(self.raw_courses, self.tie_break))

    @cached_property
    def stg_instructors(self) -> DataFrame:
        return self._silver_frame("stg_instructors", lambda: staging.stg_instructors(self.raw_instructors))

    @cached_property
    def stg_price_tracker(self) -> DataFrame:
        return self._silver_frame("stg_price_tracker",
                                  lambda: staging.stg_price_tracker(self.raw_offers, self.tie_break))

    @cached_property
    def written_prices(self) -> DataFrame:
        """Silver prices as a table: every mart and question on prices reads them more than once."""
        if "stg_price_tracker" in self._silver:
            return self._silver["stg_price_tracker"]
        path = work_dir(self.spark, "silver-prices")
        self.stg_price_tracker.write.parquet(path)
        return self.spark.read.parquet(path)

    def _written_courses(self, *columns: str) -> DataFrame:
        """Some columns of silver courses as a table, for a mart that reads them more than once."""
        if "stg_courses" in self._silver:
            return self._silver["stg_courses"]
        path = work_dir(self.spark, "silver-courses")
        self.stg_courses.select(*columns).write.parquet(path)
        return self.spark.read.parquet(path)

    # gold ---------------------------------------------------------------
    def _lookup(self, col: str, courses: DataFrame | None = None) -> DataFrame:
        name = f"dim_{col}"
        return self._gold[name] if name in self._gold else marts.lookup_dim(self.stg_courses if courses is None else courses, col)

    @cached_property
    def dim_category(self) -> DataFrame:
        return self._lookup("category")

    @cached_property
    def dim_language(self) -> DataFrame:
        return self._lookup("language")

    @cached_property
    def dim_level(self) -> DataFrame:
        return self._lookup("level")

    @cached_property
    def dim_course(self) -> DataFrame:
        def build() -> DataFrame:
            courses = self._written_courses(*marts.DIM_COURSE_INPUT)
            return marts.dim_course(courses, *(self._lookup(col, courses) for col in ("category", "language", "level")))
        return _Later(build)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.stg_courses)

    @cached_property
    def dim_instructor(self) -> DataFrame:
        return marts.dim_instructor(self.stg_instructors)

    @cached_property
    def bridge_course_instructors(self) -> DataFrame:
        return marts.bridge_course_instructors(self.stg_instructors)

    @cached_property
    def fct_course_snapshot(self) -> DataFrame:
        return marts.fct_course_snapshot(self.stg_courses)

    @cached_property
    def fct_price_history(self) -> DataFrame:
        return marts.fct_price_history(self.written_prices)

    @cached_property
    def prices(self) -> DataFrame:
        """Price rows in the history's names, before its joins."""
        return self.written_prices.withColumnRenamed("scraped_at", "recorded_at")

    @cached_property
    def titled_prices(self) -> DataFrame:
        return self.prices.filter("title IS NOT NULL")

    # serving ------------------------------------------------------------
    @cached_property
    def per_course(self) -> DataFrame:
        return serving.dedupe_course(self.stg_courses, self.stg_instructors)

    @cached_property
    def price_history(self) -> DataFrame:
        """History rows with their course category (the price tracker's base table)."""
        return self.price_tracker.select(*serving.HISTORY_COLUMNS)

    @cached_property
    def price_tracker(self) -> DataFrame:
        """The same with the number of positive prices per course."""
        return serving.price_tracker(self.prices, self.course_category)

    @cached_property
    def course_category(self) -> DataFrame:
        """(course_id, category) of each course's best record."""
        return marts.best_course_record(self.stg_courses).select("course_id", "category")

    @cached_property
    def current_previous(self) -> DataFrame:
        """G27 over the price rows; the category is joined once per course."""
        return serving.current_and_previous_price(self.prices, self.course_category)

    @cached_property
    def price_history_via_dims(self) -> DataFrame:
        """The same rows through the gold dimensions (history -> dim_course -> dim_category).

        Of dim_course only the category id is needed, so only that lookup is joined.
        """
        silver = self._written_courses("course_id", "category", "num_students", "scraped_at")
        categories = self._lookup("category", silver)
        courses = marts.with_lookup_id(marts.best_course_record(silver).select("course_id", "category"), "category", categories)
        names = serving.category_names(courses, categories)
        return serving.price_tracker(self.prices, names).select(*serving.HISTORY_COLUMNS)

    MARTS = ("dim_category", "dim_language", "dim_level", "dim_course", "dim_date", "dim_instructor",
             "bridge_course_instructors", "fct_course_snapshot", "fct_price_history")

    # the staging model each mart is built from
    NEEDS = {"dim_category": "stg_courses", "dim_language": "stg_courses", "dim_level": "stg_courses",
             "dim_course": "stg_courses", "dim_date": "stg_courses", "fct_course_snapshot": "stg_courses",
             "dim_instructor": "stg_instructors", "bridge_course_instructors": "stg_instructors",
             "fct_price_history": "stg_price_tracker"}

    def build(self, target_dir: str, names: tuple[str, ...] = MARTS,
              materialize_silver: bool = True) -> dict[str, str]:
        """Publish a new version of each gold table; return name -> folder of that version.

        ``files.read_table`` finds the newest version below ``target_dir``.  The price history is partitioned by ``recorded_month``.

        With ``materialize_silver`` the three staging models are written first
        and every mart reads them back, so bronze is scanned and de-duplicated
        once per build instead of once per mart; the written silver also cuts
        lineage (a lost executor recomputes from silver, not from bronze).
        """
        from coursewise.sources.files import materialize
        root = target_dir.rstrip("/")
        src = self
        out, gold = {}, {}
        if materialize_silver:
            silver = {}
            for name in sorted({self.NEEDS[m] for m in names}):
                out[name] = materialize(getattr(self, name), f"{root}/silver/{name}", "table")
                silver[name] = self.spark.read.parquet(out[name])
            # dim_course reads the lookups as they were just written
            src = Warehouse(self.spark, self.sf_dir, tie_break=self.tie_break, silver=silver, gold=gold)
        for name in sorted(names, key=lambda n: n == "dim_course"):
            df, months = getattr(src, name), None
            if name == "fct_price_history":  # questions on a span of time read its months only
                df, months = df.withColumn("recorded_month", F.date_format("recorded_at", "yyyy-MM")), ["recorded_month"]
            out[name] = materialize(df, f"{root}/{name}", "table", months)
            gold[name] = self.spark.read.parquet(out[name])
        return out
