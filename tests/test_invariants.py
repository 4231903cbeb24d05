"""Invariants of the model graph on the smallest driver tables."""

from pyspark.sql import functions as F

from coursewise.operators import serving
from coursewise.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def test_one_row_per_key_after_dedupe(spark):
    w = Warehouse(spark, SF)
    s = w.stg_courses
    assert s.count() == s.select("course_id", "scraped_at").distinct().count()
    assert w.dim_course.count() == w.dim_course.select("course_id").distinct().count()


def test_dim_ids_are_dense(spark):
    w = Warehouse(spark, SF)
    for dim, idc in ((w.dim_category, "category_id"), (w.dim_language, "language_id"), (w.dim_level, "level_id")):
        ids = sorted(r[0] for r in dim.select(idc).collect())
        assert ids == list(range(1, len(ids) + 1))


def test_spine_covers_bounds(spark):
    w = Warehouse(spark, SF)
    b = w.stg_courses.agg(F.min(F.least("published_date", "last_updated_date", F.to_date("scraped_at"))).alias("a"),
                          F.max(F.greatest("published_date", "last_updated_date",
                                           F.to_date("scraped_at"))).alias("b")).collect()[0]
    assert w.dim_date.count() == (b.b - b.a).days + 1


def test_every_positive_course_has_a_low(spark):
    w = Warehouse(spark, SF)
    f = w.fct_price_history
    pos = f.filter("sale_price > 0").select("course_id").distinct().count()
    low = f.filter("is_lowest_price_ever").select("course_id").distinct().count()
    assert pos == low


def test_tiers_add_up_and_filters_are_subsets(spark):
    w = Warehouse(spark, SF)
    pc = w.per_course
    n = pc.count()
    assert sum(r.course_count for r in serving.courses_by_price_tier(pc).collect()) == n
    for kw in ({"category": "Brand#13"}, {"rating_tier": "Good (4 - 5)"}, {"price_tier": "Free"}):
        sub = serving.apply_filters(pc, **kw)
        assert sub.join(pc, "course_id", "left_anti").count() == 0


def test_share_sums_to_100(spark):
    w = Warehouse(spark, SF)
    s = serving.share_of_total(serving.courses_by_level(w.per_course)).agg(F.sum("share_pct")).collect()[0][0]
    assert abs(float(s) - 100) < 0.5


def test_build_reads_materialized_silver(spark):
    from coursewise.session import work_dir
    w = Warehouse(spark, SF)
    out = w.build(work_dir(spark, "test-build"))
    assert set(Warehouse.MARTS) <= set(out) and "stg_courses" in out
    snap = spark.read.parquet(out["fct_course_snapshot"])
    assert snap.count() == w.fct_course_snapshot.count()
    assert spark.read.parquet(out["dim_category"]).count() == w.dim_category.count()


def test_history_category_paths_agree(spark):
    w = Warehouse(spark, SF)
    a, b = w.price_history, w.price_history_via_dims
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sequential_ids_are_in_byte_order(spark):
    from coursewise.operators.common import sequential_ids
    names = [f"v{k:04}" for k in range(3000)] + ["", "a", "b", "ab", "é", "É", "z" * 40, "日本", "🙂"]
    vals = spark.createDataFrame([(n,) for n in names], "name string")
    rows = sorted((r.id, r.name) for r in sequential_ids(vals, "name", "id").collect())
    assert rows == list(enumerate(sorted(names, key=str.encode), 1))
    kinds = vals.withColumn("kind", F.length("name") % 2)
    got = {(r.kind, r.name): r.id for r in sequential_ids(kinds, "name", "id", ["kind"]).collect()}
    for kind in (0, 1):
        own = sorted((n for n in names if len(n) % 2 == kind), key=str.encode)
        assert [got[kind, n] for n in own] == list(range(1, len(own) + 1))


def test_building_marts_runs_no_jobs(spark):
    """Dimensions and the snapshot are lazy: nothing runs or stays cached while they are put together."""
    w = Warehouse(spark, SF)
    assert w.stg_courses.columns and w.stg_instructors.columns  # reading the tables' schemas takes jobs of its own
    tracker, group = spark.sparkContext.statusTracker(), "building-marts"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for name in ("dim_category", "dim_language", "dim_level", "dim_course", "dim_date", "dim_instructor", "fct_course_snapshot"):
            getattr(w, name)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_hot_course_is_limited_before_the_shuffle(spark):
    """A third of the prices belong to one course: the top-2 limit has a shuffle between its halves, no join below."""
    from coursewise.operators import serving
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("course_id"), F.lit("t").alias("title"), F.lit("u").alias("course_url"),
        F.lit(9).cast("decimal(18,2)").alias("list_price"), (F.col("id") % 50).cast("decimal(18,2)").alias("sale_price"),
        F.timestamp_seconds(F.col("id")).alias("recorded_at"))
    cats = spark.range(1).select(F.lit(7).cast("bigint").alias("course_id"), F.lit("c").alias("category"))
    got = serving.current_and_previous_price(base, cats)
    hot = got.filter("course_id = 7").first()
    assert (hot.current_price, hot.previous_price, hot.category) == (47, 44, "c")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") > plan.index("Join")
    assert got.count() == 2000  # the row 7 itself is one of the hot course
