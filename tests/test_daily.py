"""End-to-end daily run over landed fixture files."""

from coursewise.plans import fixtures
from coursewise.plans.daily import run_daily
from coursewise.plans.warehouse import Warehouse
from coursewise.session import work_dir
from coursewise.sources import files

SF = "/root/testdata/sf0.001"
BATCH = "PROD_dashboard_group1_p1-2_20240101_000000"


def test_daily_run_builds_gold_and_checks_pass(spark):
    root = work_dir(spark, "test-daily")
    landing = f"{root}/landing"
    courses = fixtures.fx_courses(spark, SF)
    inst = fixtures.fx_instructors(spark, SF)
    offers = fixtures.fx_offers(spark, SF)
    files.write_parquet(courses, f"{landing}/{BATCH}_courses.parquet")
    files.write_parquet(inst, f"{landing}/{BATCH}_instructors.parquet")
    files.write_parquet(offers, f"{landing}/PROD_tracker_group1_p1-2_20240101_000000_courses.parquet")
    schemas = {"courses": courses.schema, "instructors": inst.schema, "price_tracker": offers.schema}
    out = run_daily(spark, landing, root, schemas, export=True)
    paths, checks = out["paths"], out["checks"]
    assert set(Warehouse.MARTS) <= set(paths)
    for name, df in checks.items():
        assert df.count() == 0, name
    ref = Warehouse(spark, SF)
    assert spark.read.parquet(paths["fct_price_history"]).count() == ref.fct_price_history.count()
    assert spark.read.parquet(paths["dim_course"]).count() == ref.dim_course.count()
    assert out["export"].filter("row_count IS NULL").count() == 0
    counts = {r.table_name: r.row_count for r in out["export"].collect()}
    assert counts["raw_price_tracker"] == offers.count() and counts["raw_courses"] == courses.count()
    assert out["unloaded"].count() == 0  # every landed file loaded
    rep = {r.status: r for r in out["report"].collect()}
    assert set(rep) == {"SUCCESS"}
    assert rep["SUCCESS"].n_rows == courses.count() + inst.count() + offers.count()
    # a second run with no new files rebuilds the same gold
    again = run_daily(spark, landing, root, schemas)
    assert spark.read.parquet(again["paths"]["fct_course_snapshot"]).count() == \
        spark.read.parquet(paths["fct_course_snapshot"]).count()
