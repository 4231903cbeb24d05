"""Incremental loading: each landed file is loaded once; a rerun loads nothing new."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursewise.operators import staging
from coursewise.plans import fixtures
from coursewise.session import work_dir
from coursewise.sources import files, ledger
from coursewise.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_second_run_loads_only_new_files(spark):
    root = work_dir(spark, "test-inc")
    landing, raw = f"{root}/landing", f"{root}/raw"
    offers = fixtures.fx_offers(spark, SF)
    early = F.year("scraped_at") <= 1995
    files.write_parquet(offers.filter(early), f"{landing}/PROD_tracker_g_p1-1_A_courses.parquet")
    schemas = {"price_tracker": offers.schema}
    incremental.incremental_load(spark, landing, schemas, raw)
    n1 = incremental.read_raw_table(spark, raw, "price_tracker").count()
    incremental.incremental_load(spark, landing, schemas, raw)       # idle run
    assert incremental.read_raw_table(spark, raw, "price_tracker").count() == n1
    files.write_parquet(offers.filter(~early), f"{landing}/deep/er/PROD_tracker_g_p1-1_B_courses.parquet")
    incremental.incremental_load(spark, landing, schemas, raw, max_files=1)
    assert incremental.read_raw_table(spark, raw, "price_tracker").count() == offers.count()
    led = incremental.read_ledger(spark, raw)
    assert led.select("filename").distinct().count() == led.count()       # each file once
    assert led.agg(F.sum("row_count")).collect()[0][0] == offers.count()


def _status(spark, raw):
    newest = ledger.upsert_ledger(incremental.read_ledger(spark, raw)).collect()
    return {r["filename"].split("/")[-1]: (r["status"], r["row_count"]) for r in newest}


def test_a_file_is_loaded_whole_or_failed_and_retried(spark):
    root = work_dir(spark, "test-inc-bad")
    landing, raw = f"{root}/landing", f"{root}/raw"
    os.makedirs(f"{landing}/tracker")
    offers = fixtures.fx_offers(spark, SF)
    files.write_parquet(offers.coalesce(1), f"{root}/whole", "snappy")
    whole = glob.glob(f"{root}/whole/part-*.parquet")[0]
    for name in ("a_tracker_courses.parquet", "tracker/B_TRACKER_COURSES.PARQUET", "unrelated_notes.parquet"):
        shutil.copy(whole, f"{landing}/{name}")
    with open(whole, "rb") as f:
        data = bytearray(f.read())
    data[len(data) // 2:len(data) // 2 + 4000] = bytes(4000)  # damaged pages, footer intact
    with open(f"{landing}/c_tracker_courses.parquet", "wb") as f:
        f.write(data)
    with open(f"{landing}/d_tracker_courses.parquet", "wb") as f:
        f.write(b"not a parquet file")
    files.write_parquet(offers.limit(0).coalesce(1), f"{root}/none")
    shutil.copy(glob.glob(f"{root}/none/part-*.parquet")[0], f"{landing}/e_tracker_courses.parquet")
    schemas, n = {"price_tracker": offers.schema}, offers.count()
    for _ in range(2):  # a second run leaves the failed files counted once
        incremental.incremental_load(spark, landing, schemas, raw)
        assert incremental.read_raw_table(spark, raw, "price_tracker").count() == 2 * n
        assert _status(spark, raw) == {
            "a_tracker_courses.parquet": ("SUCCESS", n), "B_TRACKER_COURSES.PARQUET": ("SUCCESS", n),
            "c_tracker_courses.parquet": ("FAILED", 0), "d_tracker_courses.parquet": ("FAILED", 0),
            "e_tracker_courses.parquet": ("SUCCESS", 0)}
        report = {r["status"]: r["n_files"] for r in ledger.load_report(ledger.upsert_ledger(incremental.read_ledger(spark, raw))).collect()}
        assert report == {"SUCCESS": 3, "FAILED": 2}
    left = {r.filename.split("/")[-1] for r in incremental.unloaded_files(spark, landing, raw).collect()}
    assert left == {"c_tracker_courses.parquet", "d_tracker_courses.parquet", "unrelated_notes.parquet"}
    shutil.copy(whole, f"{landing}/c_tracker_courses.parquet")  # repaired
    incremental.incremental_load(spark, landing, schemas, raw)
    assert incremental.read_raw_table(spark, raw, "price_tracker").count() == 3 * n
    assert _status(spark, raw)["c_tracker_courses.parquet"] == ("SUCCESS", n)


def test_a_load_that_the_ledger_does_not_name_does_not_count(spark):
    root = work_dir(spark, "test-replay")
    landing, raw = f"{root}/landing", f"{root}/raw"
    offers = fixtures.fx_offers(spark, SF)
    files.write_parquet(offers, f"{landing}/PROD_tracker_g_p1-1_A_courses.parquet")
    incremental.incremental_load(spark, landing, {"price_tracker": offers.schema}, raw)
    loaded = glob.glob(f"{raw}/price_tracker/*/load_id=*")[0]
    shutil.copytree(loaded, f"{os.path.dirname(loaded)}/load_id=died")
    assert incremental.read_raw_table(spark, raw, "price_tracker").count() == offers.count()


def test_a_file_keeps_its_own_columns_under_normal_names(spark):
    root = work_dir(spark, "test-columns")
    landing, raw = f"{root}/landing", f"{root}/raw"
    schema = T.StructType.fromDDL("course_id bigint, title string, price decimal(18,2)")
    make = spark.createDataFrame
    files.write_parquet(make([(1, "one", 9.5, "x")], "`Course ID` int, ` Title` string, price double, `Extra Col` string").coalesce(1), f"{landing}/a_courses.parquet")
    files.write_parquet(make([("2", "two", 7)], "course_id string, title string, extra_col int").coalesce(1), f"{landing}/b_courses.parquet")
    files.write_parquet(make([("no number", "bad")], "course_id string, title string").coalesce(1), f"{landing}/c_courses.parquet")
    files.write_parquet(make([(4, None, (1, "n"))], "COURSE_ID bigint, title string, nested struct<a:int,b:string>").coalesce(1), f"{landing}/d_courses.parquet")
    files.write_parquet(make([(None, 5, "five")], "`Course ID` bigint, course_id bigint, title string").coalesce(1), f"{landing}/e_courses.parquet")
    incremental.incremental_load(spark, landing, {"courses": schema}, raw)
    got = incremental.read_raw_table(spark, raw, "courses")
    assert got.schema["course_id"].dataType == T.LongType() and got.schema["price"].dataType == T.DecimalType(18, 2)
    rows = {(r.course_id, r.title, None if r.price is None else float(r.price), r.extra_col, r.nested) for r in got.collect()}
    assert rows == {(1, "one", 9.5, "x", None), (2, "two", None, "7", None), (4, None, None, None, '{"a":1,"b":"n"}'), (5, "five", None, None, None)}
    status = {r["filename"].split("/")[-2][0]: r["status"] for r in ledger.upsert_ledger(incremental.read_ledger(spark, raw)).collect()}
    assert status == {"a": "SUCCESS", "b": "SUCCESS", "c": "FAILED", "d": "SUCCESS", "e": "SUCCESS"}
    # the declaration changes: loads of both kinds are read together
    files.write_parquet(make([(6, "six", "12 or so")], "course_id bigint, title string, price string").coalesce(1), f"{landing}/f_courses.parquet")
    incremental.incremental_load(spark, landing, {"courses": T.StructType.fromDDL("course_id bigint, price string")}, raw)
    assert {r.price for r in incremental.read_raw_table(spark, raw, "courses").collect()} == {"9.50", None, "12 or so"}


def test_files_that_agree_are_one_load(spark):
    root = work_dir(spark, "test-one-load")
    landing, raw = f"{root}/landing", f"{root}/raw"
    for k in range(4):
        files.write_parquet(spark.createDataFrame([(k,)], "`Course ID` int").coalesce(1), f"{landing}/{k}_courses.parquet")
    incremental.incremental_load(spark, landing, {"courses": T.StructType.fromDDL("course_id bigint")}, raw)
    led = incremental.read_ledger(spark, raw)
    assert led.count() == 4 and led.select("load_id").distinct().count() == 1


def test_a_write_that_fails_is_no_damaged_file(spark, monkeypatch):
    root = work_dir(spark, "test-write")
    landing, raw = f"{root}/landing", f"{root}/raw"
    for k in range(3):
        files.write_parquet(spark.createDataFrame([(k,)], "course_id int").coalesce(1), f"{landing}/{k}_courses.parquet")
    monkeypatch.setattr(incremental, "_layout_path", lambda raw_dir, table, columns: "nowhere://store/x")
    with pytest.raises(Exception):
        incremental.incremental_load(spark, landing, {"courses": T.StructType.fromDDL("course_id int")}, raw)
    assert incremental.read_ledger(spark, raw).count() == 0
    monkeypatch.undo()
    incremental.incremental_load(spark, landing, {"courses": T.StructType.fromDDL("course_id int")}, raw)
    assert incremental.read_raw_table(spark, raw, "courses").count() == 3


def test_one_listing_a_run_and_a_compacted_ledger(spark, monkeypatch):
    root = work_dir(spark, "test-ledger")
    landing, raw = f"{root}/landing", f"{root}/raw"
    for k in range(6):
        files.write_parquet(spark.createDataFrame([(k,)], "course_id int").coalesce(1), f"{landing}/{k}_courses.parquet")
    _listed = incremental.landed_files
    seen = []
    monkeypatch.setattr(incremental, "landed_files", lambda *a: seen.append(a) or _listed(*a))
    schemas = {"courses": T.StructType.fromDDL("course_id int")}
    incremental.incremental_load(spark, landing, schemas, raw, max_files=1)
    assert len(seen) == 1 and len(incremental.read_ledger(spark, raw).inputFiles()) == 6
    incremental.compact_ledger(spark, raw, max_files=3)
    led = incremental.read_ledger(spark, raw)
    assert led.count() == 6 and len(led.inputFiles()) == 1
    incremental.incremental_load(spark, landing, schemas, raw)
    assert incremental.read_raw_table(spark, raw, "courses").count() == 6


def test_nested_columns_are_loaded_as_json_and_their_counts_survive_staging(spark):
    root = work_dir(spark, "test-nested")
    landing, raw = f"{root}/landing", f"{root}/raw"
    rows = fixtures.fx_courses(spark, SF).withColumn("rating_distribution", F.expr("array(named_struct('rating', 1, 'count', 7), named_struct('rating', 2, 'count', 9))"))
    files.write_parquet(rows, f"{landing}/g_courses.parquet")
    incremental.incremental_load(spark, landing, {"courses": rows.schema}, raw)
    for bronze in (incremental.read_raw_table(spark, raw, "courses"), rows):
        got = staging.stg_courses(bronze, fixtures.FIXTURE_TIE_BREAK)
        assert got.count() > 0 and got.filter("rating_1 <> 7 or rating_2 <> 9 or rating_1 is null").count() == 0
