"""What the course marts shuffle: line items go by order and by part once, texts and further steps by course do not."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from coursewise.operators import marts, serving, skew, staging
from coursewise.plans import fixtures
from coursewise.plans.warehouse import Warehouse
from coursewise.streaming import alerts

DAY = datetime.datetime(1996, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A part with a third of the line items, times that repeat, and keys that are missing, null or there twice."""
    root = str(tmp_path_factory.mktemp("shop"))
    n = 3000
    li = [(None if i % 97 == 0 else i // 4, None if i % 89 == 0 else 7 if i % 3 == 0 else i % 50, i % 23, i % 7 + 1, float(i % 5), float(i % 11 + 1), i % 4 / 10,
           i % 3 / 10, "NAR"[i % 3], "O", None if i % 83 == 0 else DAY + datetime.timedelta(days=i % 40)) for i in range(n)]
    schemas = {
        "lineitem": (li, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "part": ([(None if k == 3 else k, f"name {k}", f"Brand#{k % 5}", f"type {k % 4}", k % 12, 1.0) for k in range(45)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k, "F", 1.0, DAY + datetime.timedelta(days=k % 9), "1") for k in range(700)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "supplier": ([(k, f"Supplier {k}", k % 3, 0.0) for k in [*range(20), 4, 4]], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int")}
    for name, (rows, schema) in schemas.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plain(warehouse):
    """The same warehouse on bronze that lies anywhere, staged by key alone."""
    return Warehouse(warehouse.spark, warehouse.sf_dir, courses=fixtures.fx_courses(warehouse.spark, warehouse.sf_dir),
                     offers=fixtures.fx_offers(warehouse.spark, warehouse.sf_dir), tie_break=fixtures.FIXTURE_TIE_BREAK)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_courses_are_staged_where_their_rows_lie(spark, tables, plan):
    w = Warehouse(spark, tables)
    for df in (marts.best_course_record(w.stg_courses), serving.latest_courses(w.stg_courses), w.stg_price_tracker):
        keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(df))
        assert not any("scraped_at" in k for k in keys) and sum(skew.PLACE in k for k in keys) >= 1
    assert re.search(r"title|p_name", "".join(re.findall(r"Exchange hash.*\n.*", plan(w.stg_courses)))) is None


def test_rows_by_place_are_the_same(spark, tables):
    w = Warehouse(spark, tables)
    p = _plain(w)
    assert _rows(w.stg_courses) == _rows(p.stg_courses) and w.stg_courses.count() > 100 and skew.PLACE not in w.stg_courses.columns
    assert _rows(w.stg_price_tracker) == _rows(p.stg_price_tracker) == _rows(staging.stg_price_tracker(w.raw_offers, w.tie_break, place=True))
    assert _rows(w.dim_course) == _rows(marts.dim_course(p.stg_courses)) and _rows(w.price_history_via_dims) == _rows(w.price_history)


def test_fixture_rows_are_those_of_plain_joins(spark, tables):
    t = {n: spark.read.parquet(f"{tables}/{n}.parquet") for n in ("lineitem", "part", "orders", "supplier", "nation")}
    j = (t["lineitem"].join(t["part"], F.expr("l_partkey = p_partkey")).join(t["orders"], F.expr("l_orderkey = o_orderkey"))
         .join(t["supplier"], F.expr("l_suppkey = s_suppkey")).join(t["nation"], F.expr("s_nationkey = n_nationkey")))
    cols = [F.col("l_partkey").alias("course_id"), F.concat(F.lit(" "), "p_name").alias("title"), F.col("n_name").alias("language"), "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("scraped_at")]
    want = j.select(*cols)
    assert _rows(fixtures.fx_courses(spark, tables).select(want.columns)) == _rows(want) != []


def test_instructors_are_added_up_by_keys(spark, tables, plan):
    t = {n: spark.read.parquet(f"{tables}/{n}.parquet") for n in ("lineitem", "supplier", "nation")}
    j = t["lineitem"].join(t["supplier"], F.expr("l_suppkey = s_suppkey")).join(t["nation"], F.expr("s_nationkey = n_nationkey"))
    want = (j.groupBy("s_suppkey", "s_name", "n_name", "l_partkey").agg(F.sum("l_quantity").alias("n"), (F.avg("l_quantity") / 10).alias("r"))
            .select(F.col("s_suppkey").cast("string"), F.concat(F.lit(" "), "s_name"), "n_name", "l_partkey", "n", "r"))
    got = fixtures.fx_instructors(spark, tables)
    assert _rows(got) == _rows(want) != []
    assert not any("s_name" in k and "l_partkey" in k for k in re.findall(r"Exchange hashpartitioning\((.*?)\)", plan(got)))


def test_marts_that_read_courses_often_read_them_written(spark, tables, plan):
    w = Warehouse(spark, tables)
    assert "lineitem" not in plan(w.dim_course) and "lineitem" not in plan(w.price_history_via_dims)


def test_a_heavy_key_is_dealt_out_and_its_groups_stay_whole(spark):
    n = 30_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"), (F.col("id") % 500).alias("t"))
    at = skew.placed(rows, "k", ["t"]).withColumn("part", F.spark_partition_id())
    assert max(r["count"] for r in at.groupBy("part").count().collect()) < 0.35 * n
    assert at.groupBy("k", "t").agg(F.count_distinct("part").alias("c")).filter("c > 1").count() == 0
    assert at.filter(f"k <> 7 AND {skew.PLACE} <> 0").count() == 0 and at.count() == n


def test_alert_prices_are_staged_once(spark, tables, tmp_path, monkeypatch):
    seen, merge = [], alerts.merge_state
    monkeypatch.setattr(alerts, "merge_state", lambda state, obs: seen.append(obs._jdf.queryExecution().toString()) or merge(state, obs))
    for load in ("a", "b"):
        alerts.apply_load(spark, str(tmp_path), load, fixtures.fx_offers(spark, tables), fixtures.FIXTURE_TIE_BREAK)
    assert len(seen) == 2 and not any("Window" in p or "lineitem" in p for p in seen)
    assert alerts.read_state(spark, str(tmp_path)).count() == Warehouse(spark, tables).titled_prices.select("course_id").distinct().count()
