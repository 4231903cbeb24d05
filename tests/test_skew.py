"""Keys and values of which a few hold most rows: balanced ranges, numbering, lag and lookups."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from coursewise.operators import serving, skew
from coursewise.operators.common import sequential_ids
from coursewise.plans import registry
from coursewise.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_values_with_a_common_prefix_are_numbered_by_many_tasks(spark):
    n = 100_000
    values = spark.range(n).select(F.format_string("https://courses.example/c/%08d", F.col("id") * 7).alias("name"))
    sizes = [r["count"] for r in skew.with_range(values, ["name"], "part").groupBy("part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 0.5 * n  # four ranges a shuffle partition
    ids = sequential_ids(values, "name", "id")
    assert ids.filter(F.col("id") != F.substring("name", -8, 8).cast("long") / 7 + 1).count() == 0 and ids.count() == n


def test_ranges_are_in_order_with_nulls_first(spark):
    rows = spark.createDataFrame([(k % 7 if k % 5 else None, k if k % 3 else None) for k in range(500)], "a int, b int")
    got = skew.with_range(rows, ["a", "b"], "part", 9)
    spans = got.groupBy("part").agg(F.min(F.struct("a", "b")).alias("lo"), F.max(F.struct("a", "b")).alias("hi")).orderBy("part").collect()
    flat = [tuple((v is not None, v) for v in x) for r in spans for x in (r["lo"], r["hi"])]
    assert flat == sorted(flat) and len(spans) > 3
    assert all(x["hi"] != y["lo"] for x, y in zip(spans, spans[1:]))  # equal rows share a range


@pytest.mark.parametrize("ranges", [2, 3, 64])
def test_lag_of_a_hot_key_over_many_ranges(spark, ranges):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100).alias("k"),
                                    (F.col("id") * 7919 % 6007).alias("t"), F.when(F.col("id") % 13 > 0, F.col("id")).alias("v"))
    want = rows.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    got = skew.lag_in_range(rows, ["k"], "t", "v", "prev", ranges)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 6000
    if ranges == 64:  # a hot month of a hot course is no task of its own
        hot = skew.with_range(rows, ["k", "t"], "part", ranges).filter("k = 7").groupBy("part").count().collect()
        assert len(hot) > 10 and max(r["count"] for r in hot) < 600
    assert skew.lag_in_range(rows.limit(0), ["k"], "t", "v", "prev").count() == 0


def test_a_course_with_a_third_of_the_rows_is_dealt_out(spark, no_broadcast):
    n = 30_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(0, n, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.createDataFrame([(7, -1)], "k bigint, v bigint"))
    for how in ("left", "inner"):
        got = skew.lookup_join(rows, lookup, "k", how)
        assert got.exceptAll(rows.join(lookup, "k", how)).count() == 0 and got.count() == rows.join(lookup, "k", how).count()
    joined = skew.lookup_join(rows, lookup, "k")
    parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    plain = [r["count"] for r in rows.join(lookup, "k", "left").groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) == 4 and max(parts) < 0.3 * n < 0.33 * n < max(plain)
    assert skew.lookup_join(rows.limit(0), lookup, "k").count() == 0 and skew.lookup_join(rows, lookup.limit(0), "k").filter("v IS NOT NULL").count() == 0


@pytest.mark.parametrize("name", ["g2_price_history_enriched", "g22_price_type", "g23_tracker_category", "g24_drop_only", "g30_chart_series", "g31_lowest_points"])
def test_history_rows_meet_one_join(spark, no_broadcast, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "==" not in line]
    assert "__salt" in joins[0] and sum("__salt" in line for line in joins) == 1  # on top of all, and the only one of rows


def test_tracker_and_separate_lookups_agree(spark):
    w = Warehouse(spark, SF)
    history = serving.price_history_with_category(w.fct_price_history, w.stg_courses)
    tracker = w.price_tracker
    dims = serving.price_history_enriched(w.fct_price_history, w.dim_course.select("course_id", "category_id"), w.dim_category)
    for a, b in ((history, w.price_history), (serving.chart_series(history), serving.chart_series(tracker)), (dims, history),
                 (serving.drop_only(history, w.titled_prices), serving.tracker_drop_only(w.prices, w.course_category))):
        rows = [sorted(map(tuple, x.select(*history.columns).collect()), key=repr) for x in (a, b)]
        assert rows[0] == rows[1] and rows[0]
