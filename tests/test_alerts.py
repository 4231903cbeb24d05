"""The stateful alert feed agrees with the batch computation over the whole history."""

import pytest
from pyspark.sql import functions as F

from coursewise.plans import fixtures
from coursewise.plans.warehouse import Warehouse
from coursewise.session import work_dir
from coursewise.sources import files
from coursewise.streaming import alerts, incremental

SF = "/root/testdata/sf0.001"
TIE = ["l_orderkey", "l_linenumber"]


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(alerts, "BUCKETS", 4)


def _feed(spark, root, offers, checkpoint="ckpt"):
    alerts.run_alert_feed(spark, f"{root}/landing", offers.schema, f"{root}/raw", f"{root}/out", f"{root}/{checkpoint}", tie_break=TIE)


def _land(rows, root, tag):
    files.write_parquet(rows.coalesce(1), f"{root}/landing/PROD_tracker_g_p1-1_{tag}_courses.parquet")


@pytest.mark.parametrize("every", [1, 20])
def test_state_matches_batch_history(spark, monkeypatch, every):
    monkeypatch.setattr(alerts, "FULL_EVERY", every)
    root = work_dir(spark, "test-alerts")
    offers = fixtures.fx_offers(spark, SF)
    year = F.coalesce(F.year("scraped_at"), F.lit(0))
    for tag, cond in (("A", year <= 1995), ("B", year == 1996), ("C", year > 1996)):
        _land(offers.filter(cond), root, tag)
        _feed(spark, root, offers)
    streamed = alerts.alerts_from_state(alerts.read_state(spark, f"{root}/out"))
    w = Warehouse(spark, SF)
    from coursewise.operators import serving
    cp = w.current_previous.withColumn("category", F.lit(None).cast("string"))
    batch = (serving.alert_reasons(cp).join(serving.alert_eligible(cp), "course_id")
             .join(serving.price_alerts(cp).select("course_id", "price_dropped", "all_time_low", "drop_amount"),
                   "course_id", "left").filter("alert_eligible"))
    cols = sorted(batch.columns)
    a, b = streamed.select(*cols), batch.select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    folders = {f.split("/state/n=")[1].split("/")[0] for f in spark.read.parquet(f"{root}/out/state").inputFiles()}
    assert folders == ({"2"} if every == 1 else {"0", "1", "2"})


def test_a_batch_writes_a_row_a_course_and_a_new_checkpoint_resets_nothing(spark):
    root = work_dir(spark, "test-delta")
    offers = fixtures.fx_offers(spark, SF)
    _land(offers.filter("title IS NOT NULL"), root, "A")
    _feed(spark, root, offers)
    before = alerts.read_state(spark, f"{root}/out")
    n = before.count()
    ten = [r["course_id"] for r in offers.filter("title IS NOT NULL").select("course_id").distinct().orderBy("course_id").limit(10).collect()]
    _land(offers.filter(F.col("course_id").isin(ten) & F.col("title").isNotNull()).withColumn("scraped_at", F.col("scraped_at") + F.expr("INTERVAL 400 DAYS")), root, "B")
    _feed(spark, root, offers, "another checkpoint")
    assert spark.read.parquet(f"{root}/out/state/n=1").count() == 10
    after = alerts.read_state(spark, f"{root}/out")
    assert after.count() == n
    others = ~F.col("course_id").isin(ten)
    assert after.filter(others).exceptAll(before.filter(others)).count() == 0
    seen = alerts.read_alerts(spark, f"{root}/out").count()
    _feed(spark, root, offers, "a third checkpoint")  # nothing landed: nothing changes
    assert alerts.read_alerts(spark, f"{root}/out").count() == seen > 0 and after.exceptAll(alerts.read_state(spark, f"{root}/out")).count() == 0


def test_a_damaged_file_does_not_hold_back_the_others(spark):
    root = work_dir(spark, "test-damaged")
    offers = fixtures.fx_offers(spark, SF)
    early = F.year("scraped_at") <= 1995
    _land(offers.filter(early), root, "A")
    path = f"{root}/landing/deep/PROD_TRACKER_g_p1-1_B_COURSES.parquet"
    spark.createDataFrame([("not a parquet file",)], "value string").coalesce(1).write.text(f"{root}/text")
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.Path(f"{root}/landing/deep"))
    text = next(f.getPath() for f in fs.listStatus(jvm.Path(f"{root}/text")) if f.getPath().getName().startswith("part-"))
    fs.rename(text, jvm.Path(path))
    _feed(spark, root, offers)
    n = alerts.read_state(spark, f"{root}/out").count()
    assert n > 0
    fs.delete(jvm.Path(path), True)
    files.write_parquet(offers.filter(~early).coalesce(1), path)  # repaired
    _feed(spark, root, offers)
    want = offers.filter("title IS NOT NULL").select("course_id").distinct().count()
    assert n < alerts.read_state(spark, f"{root}/out").count() == want
    status = {r["status"] for r in incremental.read_ledger(spark, f"{root}/raw").collect()}
    assert status == {"FAILED", "SUCCESS"}


def test_a_load_is_applied_once_also_after_a_crash(spark, monkeypatch):
    root = work_dir(spark, "test-replay-alerts")
    offers = fixtures.fx_offers(spark, SF)
    alerts.apply_load(spark, f"{root}/out", "one", offers, TIE)
    n = alerts.read_alerts(spark, f"{root}/out").count()
    alerts.apply_load(spark, f"{root}/out", "one", offers, TIE)
    assert alerts.read_alerts(spark, f"{root}/out").count() == n > 0

    def stop(*_):
        raise OSError("crash")

    with monkeypatch.context() as m:
        m.setattr(alerts, "alerts_from_state", stop)
        with pytest.raises(OSError):
            alerts.apply_load(spark, f"{root}/out", "two", offers.limit(5), TIE)
    before = alerts.read_state(spark, f"{root}/out")
    assert before.count() == offers.filter("title IS NOT NULL").select("course_id").distinct().count()
    alerts.apply_load(spark, f"{root}/out", "three", offers.limit(7), TIE)
    assert [r["load_id"] for r in alerts._applied(spark, f"{root}/out").orderBy("batch_id").collect()] == ["one", "three"]
