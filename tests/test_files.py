"""CSV dialect, reports, swapped tables and pruned gold."""

import pytest
from pyspark.sql import functions as F

from coursewise.plans.warehouse import Warehouse
from coursewise.session import work_dir
from coursewise.sources import files

SF = "/root/testdata/sf0.001"


def test_csv_keeps_awkward_text(spark):
    rows = [(1, 'say "hi", ok'), (2, "two\nlines"), (3, "  spaces  "), (4, ""), (5, None), (6, 'a,b,"",c\\'), (7, "\r\nx")]
    df = spark.createDataFrame(rows, "k int, t string")
    path = files.write_csv(df, work_dir(spark, "test-csv"))
    got = sorted((r.k, r.t) for r in files.read_csv(spark, path, df.schema).collect())
    assert got[:6] == [(k, t or None) for k, t in rows[:6]]  # an empty text reads as NULL, as data frames do
    assert got[6][1].replace("\r\n", "\n") == "\nx"
    report = files.export_csv(spark, {"t": df, "bad": df.select(F.array("k").alias("a"))}, work_dir(spark, "test-export")).collect()
    assert {r.table_name: r.row_count for r in report} == {"t": 7, "bad": None}
    assert [bool(r.error) for r in sorted(report, key=lambda r: r.table_name)] == [True, False]


@pytest.mark.parametrize("size", [200, 3000, 1 << 27])
def test_one_csv_file_is_read_by_several_tasks(spark, size):
    long = "line one\nline, two \"quoted\"\n\n" * 40  # a value longer than a block
    rows = [(k, [f"plain {k}", 'say "hi", ok', "two\nlines", "", None, long, "\n", '"', "a\rb", "  x  ", "é\n🙂"][k % 11], k * 1.5) for k in range(400)]
    df = spark.createDataFrame(rows, "k int, `a text` string, v double")
    path = files.write_csv(df.coalesce(1), work_dir(spark, "test-split"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        want = sorted(map(tuple, files.read_csv(spark, path, df.schema).collect()))
        assert sorted(map(tuple, files.read_csv_split(spark, path, df.schema).collect())) == want and len(want) == 400
        assert spark.read.text(path).rdd.getNumPartitions() > 20 or size > 200
        bare = files.write_csv(df.coalesce(1), work_dir(spark, "test-split"), header=False)
        assert files.read_csv_split(spark, bare, df.schema, header=False).count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_missing_csv_is_reported_and_the_rest_converted(spark):
    root = work_dir(spark, "test-convert")
    df = spark.createDataFrame([(1, "a\nb")], "k int, t string")
    files.write_csv(df, f"{root}/there")
    rep = files.csv_to_parquet(spark, {f"{root}/p0": (f"{root}/none", df.schema), f"{root}/p1": (f"{root}/there", df.schema)}).collect()
    assert {r.target.split("/")[-1]: r.row_count for r in rep} == {"p0": None, "p1": 1}
    assert spark.read.parquet(f"{root}/p1").first().t == "a\nb"


def test_failed_rebuild_leaves_the_old_table(spark):
    path = f"{work_dir(spark, 'test-publish')}/t"
    files.materialize(spark.range(5), path, "table")
    with pytest.raises(Exception):
        files.materialize(spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), path, "table")
    assert files.read_table(spark, path).count() == 5
    files.materialize(files.read_table(spark, path).filter("id > 1"), path, "table")  # rebuilt from itself
    assert sorted(r.id for r in files.read_table(spark, path).collect()) == [2, 3, 4]


@pytest.mark.parametrize("step, left", [("_mark", 5), ("delete_files", 7)])
def test_a_crash_at_any_step_leaves_the_old_or_the_new_version(spark, monkeypatch, step, left):
    path = f"{work_dir(spark, 'test-crash')}/t"
    for n in (3, 5):
        files.publish(spark.range(n), path)

    def stop(*_):
        raise OSError("crash")

    with monkeypatch.context() as m:
        m.setattr(files, step, stop)
        with pytest.raises(OSError):
            files.publish(spark.range(7), path)
    assert files.read_table(spark, path).count() == left
    files.publish(spark.range(8), path)
    assert files.read_table(spark, path).count() == 8


def test_a_store_that_refuses_renames_is_no_matter(spark):
    """Folders that cannot be renamed into: publishing only ever makes new files and folders."""
    path = f"{work_dir(spark, 'test-rename')}/t"
    files.publish(spark.range(4), path)
    before = files.resolve(spark, path)
    reader = spark.read.parquet(before)  # at work while the table is rebuilt
    files.publish(spark.range(6), path)
    assert files.resolve(spark, path) != before
    assert reader.count() == 4 and files.read_table(spark, path).count() == 6
    files.publish(spark.range(2), path)
    assert len(files._versions(spark, path, "data")) == len(files._versions(spark, path, "current")) == 2


def test_a_table_that_was_never_published_is_not_there(spark):
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, f"{work_dir(spark, 'test-none')}/t")


def test_history_is_pruned_by_month(spark):
    out = Warehouse(spark, SF).build(work_dir(spark, "test-gold"), ("fct_price_history",))
    gold = spark.read.parquet(out["fct_price_history"])
    one = gold.filter(F.col("recorded_month") == "1995-03")
    assert 0 < one.count() < gold.count()
    assert one.filter(F.date_format("recorded_at", "yyyy-MM") != "1995-03").count() == 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recorded_month" in plan
