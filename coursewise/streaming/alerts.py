"""Price-alert feed over newly landed price batches.

The reference's manual "send mail" button becomes a table sink.  Files come in
through the loader (S10), so a damaged one is recorded and tried again while
the others go on; the feed is a stream over the loader's ledger, one load a
micro-batch.  The alert rules only need, per course: the latest observation,
the two newest positive prices and the minimum positive price.

* ``<out>/state/n=<n>`` holds the new state of the courses that batch ``n``
  touched and of no others, dealt out in buckets of courses: a batch reads the
  buckets of its courses and writes a row a course.  Every ``FULL_EVERY``
  batches the state is written whole, and what is older goes.
* ``<out>/alerts/batch_id=<n>`` holds the alerts of the courses it touched.
* ``<out>/applied/batch_id=<n>`` names the load, and is written last: a batch
  counts from then on.

Which loads are applied decides what is done, not the stream's checkpoint: a
batch that is replayed, or a feed that goes on with a new checkpoint, finds its
loads applied and its state as it was.  An observation of a (course, time)
already seen in an earlier batch counts as a new observation; within a batch,
duplicates are removed as in staging.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursewise.functions.prices import discount_percentage
from coursewise.operators import serving, staging
from coursewise.operators.common import best_row, top_n_per_key
from coursewise.session import work_dir
from coursewise.sources.files import delete_files
from coursewise.streaming import incremental

STATE_COLUMNS = ["course_id", "title", "course_url", "latest_at", "latest_sale", "latest_list",
                 "p1_at", "p1_price", "p2_at", "p2_price", "min_pos"]


#: Folders that courses are dealt out to, and batches after which the state is written whole.
BUCKETS, FULL_EVERY = 64, 20
TABLE = "price_tracker"


def _bucket():
    return F.pmod(F.xxhash64("course_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def merge_state(state: DataFrame | None, obs: DataFrame) -> DataFrame:
    """New per-course state from the old state and a batch of price observations.

    ``obs`` has course_id, title, course_url, list_price, sale_price, scraped_at.
    """
    rows = obs.select("course_id", "title", "course_url", F.col("scraped_at").alias("at"),
                      F.col("sale_price").alias("sale"), F.col("list_price").alias("list"))
    if state is not None:
        old_latest = state.select("course_id", "title", "course_url", F.col("latest_at").alias("at"),
                                  F.col("latest_sale").alias("sale"), F.col("latest_list").alias("list"))
        latest_in = rows.unionByName(old_latest)
        old_pos = (state.select("course_id", F.col("p1_at").alias("at"), F.col("p1_price").alias("sale"))
                   .unionByName(state.select("course_id", F.col("p2_at").alias("at"),
                                             F.col("p2_price").alias("sale")))
                   .filter(F.col("sale").isNotNull()))
        pos_in = rows.select("course_id", "at", "sale").filter(F.col("sale") > 0).unionByName(old_pos)
        mins_in = (rows.filter(F.col("sale") > 0).select("course_id", F.col("sale").alias("m"))
                   .unionByName(state.select("course_id", F.col("min_pos").alias("m"))))
    else:
        latest_in = rows
        pos_in = rows.select("course_id", "at", "sale").filter(F.col("sale") > 0)
        mins_in = rows.filter(F.col("sale") > 0).select("course_id", F.col("sale").alias("m"))
    order = [F.col("at").desc_nulls_last(), F.col("sale").asc_nulls_last()]
    latest = best_row(latest_in, ["course_id"], order).select(
        "course_id", "title", "course_url", F.col("at").alias("latest_at"),
        F.col("sale").alias("latest_sale"), F.col("list").alias("latest_list"))
    top2 = top_n_per_key(pos_in, ["course_id"], order, 2, "rn")
    pos = top2.groupBy("course_id").agg(
        F.max(F.when(F.col("rn") == 1, F.col("at"))).alias("p1_at"),
        F.max(F.when(F.col("rn") == 1, F.col("sale"))).alias("p1_price"),
        F.max(F.when(F.col("rn") == 2, F.col("at"))).alias("p2_at"),
        F.max(F.when(F.col("rn") == 2, F.col("sale"))).alias("p2_price"))
    mins = mins_in.groupBy("course_id").agg(F.min("m").alias("min_pos"))
    return (latest.join(pos, "course_id", "left").join(mins, "course_id", "left").select(*STATE_COLUMNS))


def alerts_from_state(state: DataFrame) -> DataFrame:
    """G27-shaped rows from the state, then reasons, eligibility and flags."""
    cp = state.select(
        "course_id", "title", "course_url", F.lit(None).cast("string").alias("category"),
        F.col("latest_sale").alias("current_price"), F.col("latest_list").alias("list_price"),
        discount_percentage(F.col("latest_list"), F.col("latest_sale")).alias("discount_percentage"),
        F.coalesce((F.col("latest_sale") > 0) & (F.col("latest_sale") <= F.col("min_pos")), F.lit(False))
        .alias("is_lowest_price_ever"),
        F.col("latest_at"), F.col("p2_price").alias("previous_price"))
    return (serving.alert_reasons(cp)
            .join(serving.alert_eligible(cp), "course_id")
            .join(serving.price_alerts(cp).select("course_id", "price_dropped", "all_time_low", "drop_amount"),
                  "course_id", "left")
            .filter("alert_eligible"))


def _applied(spark: SparkSession, out_dir: str) -> DataFrame:
    """(load_id, courses, full, batch_id) of the batches that count; a batch without courses has no state of its own."""
    schema = "load_id string, courses boolean, full boolean, batch_id int"
    try:
        return spark.read.schema(schema).parquet(f"{out_dir}/applied")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _span(spark: SparkSession, out_dir: str) -> tuple[int, list[int], int]:
    """(first, the batches that the current state is made of, next): ``first`` wrote the state whole."""
    done = _applied(spark, out_dir)
    first, last = done.agg(F.coalesce(F.max(F.when(F.col("full"), F.col("batch_id"))), F.lit(0)), F.coalesce(F.max("batch_id"), F.lit(-1))).first()
    parts = done.filter((F.col("batch_id") >= first) & F.col("courses")).select("batch_id").orderBy("batch_id").collect()  # FULL_EVERY at most
    return first, [r["batch_id"] for r in parts], last + 1


def read_state(spark: SparkSession, out_dir: str, buckets: list[int] | None = None) -> DataFrame | None:
    """The newest state of every course, or of the courses in some buckets; None before the first batch."""
    parts = _span(spark, out_dir)[1]
    if not parts:
        return None
    rows = spark.read.option("basePath", f"{out_dir}/state").parquet(*[f"{out_dir}/state/n={n}" for n in parts])
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))  # folders: nothing else is read
    return best_row(rows, ["course_id"], [F.col("n").desc()]).select(*STATE_COLUMNS)


def apply_load(spark: SparkSession, out_dir: str, load_id: str, rows: DataFrame, tie_break: list[str] | None = None) -> None:
    """Bring one load's price rows into the state and write their alerts; a load that was applied is passed over."""
    if not _applied(spark, out_dir).filter(F.col("load_id") == load_id).isEmpty():
        return
    first, parts, n = _span(spark, out_dir)
    # staged once, a course's rows together: all that follows reads them several times and shuffles a few rows a course
    staged = work_dir(spark, "alert-prices")
    staging.stg_price_tracker(rows, tie_break, place=True).filter(F.col("title").isNotNull()).write.parquet(staged)
    obs = spark.read.parquet(staged)
    touched = obs.select("course_id").distinct()
    near = [r["bucket"] for r in touched.select(_bucket()).distinct().collect()]  # at most BUCKETS numbers
    full = bool(near and parts) and n - first >= FULL_EVERY
    if near:
        state = read_state(spark, out_dir, near)
        merged = merge_state(state.join(touched, "course_id", "left_semi") if state is not None else None, obs)
        if full:
            merged = merged.unionByName(read_state(spark, out_dir).join(touched, "course_id", "left_anti"))
        path = f"{out_dir}/state/n={n}"
        # overwritten, if a run died before it could say that the batch counts
        merged.select("*", _bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        new = spark.read.parquet(path).drop("bucket")
        if full:  # a whole state holds other courses too
            new = new.join(touched, "course_id", "left_semi")
        alerts_from_state(new).write.mode("overwrite").parquet(f"{out_dir}/alerts/batch_id={n}")
    done = spark.createDataFrame([(load_id, bool(near), full)], "load_id string, courses boolean, full boolean")
    done.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/applied/batch_id={n}")
    delete_files(spark, [staged, *(f"{out_dir}/state/n={k}" for k in parts if full)])


def run_alert_feed(spark: SparkSession, landing: str, schema: StructType, raw_dir: str, out_dir: str,
                   checkpoint: str, tie_break: list[str] | None = None, max_files: int = incremental.MAX_FILES_PER_BATCH) -> None:
    """Load every new price file below ``landing`` and apply every new load, then stop (availableNow).

    A damaged file gets a FAILED row in the ledger and is tried again by the
    next run; it does not hold back the others.
    """
    incremental.incremental_load(spark, landing, {TABLE: schema}, raw_dir, max_files=max_files)

    def write(batch: DataFrame, _: int) -> None:
        loads = batch.filter((F.col("target") == TABLE) & (F.col("status") == "SUCCESS")).select("load_id").distinct().orderBy("load_id")
        for load in loads.collect():  # a ledger file holds the files of one load
            apply_load(spark, out_dir, load["load_id"], incremental.read_raw_table(spark, raw_dir, TABLE, [load["load_id"]]), tie_break)

    # files that a compaction has replaced are missing, but their rows are in the new one
    ledger = spark.readStream.schema(incremental.LEDGER_SCHEMA).option("maxFilesPerTrigger", "1").option("ignoreMissingFiles", "true").parquet(incremental.ledger_path(raw_dir))
    query = ledger.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_alerts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The alerts of the batches that count."""
    done = _applied(spark, out_dir).select("batch_id").distinct()
    return spark.read.parquet(f"{out_dir}/alerts").join(done, "batch_id", "left_semi")
