"""File routing and the load ledger.

The ledger is a small table of (filename, loaded_at, row_count, status); the
loader (``streaming.incremental``) takes from it which files are still to load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Routing rules on the lower-cased object name, checked in this order.
ROUTES = [
    ("instructors", r"_instructors\.parquet"),
    ("price_tracker", r"tracker[^/]*_courses\.parquet"),
    ("courses", r"_courses\.parquet"),
]


def route_of(path: Column) -> Column:
    """Target table of a file path (NULL = not loaded).

    A rule matches the name of the file itself or of the dataset folder that
    holds it (``x_courses.parquet/part-0.parquet``).
    """
    p = F.lower(path)
    expr = None
    for target, pat in ROUTES:
        cond = p.rlike(r"(^|/)[^/]*" + pat + r"(/|$)")
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    return expr.otherwise(F.lit(None).cast("string"))


def route_by_filename(df: DataFrame, path_col: str = "_source_file") -> DataFrame:
    """Add the ``target`` table of each row from its source file."""
    return df.withColumn("target", route_of(F.col(path_col)))


def pending_files(listing: DataFrame, ledger: DataFrame, key: str = "filename") -> DataFrame:
    """Listed files without a SUCCESS record (FAILED ones are retried)."""
    done = ledger.filter(F.col("status") == "SUCCESS").select(key)
    return listing.join(done, key, "left_anti")


def upsert_ledger(ledger: DataFrame, updates: DataFrame | None = None, key: str = "filename",
                  order: list[Column] | None = None) -> DataFrame:
    """Insert-or-replace by file name: the newest record per file wins."""
    allrows = ledger if updates is None else ledger.unionByName(updates, allowMissingColumns=True)
    order = order or [F.col("loaded_at").desc_nulls_last()]
    w = Window.partitionBy(key).orderBy(*order)
    return allrows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def append_raw(df: DataFrame, path: str) -> str:
    """Create-if-absent + append; readers union files by name (``mergeSchema``)."""
    df.write.mode("append").parquet(path)
    return path


def read_raw(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def load_report(ledger: DataFrame) -> DataFrame:
    """Files, rows and time span per status."""
    rows = F.sum("row_count") if "row_count" in ledger.columns else F.lit(None).cast("bigint")
    return (ledger.groupBy("status")
                  .agg(F.count(F.lit(1)).alias("n_files"), rows.alias("n_rows"),
                       F.min("loaded_at").alias("first_loaded"), F.max("loaded_at").alias("last_loaded")))
