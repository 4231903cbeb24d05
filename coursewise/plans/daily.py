"""The daily run: landed files -> raw tables -> silver -> gold -> checks -> exports.

The reference chains scrape, load, transform and test as scheduled shell
steps.  Here the same chain is a handful of Spark calls on one session; any
scheduler can call ``run_daily`` once per day.  Every step is incremental or
idempotent: the loader takes only files without a successful load (ledger), gold is
rebuilt by overwrite from silver written once, and checks and exports are
plain jobs over the built tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from coursewise.operators import quality
from coursewise.plans.warehouse import Warehouse
from coursewise.sources import files
from coursewise.sources.ledger import load_report, upsert_ledger
from coursewise.streaming import incremental


def run_daily(spark: SparkSession, landing: str, root: str, schemas: dict[str, StructType],
              export: bool = False, run_id: str | None = None) -> dict[str, object]:
    """Load new files, rebuild the marts and run the data-quality checks.

    ``schemas`` gives the bronze schema of each raw table present
    (``courses``, ``instructors``, ``price_tracker``).  Returns the written
    paths, the check results (DataFrames of offending keys; empty is good), the
    files not loaded and the load report; ``export`` writes raw tables and marts as CSV.
    """
    raw_dir = f"{root}/raw"
    incremental.incremental_load(spark, landing, schemas, raw_dir, run_id)
    unloaded = incremental.unloaded_files(spark, landing, raw_dir)
    raw = {t: incremental.read_raw_table(spark, raw_dir, t) for t in schemas}
    w = Warehouse(spark, "", courses=raw.get("courses"), instructors=raw.get("instructors"),
                  offers=raw.get("price_tracker"))
    marts = [m for m in Warehouse.MARTS if Warehouse.NEEDS[m] in _silver_available(raw)]
    paths = w.build(f"{root}/gold", tuple(marts))
    gold = {m: spark.read.parquet(paths[m]) for m in marts}
    checks = _checks(gold)
    report = load_report(upsert_ledger(incremental.read_ledger(spark, raw_dir)))
    out: dict[str, object] = {"paths": paths, "checks": checks, "unloaded": unloaded, "report": report}
    if export:
        out["export"] = files.export_csv(spark, {f"raw_{t}": df for t, df in raw.items()} | gold, f"{root}/export")
    return out


def _silver_available(raw: dict[str, DataFrame]) -> set[str]:
    names = {"courses": "stg_courses", "instructors": "stg_instructors", "price_tracker": "stg_price_tracker"}
    return {names[t] for t in raw}


def _checks(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The promised tests: unique keys, required columns, relationships (V1-V3)."""
    out: dict[str, DataFrame] = {}
    keys = {"dim_course": ["course_id"], "dim_instructor": ["instructor_id"], "dim_category": ["category_id"],
            "fct_course_snapshot": ["course_id"], "fct_price_history": ["history_id"],
            "bridge_course_instructors": ["course_id", "instructor_id"]}
    for table, cols in keys.items():
        if table in gold:
            out[f"unique_{table}"] = quality.check_unique(gold[table], cols)
            out[f"not_null_{table}"] = quality.check_not_null(gold[table], cols).filter("null_count > 0")
    if "fct_course_snapshot" in gold and "dim_course" in gold:
        out["snapshot_course_exists"] = quality.check_relationship(
            gold["fct_course_snapshot"], gold["dim_course"], "course_id")
    if "bridge_course_instructors" in gold and "dim_instructor" in gold:
        out["bridge_instructor_exists"] = quality.check_relationship(
            gold["bridge_course_instructors"], gold["dim_instructor"], "instructor_id")
    return out
