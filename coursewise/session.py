"""Spark session defaults and the shared working folder.

The session pins UTC, ANSI mode and adaptive execution (coalescing, skew-join
splitting, runtime broadcast conversion).  Intermediate files (CSV exports,
staged batches, stream checkpoints) go below ``spark.checkpoint.dir``: on a
cluster that setting names a shared folder and is read from the session; only
when it is unset on a local master (tests, benchmarks) do we create one.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # target ~128 MB per post-shuffle partition; AQE coalesces small ones and
    # splits skewed ones (a partition 5x the median and over 256 MB)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "coursewise") -> SparkSession:
    """Build (or reuse) a session with the engine defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Local folders made here, by application: the setting cannot be changed once an application runs.
_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode; that one goes when Python ends."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="coursewise-ckpt-")
            atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
        path = _LOCAL_DIRS[app]
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if "://" not in base:
        base = os.path.abspath(base)
    return f"{base.rstrip('/')}/coursewise/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
