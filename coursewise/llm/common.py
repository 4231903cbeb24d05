"""Helpers shared by the operators: table reads, written intermediate tables, batch slicing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from coursewise.session import work_dir

#: Text handled at once inside a task, in characters.  It bounds a task's memory, not the input.
BLOCK_CHARS = 1 << 19
#: Whole texts that go to a Python worker at once.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark has to understand."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The table cuts the lineage and survives lost executors; a task that is run
    again commits whole files only.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Let batches to Python hold at most ``BATCH_ROWS`` rows from now on in this session.

    Spark's default of 10,000 rows is made for numbers; with texts it takes
    tens of megabytes in the worker, in its copies and beside the heap.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def blocks(texts: Sequence[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive (start, stop) row ranges of about ``limit`` characters; every row is in one range."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
