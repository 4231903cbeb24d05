"""Incremental loading of landed batch files.

Every run lists the landing tree once, at any depth, routes files by name and
loads those without a SUCCESS row in the ledger.  A file is loaded whole or not
at all: a batch of files is written as one Spark job, a batch that fails is
halved until the damaged files stand alone, and these get a FAILED row and are
tried again by the next run.  (A file-source stream would not do: its
checkpoint never offers a consumed file again.)

Files bring their own columns.  The columns of a batch are read from the
footers in one job; names are normalised (C1) before anything else is done with
them, so ``Course ID`` fills ``course_id``.  Declared columns are cast to their
declared types, and a value that does not fit fails its file.  Columns that
nobody declared are kept as text, so that files that disagree about their types
stay readable together.  Files that disagree about a column before that are
grouped by their own footers.

A batch goes to ``<raw>/<table>/<hash of its columns>/load_id=<hash of its file
names>``, then its ledger rows, which also name its columns, are appended.  Readers only see loads
that the ledger names, so a run that dies between the two leaves nothing behind
that counts, and the next run loads those files anew.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursewise.operators.cleaning import nan_to_null, nested_to_json, reconcile
from coursewise.session import work_dir
from coursewise.sources.files import delete_files
from coursewise.sources.ledger import pending_files, route_of, upsert_ledger

LEDGER_SCHEMA = ("filename string, target string, load_id string, run_id string, row_count int, "
                 "loaded_at timestamp, status string, columns string")
# file names of one batch pass through the driver; the next batch starts when they are recorded
MAX_FILES_PER_BATCH = 1000
# a ledger of more files than this is rewritten as fewer, larger ones, one row a file name
MAX_LEDGER_FILES = 200
SOURCE_FILE = "_source_file"


def ledger_path(raw_dir: str) -> str:
    """Where the ledger of a folder of raw tables is."""
    return f"{raw_dir.rstrip('/')}/loaded_files_log"


def read_ledger(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Every ledger row ever written (S8 reduces them to the newest per file)."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path(raw_dir))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)  # nothing was ever loaded


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Parquet files below ``landing`` at any depth, whatever the case of their names, with their target.

    The listing is Spark's file index (``binaryFile`` without its content
    column, so no file is read).
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    return (listing.select(F.col("_metadata.file_path").alias("filename"), "path")
                   .filter(F.lower("path").endswith(".parquet"))
                   .withColumn("target", route_of(F.col("path"))))


def unloaded_files(spark: SparkSession, landing: str, raw_dir: str) -> DataFrame:
    """Landed files without a successful load: new, FAILED, or without a target."""
    return pending_files(landed_files(spark, landing), read_ledger(spark, raw_dir))


def _record(spark: SparkSession, raw_dir: str, table: str, names: list[str], counts: DataFrame | None,
            load_id: str, run_id: str, columns: str | None = None) -> None:
    rows = spark.createDataFrame([(n,) for n in names], "filename string")
    if counts is None:
        rows = rows.withColumn("n", F.lit(0))
    else:  # an empty file is loaded with 0 rows
        rows = rows.join(counts, "filename", "left")
    (rows.select("filename", F.lit(table).alias("target"), F.lit(load_id).alias("load_id"),
                 F.lit(run_id).alias("run_id"), F.coalesce("n", F.lit(0)).cast("int").alias("row_count"),
                 F.current_timestamp().alias("loaded_at"),
                 F.lit("FAILED" if counts is None else "SUCCESS").alias("status"), F.lit(columns).cast("string").alias("columns"))
         .coalesce(1).write.mode("append").parquet(ledger_path(raw_dir)))


def _layout_path(raw_dir: str, table: str, columns: str) -> str:
    """The folder of all loads with the same columns."""
    return f"{raw_dir.rstrip('/')}/{table}/{hashlib.md5(columns.encode()).hexdigest()}"


def _footer(spark: SparkSession, paths: list[str]) -> StructType:
    """The columns of all files together, read from their footers in one job; fails where files disagree."""
    return spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "false").parquet(*paths).schema


def _by_footer(spark: SparkSession, files: list[tuple[str, str]]) -> tuple[list[tuple[StructType, list]], list]:
    """Files grouped by their columns, and the files whose footer cannot be read.

    Usually the files of a batch agree and are one group, found by one job.
    """
    try:
        return [(_footer(spark, [p for _, p in files]), files)], []
    except (PySparkException, Py4JError):
        pass
    groups: dict[str, tuple[StructType, list]] = {}
    unread = []
    for file in files:
        try:
            schema = _footer(spark, [file[1]])
        except (PySparkException, Py4JError):
            unread.append(file)
            continue
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    return list(groups.values()), unread


def _load(spark: SparkSession, files: list[tuple[str, str]], own: StructType, table: str, schema: StructType, raw_dir: str,
          run_id: str) -> None:
    """Load files (name, path) whose columns are ``own`` as one batch, or halve it until the damaged ones stand alone."""
    names = [n for n, _ in files]
    load_id = hashlib.md5("\n".join(sorted(names)).encode()).hexdigest()
    rows = None
    try:
        read = spark.read.schema(own).option("ignoreCorruptFiles", "false").parquet(*[p for _, p in files])
        read = read.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        rows = nan_to_null(reconcile(nested_to_json(read), schema))
        out = f"{_layout_path(raw_dir, table, rows.schema.json())}/load_id={load_id}"
        rows.write.mode("overwrite").parquet(out)
    except (PySparkException, Py4JError):
        if rows is not None and _readable(rows):
            raise  # the files are sound, so the fault lies where they are written to
        if len(files) == 1:
            _record(spark, raw_dir, table, names, None, load_id, run_id)
            return
        half = len(files) // 2
        _load(spark, files[:half], own, table, schema, raw_dir, run_id)
        _load(spark, files[half:], own, table, schema, raw_dir, run_id)
        return
    counts = spark.read.schema(rows.schema).parquet(out).groupBy(F.col(SOURCE_FILE).alias("filename")).agg(F.count(F.lit(1)).alias("n"))
    _record(spark, raw_dir, table, names, counts, load_id, run_id, rows.schema.json())


def _readable(rows: DataFrame) -> bool:
    """Whether every row can be read and cast, without writing any."""
    try:
        rows.write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JError):
        return False
    return True


def _batches(pending: DataFrame, table: str, max_files: int) -> Iterator[list[tuple[str, str]]]:
    """The table's pending files, ``max_files`` at a time; the driver never holds more than a partition of names."""
    rows = pending.filter(F.col("target") == table).select("filename", "path").orderBy("filename").toLocalIterator()
    yield from iter(lambda: [(r["filename"], r["path"]) for r in itertools.islice(rows, max_files)], [])


def load_table(spark: SparkSession, pending: DataFrame, table: str, schema: StructType, raw_dir: str, run_id: str,
               max_files: int = MAX_FILES_PER_BATCH) -> None:
    """Load every pending file of one raw table, each once in this run."""
    for batch in _batches(pending, table, max_files):
        groups, unread = _by_footer(spark, batch)
        for own, files in groups:
            _load(spark, files, own, table, schema, raw_dir, run_id)
        if unread:
            _record(spark, raw_dir, table, [n for n, _ in unread], None, "", run_id)


def compact_ledger(spark: SparkSession, raw_dir: str, max_files: int = MAX_LEDGER_FILES) -> None:
    """Replace the files of a ledger of many small ones by fewer: what each file name's newest row says, a SUCCESS before all.

    The new file is added before the replaced ones are deleted, and files that
    another run adds meanwhile are left alone: a crash leaves rows twice, which
    no reader minds, and never loses one.
    """
    ledger = read_ledger(spark, raw_dir)
    old = ledger.inputFiles()
    if len(old) <= max_files:
        return
    newest = upsert_ledger(ledger, order=[(F.col("status") == "SUCCESS").desc(), F.col("loaded_at").desc_nulls_last()])
    newest.hint("rebalance").write.mode("append").parquet(ledger_path(raw_dir))
    delete_files(spark, old)


def incremental_load(spark: SparkSession, landing: str, schemas: dict[str, StructType], raw_dir: str,
                     run_id: str | None = None, max_files: int = MAX_FILES_PER_BATCH) -> str:
    """Load the new and the failed files of each raw table; returns the run's id."""
    run_id = run_id or uuid.uuid4().hex
    compact_ledger(spark, raw_dir)
    found = work_dir(spark, "pending_files")  # one listing for the whole run
    unloaded_files(spark, landing, raw_dir).write.parquet(found)
    pending = spark.read.parquet(found)
    for table, schema in schemas.items():
        load_table(spark, pending, table, schema, raw_dir, run_id, max_files)
    return run_id


def read_raw_table(spark: SparkSession, raw_dir: str, table: str, load_ids: list[str] | None = None) -> DataFrame:
    """The rows of every load that the ledger records as successful (or of some of them), columns united by name.

    The ledger names the columns of each load, so no footer is read to find
    them; loads of the same columns are read together.  Where loads disagree
    about a type (its declaration changed) the column is text.
    """
    loads = (read_ledger(spark, raw_dir).filter((F.col("target") == table) & (F.col("status") == "SUCCESS"))
             .select("load_id", "columns").distinct())
    if load_ids is not None:
        loads = loads.filter(F.col("load_id").isin(load_ids))
    layouts = [r["columns"] for r in loads.select("columns").distinct().orderBy("columns").collect()]  # as many as column lists
    if not layouts:
        raise ValueError(f"no file of {table} was ever loaded")
    parts = []
    for columns in layouts:
        rows = spark.read.schema(StructType.fromJson(json.loads(columns)).add("load_id", "string")).parquet(_layout_path(raw_dir, table, columns))
        if load_ids is not None:
            rows = rows.filter(F.col("load_id").isin(load_ids))  # folders: the others are not listed as tasks
        parts.append(rows.join(loads.filter(F.col("columns") == columns).select("load_id"), "load_id", "left_semi").drop("load_id"))
    types: dict[str, set[str]] = {}
    for f in (f for part in parts for f in part.schema.fields):
        types.setdefault(f.name, set()).add(f.dataType.simpleString())
    text = {c for c, t in types.items() if len(t) > 1}
    parts = [part.withColumns({c: F.col(f"`{c}`").cast("string") for c in part.columns if c in text}) for part in parts]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
