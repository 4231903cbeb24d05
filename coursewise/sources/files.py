"""Readers and writers.

All paths are arguments (local folders in tests, object-store URIs on a
cluster); nothing is read into the driver.  Writers return the path they
wrote so callers can read the result back lazily.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet_dir(spark: SparkSession, path: str, schema: StructType | None = None,
                     with_source: bool = False) -> DataFrame:
    """Every parquet file of a folder (explicit schema when given)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.withColumn("_source_file", F.col("_metadata.file_path")) if with_source else df


def read_parquet_tree(spark: SparkSession, root: str, glob: str = "*.parquet",
                      schema: StructType | None = None, merge_schema: bool = True,
                      with_source: bool = False) -> DataFrame:
    """All files below a root (any depth) whose name matches ``glob``.

    The bucket listing of the reference becomes Spark's parallel file index
    (``recursiveFileLookup`` + ``pathGlobFilter``); it works the same for
    ``s3a://`` URIs.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("mergeSchema", str(merge_schema).lower())
    df = reader.parquet(root)
    return df.withColumn("_source_file", F.col("_metadata.file_path")) if with_source else df


# One dialect for both directions: quotes are doubled, a quoted value may hold commas and line
# breaks, spaces are part of the value, and an empty value reads as NULL.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, mode: str = "PERMISSIVE", multi_line: bool = True) -> DataFrame:
    """S3: CSV with a header; an explicit schema avoids the inference pass.

    A file whose values may hold line breaks cannot be split by this reader: it
    is one task.  ``read_csv_split`` reads large files with sound quoting; turn
    ``multi_line`` off for files that are known to have no such breaks.
    """
    reader = (spark.read.options(**CSV_DIALECT).option("header", str(header).lower()).option("mode", mode)
              .option("multiLine", str(multi_line).lower()))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_split(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """S3 for large files: several tasks read one file though quoted values hold line breaks.

    Lines are read in blocks.  A line is inside a value when an odd number of
    quotes stands before it in the file: quotes are counted per block, summed
    over the blocks before (one row a block), and counted on within the block.
    Lines that begin and end outside of values are records; the others are put
    together by the line that their record begins with, which may be in an
    earlier block.

    Quotes have to be paired, as ``write_csv`` and the common writers leave
    them; a lone quote inside a bare value is for ``read_csv``.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), (F.regexp_count("value", F.lit('"')) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("__odd"))
    in_block = Window.partitionBy("file", "block").orderBy("at")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.join(blocks, ["file", "block"]).withColumns({
        "inside": (F.col("__odd") + F.coalesce(F.sum("odd").over(earlier), F.lit(0))) % 2 == 1,
        "first": (F.col("block") == 0) & F.lag("at").over(in_block).isNull()})
    begins = F.max(F.when(~F.col("inside"), F.col("at")))
    rows = rows.withColumn("__own", begins.over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = rows.groupBy("file", "block").agg(begins.alias("last"))
    ends = ends.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("__last"))
    whole = ~F.col("inside") & (F.col("odd") == 0)
    single = rows.filter(whole).select("value", "first")
    parts = rows.filter(~whole).join(ends, ["file", "block"]).withColumn("record", F.coalesce("__own", "__last"))
    pieces = F.array_sort(F.collect_list(F.struct("at", "value")))
    several = parts.groupBy("record").agg(F.array_join(F.transform(pieces, lambda x: x["value"]), "\n").alias("value"), F.max("first").alias("first"))
    records = single.unionByName(several.select("value", "first")).select(F.regexp_replace("value", "\r$", "").alias("value"), "first")
    records = records.filter((F.col("value") != "") & ~(F.col("first") & F.lit(header)))
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("value", F.lit(ddl), CSV_DIALECT).alias("row")).select("row.*")


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_DIALECT).option("header", str(header).lower()).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Compressed parquet output (gzip like the crawler's batches)."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


REPORT = "name string, path string, row_count bigint, error string"


def _report(spark: SparkSession, name: str, path: str, count: DataFrame | None, error: str | None = None) -> DataFrame:
    if count is None:
        return spark.createDataFrame([(name, path, None, error)], REPORT)
    return count.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("name"), F.lit(path).alias("path"), "row_count", F.lit(None).cast("string").alias("error"))


def csv_to_parquet(spark: SparkSession, mapping: dict[str, tuple[str, StructType | str | None]],
                   compression: str = "snappy") -> DataFrame:
    """Convert named CSV sources to named parquet targets; report rows per target.

    ``mapping`` is target path -> (csv path, schema).  Each conversion is one
    distributed read + write; the report is read back from the written files.
    A source that is missing or cannot be read is reported with a NULL count
    and its error, and the others go on.
    """
    out = spark.createDataFrame([], REPORT)
    for target, (src, schema) in mapping.items():
        try:
            write_parquet(read_csv(spark, src, schema), target, compression)
            out = out.unionByName(_report(spark, src, target, spark.read.parquet(target)))
        except (PySparkException, Py4JError) as e:
            out = out.unionByName(_report(spark, src, target, None, str(e).split("\n")[0]))
    return out.withColumnsRenamed({"name": "source", "path": "target"})


def export_csv(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
               skip_errors: bool = True) -> DataFrame:
    """Each table -> CSV folder with header; report rows written per table.

    Rows are counted from the written files by the dialect they were written
    in.  A failing table is reported with a NULL count and its error instead
    of stopping the export (the reference skips it and goes on).
    """
    out = spark.createDataFrame([], REPORT)
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        try:
            write_csv(df, path)
            text = ", ".join(f"`{c}` string" for c in df.columns)
            out = out.unionByName(_report(spark, name, path, read_csv_split(spark, path, text)))
        except (PySparkException, Py4JError) as e:
            if not skip_errors:
                raise
            out = out.unionByName(_report(spark, name, path, None, str(e).split("\n")[0]))
    return out.withColumnRenamed("name", "table_name")


def _fs(spark: SparkSession, path: str):
    """(file system, folder class) for a path of any store that Spark can write to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    return folder(path).getFileSystem(spark._jsc.hadoopConfiguration()), folder


def delete_files(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders; what is gone already is passed over."""
    for path in paths:
        fs, folder = _fs(spark, path)
        fs.delete(folder(path), True)


def _versions(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Names in ``<path>/<kind>``, oldest version first."""
    fs, folder = _fs(spark, path)
    at = folder(f"{path}/{kind}")
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of the table at ``path`` and make it the current one; returns its folder.

    A version is an immutable folder ``data/<version>``; it is current once the
    empty file ``current/<version>`` exists and no later one does.  That file
    is made last and nothing is renamed or overwritten, so whatever fails
    before leaves the old version and whatever fails after it the new one.
    The version before stays for readers that are still at it; older ones go.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    named = _versions(spark, path, "current")
    version = f"{int(named[-1].split('-')[0]) + 1 if named else 1:010d}-{uuid.uuid4().hex[:8]}"
    data = f"{path}/data/{version}"
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(data)
    else:
        df.write.parquet(data)
    _mark(spark, f"{path}/current/{version}")
    if named:
        old = {kind: [v for v in _versions(spark, path, kind) if v < named[-1]] for kind in ("current", "data")}
        delete_files(spark, [f"{path}/{kind}/{v}" for kind, versions in old.items() for v in versions])
    return data


def _mark(spark: SparkSession, path: str) -> None:
    """Make an empty file that is not there yet: one step on every store."""
    fs, folder = _fs(spark, path)
    fs.create(folder(path), False).close()


def resolve(spark: SparkSession, path: str) -> str:
    """The folder of a published table's current version."""
    named = _versions(spark, path.rstrip("/"), "current")
    if not named:
        raise FileNotFoundError(f"no version of {path} was ever published")
    return f"{path.rstrip('/')}/data/{named[-1]}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    return spark.read.parquet(resolve(spark, path))


def materialize(df: DataFrame, name_or_path: str, kind: str = "view", partition_by: list[str] | None = None) -> str:
    """A model as a temp view (staging default) or a rebuilt table (marts default).

    A ``table`` is published as a new version (``publish``) and the folder of
    that version is returned; others find it by ``read_table``.  A build that
    fails leaves the old version, and a table may be rebuilt from itself.
    Partitions are balanced by size before they are written.
    """
    if kind == "view":
        df.createOrReplaceTempView(name_or_path)
        return name_or_path
    return publish(df, name_or_path, partition_by)


def batch_layout(df: DataFrame, job: str, mode: str, group: str, first_page: int, last_page: int,
                 stamp_col: str = "_scraped_at") -> DataFrame:
    """Provenance columns that the crawler encoded in object names."""
    return df.withColumns({
        "job": F.lit(job), "mode": F.lit(mode), "group_name": F.lit(group),
        "page_range": F.lit(f"p{first_page}-{last_page}"),
        "ingest_month": F.date_format(F.col(stamp_col), "yyyy-MM"),
    })


def write_partitioned(df: DataFrame, path: str, cols=("job", "mode", "ingest_month"),
                      compression: str = "gzip") -> str:
    """Batch output partitioned by provenance (readers prune on these folders)."""
    return write_parquet(df, path, compression, "overwrite", list(cols))
