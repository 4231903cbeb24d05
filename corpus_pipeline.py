"""Training corpus from ``documents``: quality, language, line dedup, near-dedup, packing.

Every stage takes (spark, docs, sf_dir) and decides on all rows that the stage
before it kept; all but the last return the columns of ``documents``.  Rows
are told apart by what a stage decides on, not by doc_id alone: rows that
share an id, or have none, stand or fall each by its own text.  Null texts
count as empty, and an empty table runs through as an empty table.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursewise.llm import language, line_dedup, packing, quality, simhash
from coursewise.llm.common import table, written


def _key(*columns: str) -> Column:
    """What rows are told apart by: doc_id (null ids come last in order), digest of the text, and the columns."""
    return F.struct(F.col("doc_id").isNull().alias("unidentified"), "doc_id", line_dedup.text_digest(F.col("text")).alias("digest"), *columns)


def _with_keys(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is among ``keys`` (column key); nulls are equal."""
    kept = keys.select("key").distinct().alias("k")
    same = [key[f].eqNullSafe(F.col("k.key")[f]) for f in keys.schema["key"].dataType.names]
    return docs.alias("d").join(kept, functools.reduce(lambda a, b: a & b, same), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents whose quality score is below the threshold go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~quality.held_out()))
    return docs.where(quality.scores(model) >= quality.THRESHOLD)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents without a known language go; the lang column is the declaration, the source the host."""
    model = language.fit(docs)
    key = _key("lang", "source")  # rows of one key have the same evidence
    rows = docs.select(key.alias("key"), "text", "lang", "source")
    found = language.identify(rows, model, "key", F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source"))
    return _with_keys(docs, key, found.where(language.accepted()))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines that many sources share are cut out of the texts, a group of near copies (operator 7) counting as one source."""
    count = "_".join(["lines_removed", *docs.columns])  # longer than any column's name, so none of them is replaced
    texts = docs.select(line_dedup.text_digest(F.col("text")).alias("digest"), "text")
    cut = line_dedup.remove_boilerplate(docs, count_col=count, copies=simhash.near_duplicates(texts, "digest"))
    size = F.when(F.col(f"`{count}`") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each component one row stays, that with the smallest id, then text digest, then other columns."""
    found = simhash.near_duplicates(docs.select(_key().alias("key"), "text"), "key")
    stay = written(found.where("key = component").groupBy("key").count(), "stay")
    kept = _with_keys(docs, _key(), stay.where("count = 1"))
    # rows that repeat id and text are few or fall together before they are shuffled
    repeated = _with_keys(docs, _key(), written(stay.where("count > 1"), "repeated"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = repeated.groupBy(_key().alias("key")).agg(F.min(F.struct(*columns)).alias("row"))
    return kept.union(one.select(*[F.col(f"row.`{c}`") for c in docs.columns]))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the documents that are left, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("language", language_stage), ("lines", line_stage), ("near_duplicates", near_duplicate_stage), ("packing", packing_stage)]

#: SQL can state neither the classifier nor the bit distances; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
