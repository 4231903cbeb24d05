"""Operator 3: exact deduplication with DataFrame operations only.

Texts are grouped by a 128-bit content hash.  The grouping also carries the
smallest and largest text of each group, so equal bytes are proven by
comparing the two; the comparison is a partial aggregate, and a group that
holds a third of all rows reaches the shuffle as one row a task.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() agrees on ASCII and is much faster there; elsewhere it would change other letters too
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                     normalise: Callable[[Column], Column] = normalised,
                     digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Of equal normalised texts the row with the smallest id stays, or the
    largest with ``keep="max"``.  Null and empty texts are equal.  Rows that
    repeat an id are one document: they share ``kept`` and each counts in
    ``group_size``.  A null id never stays while the group holds another id;
    a group of null ids only has a null ``keep_id`` and its rows stay.  An
    empty table gives no rows; other columns of ``docs`` are not read.

    Texts that share a hash but differ are told apart: such groups are grouped
    again by hash and text.
    """
    best = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(F.col(id_col).alias("id"), normalise(F.col(text_col)).alias("text"))
    rows = rows.withColumn("hash", digest(F.col("text")))
    groups = rows.groupBy("hash").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                                      F.min("text").alias("low"), F.max("text").alias("high"))
    # a text that occurs once needs no lookup; what is written and joined are the groups of copies
    groups = written(groups.where("group_size > 1").select("hash", "keep_id", "group_size", (F.col("low") == F.col("high")).alias("equal")), "copies")
    collided = groups.where("not equal").select("hash")
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    alone = [F.coalesce("group_size", F.lit(1)).alias("group_size"), F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id")]
    single = rows.select("id", "hash", sha).join(groups.where("equal"), "hash", "left")
    if collided.isEmpty():
        out = single.select("id", "text_sha256", *alone)
    else:
        mixed = rows.join(collided, "hash", "left_semi")
        exact = mixed.groupBy("hash", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        out = single.join(collided, "hash", "left_anti").select("id", "text_sha256", *alone).unionByName(
            mixed.join(exact, ["hash", "text"]).select("id", sha, "group_size", "keep_id"))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
