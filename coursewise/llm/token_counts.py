"""Operator 4: token counts through a digest cache.

A count is stored under the digest of the text and the digest of the
tokenizer (its file and library version).  Texts whose digests are stored cost
a join; of the others each distinct text is encoded once and its count is
appended to the cache.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursewise.session import ensure_checkpoint_dir, work_dir

from .common import blocks, text_batches

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Any:
    """A function from texts to token counts, loaded once per Python worker."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file and of the version of the library that reads it."""
    import sentencepiece
    import tokenizers

    version = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + version.encode()).hexdigest()


def shared_cache(spark: SparkSession, corpus: str) -> str:
    """The cache that all runs over ``corpus`` (the place of its tables) with the same ``spark.checkpoint.dir`` read and add to."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/coursewise/token_cache-{hashlib.sha256(corpus.rstrip('/').encode()).hexdigest()[:16]}"


def token_counts(docs: DataFrame, path: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, with misses appended to the cache table at ``cache``.

    ``cache`` is a shared folder that holds earlier counts, or is made; without
    one the cache lives for this call below ``spark.checkpoint.dir``.  Runs may
    share it at the same time: a digest that two of them add counts once.  Null
    counts as empty text.  Very long texts are encoded whole, one at a time.
    Null and repeated ids give a result per row, an empty table gives none,
    other columns are not read.
    """
    spark = docs.sparkSession
    text_batches(spark)
    cache = cache or work_dir(spark, "token_cache")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)  # so that it can be read
    version = tokenizer_digest(path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))

    def stored() -> DataFrame:
        own = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
        return own.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    misses = rows.groupBy("digest").agg(F.min("id").alias("id")).join(stored(), "digest", "left_anti")
    # one row a digest stands for its copies; digest and id together spread a text that a third of the rows share
    chosen = rows.join(misses.withColumnsRenamed({"digest": "d", "id": "i"}), F.col("digest").eqNullSafe(F.col("d")) & F.col("id").eqNullSafe(F.col("i")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [n for i, j in blocks(texts) for n in encode(texts[i:j])]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    fresh = chosen.select("text", "digest").mapInArrow(count, "digest binary, n_tokens bigint")
    fresh = fresh.dropDuplicates(["digest"])  # rows that repeat an id and its text
    fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    return rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(stored(), "digest").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens")
