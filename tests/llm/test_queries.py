"""The registered queries on the smallest table: contracts, SQL and brute force."""

import hashlib
import os
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from coursewise.llm import queries

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="module")
def documents():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def rows(spark, name, *columns):
    return [tuple(r) for r in queries.QUERIES[name](spark, SF).select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    frame = queries.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_every_query_is_registered_with_the_entry():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_op1_and_op9_follow_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: library.encode(t or "", add_special_tokens=False).ids for k, t in documents.items()}
    for doc, n, digest, decoded in rows(spark, "op9_bpe_round_trip", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"):
        assert (n, digest) == (len(ids[doc]), hashlib.sha256(" ".join(map(str, ids[doc])).encode()).hexdigest())
        assert decoded == hashlib.sha256(library.decode(ids[doc], skip_special_tokens=False).encode()).hexdigest()
    bins, seen = {}, {}
    for doc, piece, start, length, crc, sequence, offset in rows(
            spark, "op1_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"):
        whole = [*ids[doc], 1]
        part = whole[start:start + length]
        assert start == 4096 * piece and len(part) == length and (length == 4096 or start + length == len(whole))
        assert crc == zlib.crc32(np.array(part, "<u4").tobytes())
        bins.setdefault(sequence, []).append((offset, length))
        seen[doc] = seen.get(doc, 0) + length
    assert seen == {k: len(v) + 1 for k, v in ids.items()}
    for content in bins.values():
        assert [o for o, _ in sorted(content)] == [0, *np.cumsum([n for _, n in sorted(content)])[:-1].tolist()]
    assert all(sum(n for _, n in c) <= 4096 for c in bins.values())
    assert len(bins) <= 1.02 * sum(seen.values()) / 4096 + 1


def test_op4_follows_the_library(spark, documents):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {(k, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for k, t in documents.items()}
    assert set(rows(spark, "op4_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit")) == want


def test_op7_against_all_pairs(spark, documents):
    from test_duplicates import plain_fingerprint, plain_roots

    fps = {k: plain_fingerprint(t) for k, t in documents.items()}
    order = sorted(fps)
    roots = plain_roots([(a, b) for i, a in enumerate(order) for b in order[i:] if (fps[a] ^ fps[b]).bit_count() <= 3])
    assert set(rows(spark, "op7_simhash_near_dedup", "doc_id", "fingerprint", "component_id")) == {(k, f"{f:016x}", roots[k]) for k, f in fps.items()}


def test_op10_columns(spark, documents):
    got = queries.QUERIES["op10_quality_classifier"](spark, SF)
    assert got.count() == len(documents)
    bad = got.filter((F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)) | ~F.col("score").between(0, 1)
                     | (F.col("predicted") != (F.col("score") >= 0.3).cast("int")))
    assert bad.count() == 0


def test_op6_accepts_the_given_pages(spark):
    got = queries.QUERIES["op6_language_id"](spark, SF).agg(F.count("*"), F.avg(F.col("accepted").cast("int"))).first()
    assert got[0] == spark.read.parquet(f"{SF}/pages.parquet").count() and got[1] > 0.95
