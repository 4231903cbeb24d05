"""Operators 9, 4 and 1: ids, counts and sequences against the tokenizer libraries and a naive packer."""

import bisect
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coursewise.llm import bpe, packing, token_counts

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")

ODD = ["", None, "Hello <|endoftext|>World<|startoftext|>", "<|ENDOFTEXT|> a", "ΣΑΣ ὈΔΥΣΣΕΎΣ İI", "a\x1cb \x1f c", "日本語 テキスト🙂🙂 naïve café",
       "x" * 5000, "ab" * 300 + " 12345 don't we'll I'M 'tis ''s rock'n'roll 're", "é ́x Å", " x  y\u0085z᠎w q", "¹²³ ªº µ ǅ ß ẞ",
       "<|endoftext|", "<|endoftext|><|endoftext|>x", "!\0", "!", "\0", "\0\0 a\0b\0", "!\0\0", " \n\t", "'s", "a's", "!'s", "' s", "1's2"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(WORD)


def ids_of(own, texts):
    offsets, ids = own.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_odd_texts_encode_as_the_library_does(own, library):
    assert ids_of(own, ODD) == [library.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdeé'st ll.,<|>123\n\tÀΣßя日́revmd\0!"), max_size=60), max_size=4))
def test_any_text_encodes_and_decodes_as_the_library_does(own, library, texts):
    for text, ids in zip(texts, ids_of(own, texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("texts", [["!", "!\0"], ["!\0", "!"], ["!\0\0", "\0!", "!", "\0"]])
def test_null_characters_make_other_words_in_any_order(library, texts):
    assert ids_of(bpe.WordBpe(WORD), texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_with_the_same_hashes_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(bpe, "_BASES", (1, 1))  # now words of the same letters in any order share both hashes
    texts = ["listen silent tinsel", "silent enlist listen", "abc", "acb bca abc cab", "no on no on"]
    for order in (texts, texts[::-1]):
        assert ids_of(bpe.WordBpe(WORD), order) == [library.encode(t, add_special_tokens=False).ids for t in order]


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 64)
    small = bpe.WordBpe(WORD)
    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}ing" for k in range(600))
    assert ids_of(small, [text, text]) == [library.encode(text, add_special_tokens=False).ids] * 2


def test_a_text_longer_than_a_block(own, library, monkeypatch):
    text = "Some words, and more\n" * 2000 + "z" * 3000 + " end"
    want = library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 1000)
    assert ids_of(own, [text]) == [want]


def test_round_trip_rows(spark, make_docs, library):
    rows = [(k, t, None, None) for k, t in enumerate(ODD)] + [(None, "null id", None, None), (3, "again", None, None), (3, "again", None, None)]
    got = sorted(map(tuple, bpe.encode_decode(make_docs(rows), WORD).collect()), key=repr)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    assert bpe.encode_decode(make_docs([]), WORD).count() == 0


def test_counts_and_cache(spark, make_docs, tmp_path):
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=PIECE)
    rows = [(k, t, None, None) for k, t in enumerate(ODD)] + [(None, "x y", None, None), (7, "x y", None, None), (7, "x y", None, None)]
    cache = str(tmp_path / "cache")
    got = sorted(map(tuple, token_counts.token_counts(make_docs(rows), PIECE, cache).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in rows), key=repr)
    stored = spark.read.parquet(cache)
    distinct = len({t or "" for _, t, *_ in rows})
    assert stored.count() == stored.select("digest").distinct().count() == distinct
    token_counts.token_counts(make_docs([(1, "x y", None, None), (2, "new one", None, None)]), PIECE, cache).collect()
    assert spark.read.parquet(cache).count() == distinct + 1  # only the miss was encoded
    assert token_counts.token_counts(make_docs([]), PIECE).count() == 0


def test_stored_counts_are_used(spark, make_docs, tmp_path):
    import hashlib
    cache = str(tmp_path / "cache")
    version = token_counts.tokenizer_digest(PIECE)
    spark.createDataFrame([(version, hashlib.sha256(b"abc").digest(), 99), ("other", hashlib.sha256(b"def").digest(), 98)], token_counts.CACHE_SCHEMA).write.parquet(cache)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(make_docs([(1, "abc", None, None), (2, "def", None, None)]), PIECE, cache).collect()}
    assert got[1] == 99 and got[2] != 98


def naive_best_fit(lengths, capacity):
    rooms, bins = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            bins += 1
            room = capacity
        else:
            room = rooms.pop(at)
        bisect.insort(rooms, room - length)
    return bins, rooms


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 80).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=150))))
def test_plan_is_best_fit_decreasing(case):
    capacity, lengths = case
    histogram = {n: lengths.count(n) for n in set(lengths)}
    bins, seen = {}, {}
    for length, rank, n, first, each, offset in packing.best_fit_plan(histogram, capacity).tolist():
        assert rank == seen.get(length, 0)
        seen[length] = rank + n
        for k in range(n):
            bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert seen == histogram
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    count, rooms = naive_best_fit(lengths, capacity)
    assert (len(bins), sorted(capacity - sum(n for _, n in c) for c in bins.values())) == (count, rooms)


def test_packed_documents(spark, make_docs, library):
    texts = [*ODD, "one two three " * 40, None, "same", "same"]
    rows = [(k, t, None, None) for k, t in enumerate(texts)] + [(None, "no id", None, None)]
    got = packing.pack(make_docs(rows), WORD, max_tokens=16, with_ids=True).collect()
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in rows}
    bins, parts = {}, {}
    for r in got:
        assert r["start"] == 16 * r["piece"] and r["length"] == len(r["ids"]) <= 16
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        parts.setdefault(r["doc_id"], []).append((r["piece"], r["ids"]))
    assert {i: sum((ids for _, ids in sorted(p)), []) for i, p in parts.items()} == want
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 16
    lengths = [n for ids in want.values() for n in [16] * (len(ids) // 16) + [len(ids) % 16] * (len(ids) % 16 > 0)]
    assert len(bins) == naive_best_fit(lengths, 16)[0]
    assert packing.pack(make_docs([]), WORD).count() == 0


def test_a_cache_that_two_runs_filled_counts_once(spark, make_docs, tmp_path):
    docs, cache = make_docs([(1, "some text", None, None), (2, "", None, None), (3, "some text", None, None), (4, "word " * 30_000, None, None)]), str(tmp_path / "cache")
    want = sorted(map(tuple, token_counts.token_counts(docs, PIECE, cache).collect()))
    spark.read.parquet(cache).write.mode("append").parquet(cache)  # another run added the same rows
    assert sorted(map(tuple, token_counts.token_counts(docs, PIECE, cache).collect())) == want and len(want) == 4


def test_the_query_finds_what_an_earlier_run_stored(spark):
    from coursewise.llm import queries

    first = queries.op4_token_counts(spark, "/root/testdata/sf0.001").collect()
    stored = spark.read.parquet(token_counts.shared_cache(spark, "/root/testdata/sf0.001"))
    n = stored.count()
    assert sorted(queries.op4_token_counts(spark, "/root/testdata/sf0.001").collect()) == sorted(first)
    assert n == spark.read.parquet(token_counts.shared_cache(spark, "/root/testdata/sf0.001")).count() >= len({r.n_bytes for r in first})
