"""Operator 13: groups, links and corpus-wide counts against token-by-token brute force."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coursewise.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a", "  x  ", "a\n\n b\t", "<|endoftext|> <s> </s><unk>\0", "日本語 é\n\n🙂", "▁x", "a ▁", "naïve café don't I'LL 'tis 12 345", "\x1c\x85\xa0 ʼn'S", "x" * 4000]


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabulary(A), alignment.Vocabulary(B)


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def plain(libraries, vocabularies, text):
    """(n_a, n_b, n_groups, n_links, digest, links) of one text, token by token."""
    a, b = libraries
    entries = [v.entries for v in vocabularies]
    if not text:
        return 0, 0, 0, 0, "", Counter()
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if any(b"".join(e[i] for i in own) != b" " + text.encode() for e, own in zip(entries, ids)):
        return 0, 0, 0, 0, "", Counter()
    spans = []
    for e, own in zip(entries, ids):
        at, out = 0, []
        for i in own:
            out.append((at, at + len(e[i]), i))
            at += len(e[i])
        spans.append(out)
    left, right = spans
    links, j0 = Counter(), 0
    for s, e, i in left:
        while right[j0][1] <= s:
            j0 += 1
        j = j0
        while j < len(right) and right[j][0] < e:
            links[i, right[j][2]] += 1
            j += 1
    cuts = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
    groups, i, j = [], 0, 0
    for cut in cuts:
        parts = ["", ""]
        for side in (0, 1):
            k, own = (i, left) if side == 0 else (j, right)
            first = k
            while k < len(own) and own[k][1] <= cut:
                k += 1
            parts[side] = ",".join(str(x[2]) for x in own[first:k])
            i, j = (k, j) if side == 0 else (i, k)
        groups.append("|".join(parts))
    return len(left), len(right), len(cuts), links.total(), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def plain_corpus(libraries, vocabularies, docs):
    each = {k: plain(libraries, vocabularies, t) for k, t in docs}
    of = [plain(libraries, vocabularies, t) for _, t in docs]
    counts, most = Counter(), Counter()
    for row in of:
        counts.update(row[5])
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted((str(k), *row[:4], sum(n for p, n in row[5].items() if counts[p] == most[p[1]]), sum(n * counts[p] for p, n in row[5].items()), row[4])
                  for (k, _), row in zip(docs, of)), each


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(frame):
    return sorted((str(r[0]), *tuple(r)[1:]) for r in frame.select(*COLUMNS).collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdeé'st ll.,<|>123\n\tÀΣя日▁\0\x85"), max_size=40), max_size=4))
def test_any_text_encodes_as_the_libraries_do(vocabularies, libraries, texts):
    a, b = vocabularies
    assert a.encode(texts) == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]
    rows = [plain(libraries, vocabularies, t) for t in texts]
    got = [row for numbers, digests, *_ in alignment.align(a, b, texts) for row in zip(*(numbers[k].tolist() for k in alignment._NUMBERS), digests)]
    assert got == [r[:5] for r in rows]


def test_every_latin_character_encodes_as_the_library_does(vocabularies, libraries):
    for pattern in ("{}", "a{}b", " {} ", "{0}{0}", "1{}'s", "\n{}"):
        texts = [pattern.format(chr(c)) for c in range(0x250)]
        assert vocabularies[0].encode(texts) == [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_odd_rows_repeats_and_clashing_columns(spark, make_docs, vocabularies, libraries):
    docs = [*enumerate(ODD), (3, "a"), (3, "other"), (None, "no id"), (None, "no id"), (99, "the same text"), (98, "the same text")]
    frame = make_docs([(i, t, "en", "s") for i, t in docs]).withColumnsRenamed({"row": "chunk", "fp": "pair", "hash": "links"})
    assert found(alignment.align_tokens(frame, A, B)) == plain_corpus(libraries, vocabularies, docs)[0]


def test_empty_table_and_a_table_without_tokens(spark, make_docs):
    assert found(alignment.align_tokens(make_docs([]), A, B)) == []
    assert found(alignment.align_tokens(make_docs([(1, None, None, None), (2, "", None, None)]), A, B)) == [("1", 0, 0, 0, 0, 0, 0, ""), ("2", 0, 0, 0, 0, 0, 0, "")]


def test_small_chunks_and_blocks_change_nothing(spark, make_docs, vocabularies, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 50)
    monkeypatch.setattr(alignment, "_ALIGN_CHARS", 100)
    docs = [(k, " ".join(f"word{j % 7} and {j * k}" for j in range(k))) for k in range(40)]
    assert found(alignment.align_tokens(make_docs([(i, t, "en", "s") for i, t in docs]), A, B)) == plain_corpus(libraries, vocabularies, docs)[0]


def test_query_against_brute_force(spark, vocabularies, libraries):
    import duckdb

    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert found(queries.op13_token_alignment(spark, "/root/testdata/sf0.001")) == plain_corpus(libraries, vocabularies, docs)[0]
