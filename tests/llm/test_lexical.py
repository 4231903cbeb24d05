"""Operator 11: ranks and scores against scoring every document, term by term."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coursewise.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=10):
    """(item, rank, doc, score) of every item, from all documents' scores."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        query = Counter(plain_terms(text))
        scores = []
        for doc, bag in bags:
            m = 100 - 75 + (75 * bag.total() * n_docs) // n_terms
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t, n in query.items() if bag[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def make_items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "'x' AS score", "2 AS rank", "3 AS item")


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_terms_of_any_text(text):
    assert [t.decode() for t in lexical.terms(text.encode("utf-8", "surrogatepass"))] == plain_terms(text) or "\ud800" <= max(text) <= "\udfff"


def random_texts(rng, n, words, longest):
    vocabulary = [f"w{k}" for k in range(words)]
    weight = 1 / np.arange(1, words + 1)
    return [" ".join(rng.choice(vocabulary, rng.integers(0, longest), p=weight / weight.sum())) for _ in range(n)]


def test_many_trees_tasks_and_blocks(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(3)
    docs = list(enumerate(random_texts(rng, 1500, 300, 60)))
    docs += [(2000 + k, docs[7][1]) for k in range(200)] + [(None, docs[9][1])] * 3 + [(9, docs[9][1])]
    items = list(enumerate(random_texts(rng, 40, 300, 30))) + [(3, "w1 w2 w250"), (100, "nowhere to be found w9")]
    monkeypatch.setattr(lexical, "_TREE_DOCS", 300)
    monkeypatch.setattr(lexical, "_TREE_POSTINGS", 2000)
    monkeypatch.setattr(lexical, "_PRODUCTS", 500)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 17)
    monkeypatch.setattr(lexical, "SEED_SHARE", 4)
    got = found(lexical.search(make_docs([(i, t, "en", "s") for i, t in docs]), make_items(spark, items)))
    assert got == plain_search(docs, items)


def test_pruning_leaves_out_documents_and_no_result():
    """Topics that share no terms: an item's search scores few documents, and what it finds is what scoring all finds."""
    rng = np.random.default_rng(4)
    n_terms, topics, each = 400, 40, 128
    term = np.concatenate([np.sort(rng.choice(10, 6, replace=False)) + 10 * (d // each) for d in range(topics * each)])
    tf = rng.integers(1, 5, len(term))
    n = rng.integers(6, 40, topics * each)
    df = np.bincount(term, minlength=n_terms)
    weights = lexical.Weights(topics * each, int(n.sum()), df)
    impact = weights.impact(term, tf, np.repeat(n, 6))
    counts = np.zeros((topics, n_terms), np.int32)
    for i in range(topics):
        counts[i, 10 * i + rng.choice(10, 5, replace=False)] = 1
    items = lexical.ItemTree(counts, weights.weight)
    assert sorted(items.order.tolist()) == list(range(topics))
    search = lexical.Search(items, 10, np.zeros(topics, np.int64))
    ids = rng.permutation(topics * each)
    for a in range(0, topics * each, 1024):
        part = slice(6 * a, 6 * (a + 1024))
        search.add(lexical.DocTree(ids[a:a + 1024], np.zeros(1024, bool), np.arange(1025) * 6, term[part], impact[part]))
    dense = np.zeros((topics * each, n_terms), np.int64)
    dense[np.repeat(np.arange(topics * each), 6), term] = impact
    score = items.counts @ dense.T
    item, got, _, doc = search.best
    for i in range(topics):
        order = np.lexsort((ids, -score[i]))[:10]
        assert got[item == i].tolist() == score[i][order].tolist() and doc[item == i].tolist() == ids[order].tolist()
    assert search.scored < 0.25 * score.size


ODD = [(1, None), (2, ""), (3, "  ,.!  "), (4, "Ärger ÄRGER ärger"), (5, "a\0b A-B a_b"), (5, "a\0b A-B a_b"), (6, "日本 日本語"), (None, "alpha beta"), (None, "alpha beta"),
       (7, "alpha " * 30000), (8, "beta alpha"), (9, "beta alpha"), (10, "x1 1x")]


def test_odd_rows_ties_repeats_and_clashing_columns(spark, make_docs):
    items = [(1, "alpha beta"), (1, "alpha beta"), (1, "beta"), (2, None), (3, ""), (4, "ÄRGER a b b b"), (None, "日本 1x"), (5, "none of these"), (6, "alpha " * 5000)]
    got = found(lexical.search(make_docs([(i, t, "en", "s") for i, t in ODD]), make_items(spark, items)))
    want = plain_search(ODD, [x for x in items if x[1]])
    assert got == want and len(got) > 10


def test_empty_tables(spark, make_docs):
    docs, items = make_docs([(1, "alpha", "en", "s")]), make_items(spark, [(1, "alpha")])
    assert found(lexical.search(docs.limit(0), items)) == []
    assert found(lexical.search(docs, items.limit(0))) == []
    assert found(lexical.search(make_docs([(1, None, None, None)]), items)) == []
    assert found(lexical.search(docs, make_items(spark, [(1, None)]))) == []


@pytest.mark.parametrize("level", ["root", "leaf"])
def test_bounds_hold(level):
    rng = np.random.default_rng(6)
    counts, impact = rng.integers(0, 3, (20, 50)).astype(np.int32), rng.integers(0, 10**9, (200, 50))
    items = lexical.ItemTree(counts, np.ones(50, np.int64))
    offsets, term = np.arange(201) * 50, np.tile(np.arange(50), 200)
    docs = lexical.DocTree(np.arange(200), np.zeros(200, bool), offsets, term, impact.ravel())
    for node in range(len(items.low)):
        own = items.counts[items.low[node]:items.high[node]]
        for at in range(4) if level == "leaf" else (0,):
            below = impact[64 * at:64 * at + 64] if level == "leaf" else impact
            bound = items.bounds(np.array([node]), *docs.maxima(0 if level == "leaf" else 2, at))
            assert bound[0] >= (own.astype(np.int64) @ below.T).max()
