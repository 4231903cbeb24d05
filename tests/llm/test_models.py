"""Operators 5, 6, 8 and 10 and the pipeline: brute force, held-out accuracy and odd rows."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursewise.llm import ann, chat, language, quality

# -- nearest neighbours -----------------------------------------------------


def brute_force(rows, k, asks):
    size = max((len(v) for _, v in rows if v), default=0)
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = np.array([i for i, _ in sorted(good)])
    vectors = np.array([[*v, *[0.0] * (size - len(v))] for _, v in sorted(good)])
    out = {}
    for i, q in zip(ids, vectors):
        if asks(i):
            score = (vectors * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    return {q: [x[k] for k in sorted(x)] for q, x in out.items()}


def test_hilbert_index_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        place = ann.hilbert_index(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_whole_window_is_exact_over_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.standard_normal(6) * rng.uniform(0.1, 5)).round(2).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(80)] + [(7, rows[7][1]), (8, rows[9][1])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None]), (2004, [math.nan] * 6), (2005, [math.inf, 1.0]), (None, [1.0] * 6), (2006, [3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"id": F.lit(1), "vec": F.lit("x"), "asked": F.lit(0), "curve": F.lit(2)})
    got = found(ann.nearest(frame, F.col("vec_id") % 20 == 0, k=25, window=1.0))
    want = brute_force(rows, 25, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-14)


def test_fewer_candidates_than_asked_for_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert found(ann.nearest(frame, F.col("vec_id") % 20 == 0)) == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 1.0), (0, 0.0)]}
    empty = ann.nearest(frame.limit(0), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_recall_of_the_windows(spark, monkeypatch):
    """Blocks far smaller than the windows, so that the curves decide what meets."""
    monkeypatch.setattr(ann, "_BLOCK", 64)
    monkeypatch.setattr(ann, "_QUERIES", 32)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = found(ann.nearest(frame, F.col("vec_id") % 20 == 0))
    want = brute_force(rows, 20, lambda i: i % 20 == 0)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert 0.9 <= hits / sum(map(len, want.values())) < 1


def test_equal_scores_are_bounded_and_in_order_of_ids(spark):
    """Vectors of two values each: very many tie, and the smaller ids win."""
    rng = np.random.default_rng(9)
    rows = [(int(i), (2.0 * rng.integers(0, 2, 12) - 1).tolist()) for i in rng.permutation(3000)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert found(ann.nearest(frame, F.col("vec_id") % 100 == 0, window=1.0)) == brute_force(rows, 20, lambda i: i % 100 == 0)


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    want = brute_force(rows, 20, lambda i: i % 20 == 0)
    got = found(ann.nearest(table, F.col("vec_id") % 20 == 0))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


# -- language -----------------------------------------------------------------

VOCABULARY = {"en": "the of and river house window bright thing with from they where", "de": "der die und nicht haus strasse schön über zwischen einen auch wird",
              "fr": "le la les des une maison rivière être avec pour dans où"}


def sentence(rng, lang, n):
    return " ".join(rng.choice(VOCABULARY[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, lang, 40), lang) for i, lang in enumerate(["en", "de", "fr"] * 60)] + [(900, None, "en"), (901, "x", None), (None, sentence(rng, "de", 9), "de")]
    return language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample_rows=1000)


def plain_posterior(rows, model):
    """The same fusion row by row."""
    langs = list(model.languages)
    n = len(langs)
    seen = []
    for _, text, declared, suffix, host in rows:
        e = model.evidence(text)
        name = lambda c: langs.index(c.lower()) if c and c.lower() in langs[:-1] else n - 1
        seen.append((e, int(e.argmax()), name((declared or "").split("-")[0]), name(suffix), (host or "").lower()))

    def named(k):
        counts = np.ones((n, n))
        for row in seen:
            counts[row[k], row[1]] += 1
        return np.log(counts / counts.sum(axis=0))

    voters = [row for row in seen if row[0].any()]
    votes = lambda keep: np.bincount([row[1] for row in voters if keep(row[4])], minlength=n).astype(float)
    whole = votes(lambda h: True) + 1
    out = []
    for e, best, d, s, host in seen:
        prior = whole / whole.sum()
        for depth in (1, 2, 99):
            tail = ".".join(host.split(".")[-depth:])
            own = votes(lambda h: ".".join(h.split(".")[-depth:]) == tail)
            prior = (own + language.STRENGTH * prior) / (own.sum() + language.STRENGTH)
        if not any(row[4] == host for row in voters):
            prior = np.full(n, 1 / n)
        log = e + np.log(prior) + named(2)[d] + named(3)[s]
        out.append((langs[int(log.argmax())], 1 / np.exp(log - log.max()).sum()))
    return out


def test_posterior_equals_the_row_by_row_fusion(spark, model):
    rng = random.Random(9)
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "de", "fr"])
        text = sentence(rng, lang, rng.choice([0, 1, 2, 30]))
        rows.append((i, text, rng.choice([lang, lang, "en-GB", "xx", None]), rng.choice([lang, None, "com"]), rng.choice([f"{lang}.a.org", "b.net", "x.b.net", None])))
    rows += [(None, None, None, None, None), (5, "123 !!", "de", "de", "a.a.org"), (5, "123 !!", "de", "de", "a.a.org"), (91, sentence(rng, "fr", 20_000), None, None, "B.net")]
    frame = spark.createDataFrame(rows, "page_id bigint, text string, lang string, tail string, host string").withColumns({"id": F.lit(1), "best": F.lit(2), "prior": F.lit(3)})
    got = language.identify(frame, model, "page_id", F.col("text"), F.col("lang"), F.col("tail"), F.col("host")).collect()
    want = sorted(((i, lang, round(p, 9)) for (i, *_), (lang, p) in zip(rows, plain_posterior(rows, model))), key=repr)
    assert sorted(((r["page_id"], r["lang"], round(r["posterior"], 9)) for r in got), key=repr) == want
    empty = language.identify(frame.limit(0), model, "page_id", F.col("text"), F.col("lang"), F.col("tail"), F.col("host"))
    assert empty.count() == 0


def test_unknown_languages_and_texts_without_letters_are_not_accepted(spark, model):
    rng = random.Random(1)
    rows = [(1, "Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше по дороге", "h.org"), (2, "123 456 !!", "h.org"), (3, sentence(rng, "de", 30), "h.org")]
    frame = spark.createDataFrame(rows, "page_id int, text string, host string")
    none = F.lit(None).cast("string")
    got = {r["page_id"]: (r["lang"], r["ok"]) for r in language.identify(frame, model, "page_id", F.col("text"), none, none, F.col("host")).withColumn("ok", language.accepted()).collect()}
    assert got[1] == (language.UNKNOWN, False) and not got[2][1] and got[3] == ("de", True)


def test_nothing_to_learn_from(spark):
    assert language.fit(spark.createDataFrame([], "doc_id int, text string, lang string")).languages == (language.UNKNOWN,)


def test_every_labelled_language_is_fitted_and_named(spark):
    letters = [chr(ord("a") + i) for i in range(26)]
    rng = random.Random(2)
    codes = [f"{a}{b}" for a in "xyz" for b in letters]
    words = {c: ["".join(rng.choices(letters, k=6)) for _ in range(6)] for c in codes}
    text = lambda c: " ".join(rng.choices(words[c], k=30))
    spelled = [lambda c: c, str.upper, lambda c: f"{c}-CA", lambda c: f" {c}_Hans"]
    rows = [(i, text(c), spelled[i % 4](c), "h.org") for i, c in enumerate(codes * 8)] + [(9000 + i, text("xa"), lang, "h.org") for i, lang in enumerate(["und", "", " ", None])]
    rows += [(9100, "ein wort", "中文", None), (9101, "noch eins", "हिन्दी", None), (9102, "und eins", "12", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, host string")
    fitted = language.fit(docs, min_rows=0)
    assert fitted.languages == (*sorted([*codes, "中文", "हिन्दी", "12"]), language.UNKNOWN) and fitted.left_out == (0, 0)
    got = language.identify(docs, fitted, "doc_id", F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("host")).where("doc_id < 9000").withColumn("ok", language.accepted())
    assert {(r["doc_id"], r["lang"], r["ok"]) for r in got.collect()} == {(i, codes[i % len(codes)], True) for i in range(len(codes) * 8)}
    named = spark.createDataFrame([(c,) for c in ("XA", "xa-Latn", "en", "", None, "und", "中文")], "c string").select(language._named(F.col("c"), fitted.languages).alias("n"))
    at = {lang: i for i, lang in enumerate(fitted.languages)}
    assert [r["n"] for r in named.collect()] == [at["xa"], at["xa"], None, None, None, None, at["中文"]]


def test_page_parts(spark):
    page = "<!DOCTYPE html><HTML class=a lang='fr-CA'><head><script>var t='<p>';</script><style>p{}</style></head><body><!-- no <p> --><p>Un&eacute; <b>deux</b></p></body></html>"
    rows = [(page, "https://u@www.site.de:80/x/y"), ("<p>plain", "http://a.example.com/fr/9?p=1"), ("", "no url"), (None, None), ("<html><head lang=en>", "http://h.co.uk")]
    frame = spark.createDataFrame(rows, "html string, url string")
    got = [tuple(r) for r in frame.select(*language.page_evidence(F.col("html"), F.col("url")), language.page_text(F.col("html"))).collect()]
    assert [g[:3] for g in got] == [("fr", "de", "www.site.de"), ("", "fr", "a.example.com"), ("", "", ""), (None, None, None), ("", "uk", "h.co.uk")]
    assert got[0][3].split() == ["Un", "deux"]


def test_documents_in_known_languages_are_accepted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs, language.fit(docs), "doc_id", F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("source"))
    right = got.join(docs.select("doc_id", F.col("lang").alias("true")), "doc_id").agg(F.avg((F.col("lang") == F.col("true")).cast("int")), F.avg(language.accepted().cast("int"))).first()
    assert right[0] > 0.99 and right[1] > 0.99


# -- tool calls -----------------------------------------------------------------

SCHEMAS = {"sum": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["number", "null"]}, "c": {"type": "array", "items": {"type": "string"}, "maxItems": 2}},
                   "additionalProperties": False}}
CALLS = "conv_id bigint, turn bigint, call_id string, name string, arguments string, after array<string>"
RESULTS = "conv_id bigint, turn bigint, call_id string, content string"


def test_linked_calls(spark):
    calls = [(1, 5, "c", "sum", '{"b":1.50,"a":2.0}', ["a", "b"]), (1, 1, "a", "sum", '{"a":1,"c":["x"]}', []), (1, 3, "b", "sum", '{"a":-1,"d":1,"c":["x",1,"z"]}', ["a", "zz", None, "a"]),
             (1, 1, "a", "sum", '{"a":1,"c":["x"]}', []), (1, 4, "a", "sum", '{"a":7}', []), (2, 0, "a", "none", "{}", None), (2, 1, "x", "sum", "{bad", ["y"]), (2, 2, "y", "sum", '{"a":1e400}', ["x"]),
             (2, 3, "z", "sum", '{"a":0}', ["y"]), (None, 0, "q", "sum", "{}", []), (3, 0, None, None, None, None), (4, None, "n", None, None, None), (5, 0, "long", "sum", json.dumps({"a": 1, "c": ["é\n" * 50_000]}), [])]
    results = [(1, 2, "a", "first"), (1, 6, "a", "second"), (1, 2, "a", "first"), (1, 7, "c", None), (9, 0, "a", "lost"), (1, None, None, "nobody")]
    extra = {"level": F.lit(1), "status": F.lit("s"), "first": F.lit(2), "parent": F.lit(3)}
    got = chat.link_calls(spark.createDataFrame(calls, CALLS).withColumns(extra), spark.createDataFrame(results, RESULTS).withColumns(extra), SCHEMAS).collect()
    rows = {(r["conv_id"], r["call_id"]): r for r in got}
    short = {k: (r["level"], r["status"], r["errors"]) for k, r in rows.items()}
    assert short == {
        (1, "a"): (0, "ok", "repeated call; repeated result"), (1, "b"): (1, "invalid", "$.d: unknown; $.a: too small; $.c: too long; $.c[1]: not string; no call zz"),
        (1, "c"): (2, "ok", ""), (2, "a"): (0, "invalid", "no such tool"), (2, "x"): (None, "cycle", "not JSON"), (2, "y"): (None, "cycle", "not JSON"), (2, "z"): (None, "cycle", ""),
        (4, "n"): (0, "invalid", "no such tool"), (5, "long"): (0, "no_result", ""), (9, "a"): (None, "orphan_result", ""),
        (None, "q"): (None, "unidentified", ""), (3, None): (None, "unidentified", ""), (1, None): (None, "unidentified", "")}
    assert len(got) == len(rows)
    assert rows[(1, "c")]["json"] == '{"after":["a","b"],"arguments":{"a":2,"b":1.5},"call_id":"c","name":"sum","result":null}'
    assert rows[(1, "a")]["json"].endswith('"result":"first"}')
    empty = chat.link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS)
    assert empty.count() == 0


@pytest.mark.parametrize("task_edges", [0, 30, 1000])
def test_levels_are_longest_chains(spark, task_edges):
    rng = random.Random(6)
    nodes = [(conv, f"n{k:02}") for conv in (1, 2, 3) for k in range(30)]
    edges = [(conv, f"n{a:02}", f"n{b:02}") for conv in (1, 2) for a in range(30) for b in range(a) if rng.random() < 0.05 * conv]
    want = {}
    for conv, n in nodes:
        want[conv, n] = max([want[conv, p] + 1 for k, c, p in edges if (k, c) == (conv, n)], default=0)
    loop = [(3, "n01", "n02"), (3, "n02", "n01"), (3, "n03", "n02"), (3, "n04", "n05")]
    for n in ("n01", "n02", "n03"):
        del want[3, n]
    want[3, "n04"] = 1
    frame = spark.createDataFrame(edges + loop, "conv_id bigint, call_id string, parent string")
    got = chat.levels(spark.createDataFrame(nodes, "conv_id bigint, call_id string"), frame, task_edges).collect()
    assert len(got) == len(want) and {(r["conv_id"], r["call_id"]): r["level"] for r in got} == want


def test_every_turn_has_a_row(spark):
    rows = [(1, 0, "user", "hello"), (1, 1, "Assistant", "hi"), (1, 2, "tool", "42"), (1, 3, None, "who"), (1, None, "user", "a"), (1, None, "user", "b"), (None, 0, "user", "lost"),
            (2, 0, "SYSTEM", "be brief"), (2, 1, "user", ""), (2, 2, "assistant", None), (3, 4, "assistant", "alone"), (4, 0, "", "no role")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("name", F.lit("x"))
    got = sorted(((r["conv_id"], r["turn"], r["status"], r["json"]) for r in chat.link_calls(*chat.turn_calls(frame), chat.TURN_TOOLS).collect()), key=repr)
    assert [(c, t, s) for c, t, s, _ in got] == sorted([
        (1, 0, "ok"), (1, 2, "unidentified"), (1, 3, "unidentified"), (1, None, "unidentified"), (1, None, "unidentified"), (None, 0, "unidentified"),
        (2, 0, "no_result"), (2, 1, "invalid"), (3, 4, "orphan_result"), (4, 0, "unidentified")], key=repr)
    text = " ".join(j for *_, j in got)
    assert all(f'"{t}"' in text for _, _, _, t in rows if t)  # no turn's text is missing


def test_every_turn_has_a_row_by_sql(spark):
    import duckdb

    from coursewise.llm import queries
    rows = [(1, 0, "user", "hello"), (1, 1, "Assistant", "hi"), (1, 2, "tool", "42"), (1, 3, None, "who"), (1, None, "user", "a"), (1, None, "user", "b"), (None, 0, "user", "lost"), (5, 0, "User", "x")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(queries.OP8_SQL)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.link_calls(*chat.turn_calls(frame), chat.TURN_TOOLS).select(*[d[0] for d in want.description])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_canonical_json():
    assert chat.canonical_json({"b": [1.0, 2.5, True, None], "a": {"é": " \n", "z": -0.0}}) == '{"a":{"z":0,"é":" \\n"},"b":[1,2.5,true,null]}'
    with pytest.raises(ValueError):
        chat.canonical_json(float("nan"))


# -- quality ----------------------------------------------------------------------


def test_encoding_by_pieces_counts_every_passage(monkeypatch):
    words = " ".join(["Word", "again!", "x"] * 100)
    features, counts = quality.encode([words, None, "", " \n", "é" * 10])
    assert counts.tolist() == [5, 1, 1, 1, 1] and features.shape == (9, quality.FEATURES) and np.isfinite(features).all()
    alone = [quality.encode([t])[0] for t in (words, None, "", " \n", "é" * 10)]
    np.testing.assert_allclose(features, np.concatenate(alone))
    monkeypatch.setattr(quality, "BLOCK_CHARS", 100)
    pieces, counts = quality.encode([words, "tail"])
    assert counts.tolist()[1] == 1 and len(pieces) == counts.sum() > 5


def test_gradient_descent_finds_the_passage_that_matters():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 12, 800)
    x = rng.normal(size=(counts.sum(), quality.FEATURES))
    doc = np.repeat(np.arange(800), counts)
    labels = np.array([float(x[doc == d, 3].max() < 1.2) for d in range(800)])
    x[:, 3] = np.where(x[:, 3] >= 1.2, 3.0, x[:, 3])
    model = quality.train(x[doc < 600], counts[:600], labels[:600])
    score = model.forward(model.scaled(x[doc >= 600]), counts[600:])[-1]
    assert ((score > 0.5) == labels[600:]).mean() > 0.9


def test_one_class_or_nothing_to_learn_from(spark, make_docs):
    labels = "doc_id bigint, quality int"
    none = quality.fit(make_docs([]), spark.createDataFrame([], labels))
    assert none.score(["a", None]).tolist() == pytest.approx([0.5, 0.5])
    one = quality.fit(make_docs([(1, "good", None, None), (2, None, None, None)]), spark.createDataFrame([(1, 1), (2, 1), (3, 1), (None, 0), (1, None)], labels))
    assert one.score(["anything"])[0] == pytest.approx(0.75)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    scored = docs.join(labels.where(quality.held_out()), "doc_id").select("quality", (quality.scores(model) >= quality.THRESHOLD).alias("kept"))
    got = {r["quality"]: r["avg(kept)"] for r in scored.withColumn("kept", F.col("kept").cast("int")).groupBy("quality").avg("kept").collect()}
    assert got[1] > 0.99 and got[0] < 0.05


def test_junk_labels_are_counted_and_do_not_become_languages(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, lang, 12), lang) for i, lang in enumerate(["en", "de"] * 40)]
    rows += [(1000 + k, sentence(rng, "en", 12), f"junk{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}") for k in range(5000)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == ("de", "en", language.UNKNOWN) and model.left_out == (5000, 5000) and model.log_p.shape == (3, language.BUCKETS)


def test_a_labelled_id_with_a_third_of_the_rows_is_drawn_row_by_row(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.format_string("text %d of many words", F.col("id")).alias("text"))
    rows = rows.union(spark.range(2000).select(F.lit(8).cast("bigint"), F.lit("one text")))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    train, quality.train = quality.train, lambda features, counts, y, *a: seen.append((len(counts), len(y))) or train(features, counts, y, 1)
    try:
        quality.fit(rows, labels.union(labels.limit(100)), sample_rows=500)
    finally:
        quality.train = train
    assert 150 < seen[0][0] == seen[0][1] < 500  # of 5,000 rows with a label; the 1,999 repeated ones count once


def plain_score(model, texts):
    """The forward pass, passage by passage and number by number."""
    p, out = model.weights, []
    for text in texts:
        features, _ = quality.encode([text])
        hidden, gates = [], []
        for x in model.scaled(features):
            h = [math.tanh(sum(x[i] * p["W"][i, j] for i in range(len(x))) + p["b"][j]) for j in range(quality.HIDDEN)]
            t = [math.tanh(sum(h[i] * p["V"][i, j] for i in range(len(h)))) for j in range(len(h))]
            u = [1 / (1 + math.exp(-sum(h[i] * p["U"][i, j] for i in range(len(h))))) for j in range(len(h))]
            hidden.append(h)
            gates.append(sum(a * b * c for a, b, c in zip(t, u, p["w"])))
        weight = [math.exp(g - max(gates)) for g in gates]
        z = [sum(w * h[j] for w, h in zip(weight, hidden)) / sum(weight) for j in range(quality.HIDDEN)]
        out.append(1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, p["c"])) + float(p["d"])))))
    return out


def small_model(seed=1):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 6, 60)
    x = rng.normal(size=(counts.sum(), quality.FEATURES))
    return quality.train(x, counts, rng.integers(0, 2, 60).astype(float), epochs=2), x, counts, rng.integers(0, 2, 60).astype(float)


def test_scores_equal_the_plain_forward_pass(spark, make_docs):
    model = small_model()[0]
    texts = [None, "", "one", "Some words, and MORE! " * 200, "#$%& 1 2 3\n" * 90, "é ü ß " * 70]
    got = {r["doc_id"]: r["score"] for r in make_docs([(i, t, None, None) for i, t in enumerate(texts)]).select("doc_id", quality.scores(model).alias("score")).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(plain_score(model, texts), abs=1e-9)


def test_gradients_equal_numeric_ones():
    model, x, counts, y = small_model()

    def loss():
        s = model.forward(x, counts)[-1]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, g in model.gradient(x, counts, y).items():
        w = model.weights[name] = np.array(model.weights[name], float)
        flat, want = w.reshape(-1), np.zeros(w.size)
        for i in range(w.size):
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = loss()
            flat[i] = keep - 1e-5
            want[i] = (up - loss()) / 2e-5
            flat[i] = keep
        assert np.allclose(np.ravel(g), want, atol=1e-7), name


# -- pipeline ---------------------------------------------------------------------


def test_pipeline_stages_over_odd_rows(spark, make_docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    rows = []
    for i in range(60):
        lang = ["en", "de", "fr"][i % 3]
        text = "\n".join(sentence(rng, lang, 12).capitalize() + "." for _ in range(4))
        rows.append((i, text + "\nshared frame line of all sites", lang, f"s{i % 12}"))
        if i % 4 == 0:
            rows.append((100 + i, rows[-1][1].replace(" ", "  "), lang, f"s{i % 7}"))
    junk = [(200 + i, " ".join(rng.choice("###") + w + rng.choice(["***", "%%%"]) for w in sentence(rng, "en", 60).split()), "en", "s1") for i in range(30)]
    odd = [(None, rows[0][1], None, None), (300, None, "en", None), (301, "", None, "s2"), (5, rows[5][1], "de", "s5"), (302, "word " * 30_000, "en", "s3")]
    docs = make_docs(rows + junk + odd)
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows] + [(r[0], 0, 0) for r in junk], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)
    clean = {r[0] for r in rows}

    kept = corpus_pipeline.quality_stage(spark, docs, sf)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert clean <= ids and not ids & {r[0] for r in junk}
    kept = corpus_pipeline.language_stage(spark, docs, sf)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and clean <= ids and not ids & {300, 301}
    cut = corpus_pipeline.line_stage(spark, docs, sf)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r["doc_id"]: r for r in cut.where("doc_id < 100").collect()}
    assert all("shared frame" not in r["text"] and r["n_chars"] == len(r["text"]) and r["lines_removed"] == 6 for r in texts.values())
    near = corpus_pipeline.near_duplicate_stage(spark, docs, sf)
    ids = {r["doc_id"] for r in near.select("doc_id").collect()}
    assert near.columns == docs.columns and set(range(60)) <= ids and not ids & set(range(100, 160)) and None not in ids
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_line_stage_cuts_every_shared_line_and_leaves_copies_whole(spark, make_docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    frame = "Licensed under the Apache License, Version 2.0."
    short = [(i, f"own words {i}\n{frame}", "en", f"s{i}") for i in range(12)]
    mirrored = [(50 + i, f"page {i} of a site that is mirrored\nframe of the mirrored sites", "en", site) for i in range(12) for site in (f"s{i}", "a mirror")]
    own = "\n".join(f"{j} " + sentence(rng, "de", 30) for j in range(8))
    exact = [(100 + i, own, "de", f"s{i}") for i in range(12)]
    other = "\n".join(f"{j} " + sentence(rng, "fr", 400) for j in range(8))
    near = [(200 + i, f"{other}\ncopy{i}", "fr", f"s{i}") for i in range(12)]
    one_site = [(300 + i, f"text {i} on one site\nframe of one site only", "en", "s3") for i in range(12)] + [(320 + i, "frame of one site only", "en", f"s{i}") for i in range(12)]
    docs = make_docs(short + mirrored + exact + near + one_site + [(400, None, None, None)])
    got = {}
    for r in corpus_pipeline.line_stage(spark, docs, str(tmp_path)).collect():
        got.setdefault(r["doc_id"], set()).add((r["text"], r["n_chars"]))
    whole = lambda t: {(t, len(t))}
    assert all(got[i] == whole(f"own words {i}") for i in range(12))
    assert all(got[50 + i] == whole(f"page {i} of a site that is mirrored") for i in range(12))
    assert all(got[i] == whole(t) for i, t, *_ in exact + near + one_site) and got[400] == {(None, None)}


def test_stages_decide_by_row_where_ids_repeat_or_are_missing(spark, make_docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(7)
    texts = [sentence(rng, lang, 60) for lang in ["en", "de", "fr"] * 8]
    foreign = "Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше по дороге"
    rows = [(i, t, ["en", "de", "fr"][i % 3], "s1") for i, t in enumerate(texts)]
    odd = [(None, foreign, None, "s1"), (None, "123 !!", None, None), (None, None, None, None), (3, foreign, None, "s1"), (None, texts[0] + "!", "en", "s1")]
    got = corpus_pipeline.language_stage(spark, make_docs(rows + odd), str(tmp_path))
    assert sorted(map(repr, (r[:4] for r in got.collect()))) == sorted(map(repr, rows + odd[-1:]))

    alone = sentence(rng, "de", 50), sentence(rng, "fr", 50), sentence(rng, "en", 50)
    again = [rows[2], (2, texts[2], "xx", "s9"), (2, alone[0], "de", "s1"), (9, texts[1].replace(" ", "  "), "de", "s1"), (None, texts[4], "de", "s1"),
             (None, alone[1], "fr", "s1"), (None, alone[1], "fr", "s1"), (None, alone[1].replace(" ", "  "), "fr", "s1"), (None, alone[2], "en", None), (50, None, None, None), (50, "", None, None)]
    got = [tuple(r[:4]) for r in corpus_pipeline.near_duplicate_stage(spark, make_docs(rows + again), str(tmp_path)).collect()]
    near = [r for r in got if r[0] == 50 or r[0] is None and r[1].split() == alone[1].split()]
    assert len(near) == 2 and {r[0] for r in near} == {50, None}
    assert sorted(map(repr, (r for r in got if r not in near))) == sorted(map(repr, [*rows, again[2], again[8]]))


def test_pipeline_run(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    seen = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert seen.where("n > 4096 or n <> end").count() == 0 and out.count() > 100
