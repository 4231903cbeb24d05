"""Operator 6: language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior: the likelihood of the text under
character trigram models, the language the markup declares, the one the
address names, and a prior of the host.  The host's prior is its own counts
smoothed towards its domain's, these towards its top-level domain's, these
towards the whole corpus, all counts coming from grouped aggregations over the
languages that the text alone suggests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_CHARS, text_batches, written

#: Labelled rows per language that the text models are fitted on (expected number; chosen by a hash of the id).
SAMPLE_ROWS = 1000
#: Labelled rows that a language needs to be fitted, so that misspelt labels do not become languages.
MIN_ROWS = 3
BUCKETS = 1 << 13
#: A text counts as at most this many independent trigrams: neighbours are not independent.
EVIDENCE = 60
#: Share of a text that may be anything (names, keys, numbers' neighbours): what an unknown language costs a known one
#: is at most this factor a trigram, so that a short text with one odd word is not taken for an unknown language.
NOISE = 0.1
#: Rows of the parent level that a host, domain or top-level domain is smoothed with.
STRENGTH = 20.0
MIN_POSTERIOR = 0.5
UNKNOWN = "und"


def trigram_buckets(text: str) -> np.ndarray:
    """Buckets of the character trigrams over letters; everything else is one separator."""
    letters = "".join([c if c.isalpha() else " " for c in text.lower()]) if not text.isascii() else text.lower().translate(_ASCII)
    code = np.frombuffer((" " + " ".join(letters.split()) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(code) < 3:
        return np.empty(0, np.int64)
    mixed = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ code[2:] * np.uint64(0x165667B19E3779F9))
    return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 13)).astype(np.int64)


_ASCII = {c: " " for c in range(128) if not chr(c).isalpha()}


@dataclass(frozen=True)
class TextModel:
    """Log probabilities (language x bucket); the last language is ``UNKNOWN``, uniform over buckets.

    ``left_out`` counts the labels that had too few rows to be fitted, and their rows.
    """

    languages: tuple[str, ...]
    log_p: np.ndarray
    left_out: tuple[int, int] = (0, 0)

    def evidence(self, text: str | None) -> np.ndarray:
        """Log likelihood of the text per language, scaled to at most ``EVIDENCE`` trigrams; zeros without letters."""
        total, n = np.zeros(len(self.languages)), 0
        text = text or ""
        for i in range(0, len(text), BLOCK_CHARS):
            buckets = trigram_buckets(text[i:i + BLOCK_CHARS])
            n += len(buckets)
            total += np.bincount(buckets, minlength=BUCKETS) @ self.log_p.T
        return total * (min(n, EVIDENCE) / n) if n else total


def _code(column: Column) -> Column:
    """The language of a code: its first letters in lower case (fr of fr-CA), the whole code if it has none; null for none or ``und``."""
    code = F.lower(F.trim(column.cast("string")))
    first = F.regexp_extract(code, r"^([\p{L}\p{M}]+)", 1)
    code = F.when(first != "", first).otherwise(code)
    return F.when((code != "") & (code != UNKNOWN), code)


def _index(code: Column, languages: Sequence[str]) -> Column:
    """The place of a code among ``languages``; null for none of them."""
    at = F.array_position(F.array(*map(F.lit, languages)).cast("array<string>"), code)
    return F.when(at > 0, (at - 1).cast("int"))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS,
        min_rows: int = MIN_ROWS) -> TextModel:
    """Trigram models from about ``sample_rows`` rows of each language of ``labelled``.

    Every language that has at least ``min_rows`` labelled rows is fitted (0
    fits all); EN and fr-CA count as en and fr.  How many labels have fewer,
    and on how many rows, is kept in the model: such rows have no model of
    their own and come out as whatever else fits, or as ``und``.  Rows without
    language or text teach nothing, rows that repeat id and text teach alike.  What
    reaches the driver is a count per fitted language and bucket, 64 KB a
    language, whatever the size of the table and the number of other labels.
    """
    text_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _code(F.col(lang_col)).alias("lang")).where("lang is not null and text is not null")
    counted = written(rows.groupBy("lang").count(), "label_counts")
    left_out = counted.where(F.col("count") < min_rows).agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    sizes = {r["lang"]: r["count"] for r in counted.where(F.col("count") >= min_rows).collect()}
    if not sizes:
        return TextModel((UNKNOWN,), np.full((1, BUCKETS), -math.log(BUCKETS)), tuple(left_out))
    languages = sorted(sizes)
    shares = F.array(*[F.lit(min(1.0, sample_rows / sizes[lang])) for lang in languages])
    # drawn by id and text: many rows under one id are drawn one by one
    chosen = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < F.get(shares, _index(F.col("lang"), languages)) * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for i in range(0, len(text), BLOCK_CHARS):
                    totals[lang] = totals.get(lang, 0) + np.bincount(trigram_buckets(text[i:i + BLOCK_CHARS]), minlength=BUCKETS)
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts, at = np.zeros((len(languages), BUCKETS)), {lang: i for i, lang in enumerate(languages)}
    for r in counted.collect():
        counts[at[r["lang"]], r["bucket"]] = r["n"]
    p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    p = (1 - NOISE) * p + NOISE / BUCKETS
    return TextModel((*languages, UNKNOWN), np.log(np.vstack([p, np.full(BUCKETS, 1 / BUCKETS)])), tuple(left_out))


def _confusion(rows: DataFrame, column: str, languages: Sequence[str]) -> np.ndarray:
    """Log P(what the column names | text language), one row per named language and a last one for none; add-one smoothed."""
    n = len(languages)
    counts = np.ones((n, n))
    for r in rows.groupBy("best", column).count().collect():  # at most n * n rows
        counts[r[column] if r[column] is not None else n - 1, r["best"]] += r["count"]
    return np.log(counts / counts.sum(axis=0))


def _named(column: Column, languages: Sequence[str]) -> Column:
    """The index of the language that a code such as fr or fr-CA names; null for none or another."""
    return _index(_code(column), languages[:-1])


def host_priors(votes: DataFrame, n: int, strength: float = STRENGTH) -> DataFrame:
    """(host, prior array) from rows (host, best), host being a dotted name or any label.

    Level by level, counts are smoothed with ``strength`` rows of the level
    above: host, its last two labels, its last label, all rows (add-one).
    """
    counts = [F.sum((F.col("best") == i).cast("long")).alias(f"n{i}") for i in range(n)]
    add = [F.sum(f"n{i}").alias(f"n{i}") for i in range(n)]
    hosts = written(votes.groupBy("host").agg(*counts).withColumns({
        "domain": F.substring_index("host", ".", -2), "top": F.substring_index("host", ".", -1)}), "hosts")
    whole = hosts.agg(*add).first()
    total = [(whole[i] or 0) + 1 for i in range(n)]
    prior = F.array(*[F.lit(x / sum(total)) for x in total])

    def smooth(level: DataFrame, key: str, above: Column) -> DataFrame:
        own = F.array(*[F.col(f"n{i}").cast("double") for i in range(n)])
        size = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
        return level.select(key, *([F.col(c) for c in level.columns if c == "top" and c != key]),
                            F.zip_with(own, above, lambda a, b: (a + strength * b) / (size + strength)).alias(f"{key}_prior"))

    tops = smooth(hosts.groupBy("top").agg(*add), "top", prior)
    domains = smooth(hosts.groupBy("domain", "top").agg(*add).join(tops, "top"), "domain", F.col("top_prior"))
    # a host belongs to one domain, a domain to one top: the joins multiply nothing
    return smooth(hosts.join(domains.drop("top"), "domain"), "host", F.col("domain_prior")).select("host", F.col("host_prior").alias("prior"))


def identify(rows: DataFrame, model: TextModel, id_col: str, text: Column, declared: Column, suffix: Column, host: Column,
             strength: float = STRENGTH) -> DataFrame:
    """(id, lang, posterior, text_lang, letters) of every row.

    ``lang`` is the language of the highest posterior (``und`` if no known one
    fits; ties go to the first in order), ``text_lang`` what the text alone
    says, ``letters`` whether the text has any.  A null text counts as empty:
    the other evidence decides.  A declaration or suffix that is null or names
    no known language is evidence of its own kind ("none"); a null host counts
    as one host.  Null and repeated ids give a result per row, an empty table
    none; other columns are not read.
    """
    text_batches(rows.sparkSession)
    languages = model.languages
    n = len(languages)
    source = rows.select(F.col(id_col).alias("id"), text.cast("string").alias("text"), _named(declared, languages).alias("declared"),
                         _named(suffix, languages).alias("suffix"), F.coalesce(F.lower(host.cast("string")), F.lit("")).alias("host"))
    id_type = source.schema["id"].dataType.simpleString()
    keep = ["id", "declared", "suffix", "host"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = np.array([model.evidence(t.as_py()) for t in batch.column("text")]).reshape(-1, n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(np.arange(len(evidence) + 1) * n, pa.int32()), pa.array(evidence.ravel())),
                 pa.array(evidence.argmax(axis=1).astype(np.int32)), pa.array(evidence.any(axis=1))], [*keep, "evidence", "best", "letters"])

    weighed = written(source.mapInArrow(weigh, f"id {id_type}, declared int, suffix int, host string, evidence array<double>, best int, letters boolean"), "evidence")
    tables = [_confusion(weighed, c, languages) for c in ("declared", "suffix")]
    priors = written(host_priors(weighed.where("letters"), n, strength), "host_priors")
    flat = [1.0 / n] * n  # hosts all of whose texts have no letters
    joined = weighed.join(priors, "host", "left").select(
        "id", "evidence", "best", "letters", "declared", "suffix", F.coalesce("prior", F.array(*map(F.lit, flat))).alias("prior"))

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            log = batch.column("evidence").flatten().to_numpy().reshape(-1, n) + np.log(batch.column("prior").flatten().to_numpy().reshape(-1, n))
            for column, table in zip(("declared", "suffix"), tables, strict=True):
                log = log + table[batch.column(column).fill_null(n - 1).to_numpy()]
            best = log.argmax(axis=1)
            posterior = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([languages[k] for k in best]), pa.array(posterior),
                                              pa.array([languages[k] for k in batch.column("best").to_pylist()]), batch.column("letters")],
                                             ["id", "lang", "posterior", "text_lang", "letters"])

    return joined.mapInArrow(fuse, f"id {id_type}, lang string, posterior double, text_lang string, letters boolean").withColumnRenamed("id", id_col)


def accepted(min_posterior: float = MIN_POSTERIOR) -> Column:
    """Whether a result of ``identify`` names a language: letters, a known language, and the posterior for it."""
    return F.col("letters") & (F.col("lang") != UNKNOWN) & (F.col("posterior") >= min_posterior)


def page_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags cut out, entities dropped."""
    html = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(html, r"(?s)<[^>]*>|&#?\w+;", " ")


def page_evidence(html: Column, url: Column) -> tuple[Column, Column, Column]:
    """(declared, suffix, host) of a page: the html element's lang, the country domain or else first path label, the host."""
    declared = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1)
    host = F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    top = F.substring_index(host, ".", -1)
    path = F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*/([a-zA-Z]{2})(?:[/?#-]|$)", 1)
    return declared, F.when((F.length(top) == 2) & (path == ""), top).otherwise(path), host
