"""Operator 10: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded from its
characters and words; gated attention, learned from document labels alone,
says how much each passage counts; the document's score is a logistic of the
weighted passage representation.  The model is a few kilobytes, so scoring is
one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import powers
from .common import BLOCK_CHARS, blocks, text_batches, written

#: Bound of the labelled sample that the classifier is fitted on (expected rows, chosen by a hash of id and text).
SAMPLE_ROWS = 6000
PASSAGE_WORDS = 64
HIDDEN = 16
EPOCHS = 30
THRESHOLD = 0.3

_BASE = 0xD6E8FEB86659FD93
# character classes of UTF-8 bytes; what is not listed below is "other"
_CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "space": " \t", "newline": "\n\r",
            "stop": ".,;:?'\"-", "exclaim": "!", "mark": "#$%&*@^~+=", "bar": "|/\\_", "bracket": "()[]{}<>", "control": "", "wide": "", "other": ""}
_NAMES = list(_CLASSES)
_K = len(_NAMES)
FEATURES = _K + 9


def _class_table() -> np.ndarray:
    table = np.full(256, _NAMES.index("other"), np.int64)
    table[:32], table[128:] = _NAMES.index("control"), _NAMES.index("wide")
    for k, chars in enumerate(_CLASSES.values()):
        table[[ord(c) for c in chars]] = k
    return table


_TABLE = _class_table()


def _encode_block(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passage features, passages of each unit); a unit without words is one passage."""
    raw = [u.encode() + b"\n" for u in units]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    kind = _TABLE[data]
    blank = (kind == _NAMES.index("space")) | (kind == _NAMES.index("newline"))
    begins = ~blank
    begins[1:] &= blank[:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(blank & np.append(False, ~blank[:-1]))
    unit_start = np.cumsum(size) - size
    unit = np.searchsorted(unit_start, start, "right") - 1
    words = np.bincount(unit, minlength=len(units))
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.cumsum(passages) - passages
    n = int(passages.sum())
    rank = np.arange(len(start)) - (np.cumsum(words) - words)[unit]
    passage = base[unit] + rank // PASSAGE_WORDS
    opens = np.zeros(n, np.int64)
    first = rank % PASSAGE_WORDS == 0
    opens[passage[first]] = start[first]
    opens[base] = unit_start
    of_byte = np.repeat(np.arange(n), np.diff(np.append(opens, len(data))))
    chars = np.bincount(of_byte * _K + kind, minlength=n * _K).reshape(n, _K).astype(float)
    count = np.bincount(passage, minlength=n).astype(float)
    some = np.maximum(count, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, minlength=n) / some

    length = (end - start).astype(float)
    up, down = powers(_BASE, len(data))
    total = np.append(np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * up))
    word = (total[end] - total[start]) * down[start]
    order = np.lexsort((word, passage))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (word[order][1:] != word[order][:-1]) | (passage[1:] != passage[:-1])
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])
    opening, closing = kind[start], kind[end - 1]
    average = mean(length)
    features = np.column_stack([
        chars / chars.sum(axis=1, keepdims=True), average / 10, np.sqrt(np.maximum(0, mean(length ** 2) - average ** 2)) / 10, mean(length >= 16),
        np.bincount(passage[order], fresh, minlength=n) / some, mean(again), mean(opening == _NAMES.index("upper")),
        mean((closing == _NAMES.index("mark")) | (closing == _NAMES.index("exclaim"))), np.log1p(count) / 4, chars[:, _NAMES.index("newline")] / some])
    return features, passages


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(passage features, passages of each text) over whole texts; null counts as empty.

    A very long text is encoded in pieces of a block, so memory does not grow with it but for its features.
    """
    owner, units = [], []
    for i, text in enumerate(texts):
        text = text or ""
        for a in range(0, max(1, len(text)), BLOCK_CHARS):
            owner.append(i)
            units.append(text[a:a + BLOCK_CHARS])
    parts = [_encode_block(units[i:j]) for i, j in blocks(units)]
    if not parts:
        return np.empty((0, FEATURES)), np.empty(0, np.int64)
    counts = np.bincount(owner, np.concatenate([n for _, n in parts]), len(texts)).astype(np.int64)
    return np.concatenate([x for x, _ in parts]), counts


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups, none empty."""
    return np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class AttentionModel:
    """Feature scaling and the weights of encoder, gated attention and output."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * u) @ p["w"]
        doc = np.repeat(np.arange(len(counts)), counts)
        a = np.exp(e - np.maximum.reduceat(e, np.cumsum(counts) - counts)[doc])
        a /= _sums(a, counts)[doc]
        z = _sums(a[:, None] * h, counts)
        return h, t, u, a, doc, z, _sigmoid(z @ p["c"] + p["d"])

    def gradient(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss of labelled bags by every weight."""
        p = self.weights
        h, t, u, a, doc, z, score = self.forward(x, counts)
        dl = (score - labels) / len(counts)
        dz = dl[:, None] * p["c"]
        da = (h * dz[doc]).sum(axis=1)
        de = a * (da - _sums(a * da, counts)[doc])
        dt, du = (de[:, None] * p["w"] * k for k in (u * (1 - t * t), t * u * (1 - u)))
        dh = (a[:, None] * dz[doc] + dt @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ du, "w": (t * u).T @ de, "c": z.T @ dl, "d": dl.sum()}

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -5, 5)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text between 0 and 1."""
        out = [np.empty(0)]
        for i, j in blocks(texts):
            features, counts = encode(texts[i:j])
            out.append(self.forward(self.scaled(features), counts)[-1])
        return np.concatenate(out)


def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> AttentionModel:
    """Fit by Adam on the log loss; bags are shuffled by a fixed seed, so equal input gives an equal model.

    Without labels, or with one class only, the score tends to that class's smoothed share.
    """
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    f = features.shape[1]
    weights = {"W": rng.normal(0, f ** -0.5, (f, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, HIDDEN)),
               "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, HIDDEN)), "w": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "c": np.zeros(HIDDEN),
               "d": np.array(np.log(share / (1 - share)))}
    mean = features.mean(axis=0) if len(features) else np.zeros(f)
    scale = np.maximum(features.std(axis=0), 1e-3) if len(features) else np.ones(f)
    model = AttentionModel(mean, scale, weights)
    if len(np.unique(labels)) < 2:
        return model
    bags = np.split(model.scaled(features), np.cumsum(counts)[:-1])
    m = {k: np.zeros_like(v) for k, v in weights.items()}
    s = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 1e-4
        order = rng.permutation(len(bags))
        for i in range(0, len(order), 128):
            pick = order[i:i + 128]
            x, n, y = np.concatenate([bags[k] for k in pick]), counts[pick], labels[pick]
            step += 1
            for k, g in model.gradient(x, n, y).items():
                g = g + 1e-4 * weights[k] * (k != "d")
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                weights[k] = weights[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> AttentionModel:
    """The model learned from about ``sample_rows`` rows of ``labels`` and the texts of ``docs`` with their ids.

    Labels with a null id or label teach nothing; an id and label that are
    repeated count once, other labels of an id teach each for itself.  Rows
    under one id are drawn one by one, by their text (rows that repeat it
    once), so an id with a third of all rows is a third of the sample at most.
    All passages of a drawn text teach, however long it is.  Without
    documents or labels, or with one class only, the score is that class's
    smoothed share.  Only features of the sample reach the driver.
    """
    text_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("id is not null and label is not null")
    known = written(known.distinct(), "known_labels")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    per_id = rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).join(known, "id")
    share = min(1.0, sample_rows / max(1, per_id.agg(F.sum("rows")).first()[0] or 0))
    # drawn before they are joined: about sample_rows rows of all that have a label
    drawn = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["id", "text"])
    sample = drawn.join(known, "id").select("id", "text", "label")
    id_type = sample.schema["id"].dataType.simpleString()

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            features, counts = encode(batch.column("text").to_pylist())
            for x in np.split(features, np.cumsum(counts)[:-1]) if len(counts) else ():
                kept.append(x.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(kept, pa.binary())], ["id", "label", "bag"])

    rows = sample.mapInArrow(bags, f"id {id_type}, label double, bag binary").orderBy("id", "label", "bag").collect()
    found = [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    labelled = np.array([r["label"] for r in rows])
    counts = np.array([len(x) for x in found], np.int64)
    return train(np.concatenate(found) if found else np.empty((0, FEATURES)), counts, (labelled > 0.5).astype(float))


def scores(model: AttentionModel, text_col: str = "text") -> Column:
    """The score of a text column, between 0 and 1; null counts as empty, ties and repeats get equal scores.

    Whole texts are scored, very long ones in pieces; an empty table has no scores.
    """
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.where(texts.notna(), None).tolist()), dtype="float64")

    return F.pandas_udf(run, "double")(F.col(text_col).cast("string"))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is divisible by five."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
