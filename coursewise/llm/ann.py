"""Operator 5: approximate nearest neighbours over shifted space-filling curves.

Vectors are projected a few times at random, each time shifted and put in
Hilbert order; Spark range-partitions each order.  A query meets the vectors
whose places on a curve lie within a window around its own; what its windows
hold is reranked by the exact inner product and merged over the curves.

For inner products of vectors of different lengths, a vector gets one more
coordinate that brings all of them to the longest one's length, and a query is
scaled to that length with zero there: the largest inner product is then the
nearest direction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 20
CURVES = 8
#: Share of all distinct vectors that a window spans on each side of the query.  Directions without structure, as in
#: the given table, have no near places on any curve: there recall follows this share, whatever the size of the table.
WINDOW = 0.1
DIMENSIONS, BITS = 8, 4
#: Distinct vectors that the cell borders of the curves are fitted on (expected number).
SAMPLE_ROWS = 4096
_BLOCK, _QUERIES = 4096, 1024
#: Pairs of a unit whose exact scores are compared at once.
_PLAY = 1 << 16


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate."""
    x = cells.T.astype(np.int64).copy()
    for q in (1 << b for b in range(bits - 1, 0, -1)):  # undo the turns, high bits first
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & q) > 0, q - 1, 0)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            place = place << 1 | row >> b & 1
    return place


class Curves:
    """Projections, cell borders and shifts of all curves, for vectors of up to ``size`` coordinates and length ``longest``."""

    def __init__(self, sample: np.ndarray, size: int, longest: float, curves: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.size, self.longest = size, longest
        dims = min(DIMENSIONS, size + 1)
        self.projections = [np.linalg.qr(rng.standard_normal((size + 1, dims)))[0] for _ in range(curves)]
        lifted = self.lift(sample, False)
        self.borders = [np.sort(lifted @ p, axis=0) for p in self.projections]
        self.shifts = [rng.uniform(0, 0.5, dims) for _ in range(curves)]

    def lift(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        square = (vectors ** 2).sum(axis=1)
        if query:
            return np.column_stack([vectors / np.sqrt(square)[:, None], np.zeros(len(vectors))])
        return np.column_stack([vectors / self.longest, np.sqrt(np.maximum(0, 1 - square / self.longest ** 2))])

    def places(self, vectors: np.ndarray, query: bool) -> Iterator[np.ndarray]:
        """Place of each vector on every curve; a cell is the share of the sample below it, moved by the curve's shift."""
        lifted = self.lift(vectors, query)
        for p, borders, shift in zip(self.projections, self.borders, self.shifts, strict=True):
            flat = lifted @ p
            share = np.column_stack([np.searchsorted(b, f) for b, f in zip(borders.T, flat.T, strict=True)]) / max(1, len(borders))
            yield hilbert_index(np.minimum((share + shift) / 1.5 * (1 << BITS), (1 << BITS) - 1).astype(np.int64), BITS)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows of doubles, short ones padded with zeros."""
    out = np.zeros((len(column), size))
    length = np.asarray(column.value_lengths())
    out[np.arange(size) < length[:, None]] = np.asarray(column.flatten(), float)
    return out


def _ranked(classes: DataFrame, curves: Curves) -> DataFrame:
    """(curve, cid, vec, query, at, nth): number of data rows before a row on a curve, and of queries before it."""
    vec_type = classes.schema["vec"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vec"), curves.size)
            asked = np.asarray(batch.column("asked").to_numpy(zero_copy_only=False), bool)
            for query, rows in ((False, np.arange(len(vectors))), (True, np.flatnonzero(asked))):
                for c, at in enumerate(curves.places(vectors[rows], query)) if len(rows) else ():
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), c, np.int32)), pa.array(at), batch.column("cid").take(take), batch.column("vec").take(take),
                         pa.array(np.full(len(rows), query))], ["curve", "place", "cid", "vec", "query"])

    placed = classes.mapInArrow(place, f"curve int, place bigint, cid bigint, vec {vec_type}, query boolean")
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "curve", "place", "cid", "query").sortWithinPartitions("curve", "place", "cid", "query")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros((2, len(curves.projections)), np.int64)
        for batch in batches:
            curve = batch.column("curve").to_numpy()
            query = np.asarray(batch.column("query").to_numpy(zero_copy_only=False), bool)
            ranks = []
            for kind, flag in enumerate((~query, query)):
                rank = np.zeros(len(curve), np.int64)
                for c in np.unique(curve):
                    own = curve == c
                    rank[own] = seen[kind, c] + np.cumsum(flag[own]) - flag[own]
                    seen[kind, c] += flag[own].sum()
                ranks.append(pa.array(rank))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("curve", "cid", "vec", "query")), pa.array(np.full(len(curve), task, np.int32)), *ranks],
                                             ["curve", "cid", "vec", "query", "task", "at", "nth"])

    rows = written(ordered.mapInArrow(number, f"curve int, cid bigint, vec {vec_type}, query boolean, task int, at bigint, nth bigint"), "curves")
    per_task = rows.groupBy("curve", "task").agg(F.count_if(~F.col("query")).alias("data"), F.count_if("query").alias("asks"))
    earlier = Window.partitionBy("curve").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select("curve", "task", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("data", "asks")))
    return rows.join(per_task, ["curve", "task"]).select("curve", "cid", "vec", "query", (F.col("at") + F.col("data")).alias("at"), (F.col("nth") + F.col("asks")).alias("nth"))


def nearest(vectors: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
            curves: int = CURVES, window: float = WINDOW) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` largest inner products found for every row where ``queries`` holds.

    Candidates are all rows but the query's own; scores are exact on the
    original vectors in double precision, ties go to the smaller id, and a
    query has all candidates if there are fewer than ``k``.  Rows with a null id
    or a vector that is null, empty, zero or holds null or non-finite
    components take no part; a row that repeats id and vector counts once;
    a shorter vector counts as padded with zeros.  No rows, no result; other
    columns are not read.

    Equal vectors are searched once, as a class: no more than the ``k`` + 1
    smallest ids of a class can be among anyone's ``k`` nearest.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.coalesce(queries, F.lit(False)).alias("asked"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(finite).dropDuplicates(["id", "vec"])
    classes = written(rows.groupBy("vec").agg(F.min("id").alias("cid"), F.max("asked").alias("asked")), "vector_classes")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, size, longest = classes.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(square)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double").withColumnRenamed("vec_id", id_col)
    chosen = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < min(1.0, SAMPLE_ROWS / n) * (1 << 30)).orderBy("cid").select("vec").collect()
    sample = np.array([[*r["vec"], *[0.0] * (size - len(r["vec"]))] for r in chosen], float).reshape(-1, size)
    model = Curves(sample, size, math.sqrt(longest), curves)
    ranked = written(_ranked(classes, model), "ranked")

    reach = math.ceil(window * n)
    asks = ranked.where("query").select("curve", F.col("cid").alias("qid"), F.col("vec").alias("qvec"), F.floor(F.col("nth") / _QUERIES).alias("part"), F.explode(F.sequence(
        F.floor(F.greatest(F.col("at") - reach, F.lit(0)) / _BLOCK), F.floor(F.least(F.col("at") + reach, F.lit(n - 1)) / _BLOCK))).alias("block"))
    data = ranked.where("not query").select("curve", "cid", "vec", F.floor(F.col("at") / _BLOCK).alias("block"))
    # a unit of work is at most _QUERIES queries against one block of vectors, however many windows overlap there
    units = asks.select("curve", "block", "part").distinct()
    data = data.join(units, ["curve", "block"]).select("cid", "vec", *(F.col(c).alias(f"d_{c}") for c in ("curve", "block", "part")))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q, c = (np.zeros((len(v), size)) for v in (left, right))
        for out, column in ((q, left["qvec"]), (c, right["vec"])):
            for i, v in enumerate(column):
                out[i, :len(v)] = v
        ids = right["cid"].to_numpy()
        if not len(q) or not len(c):
            return pd.DataFrame({"qid": [], "cid": [], "score": []})
        near = q @ c.T
        top = min(k + 1, len(c))
        best = np.argpartition(-near, top - 1, axis=1)[:, :top]
        # every equal to the last kept one is in play for ties: the smaller id has to win
        edge = np.take_along_axis(near, best, axis=1).min(axis=1)
        play = near >= edge[:, None] - 1e-12 * np.abs(edge)[:, None]
        ends, parts, i = np.cumsum(play.sum(axis=1)), [], 0
        while i < len(q):  # so many queries at a time that what is tied stays bounded
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _PLAY, "right")))
            row, col = np.nonzero(play[i:j])
            score = (q[i + row] * c[col]).sum(axis=1)
            order = np.lexsort((ids[col], -score, row))
            place = np.arange(len(order)) - np.searchsorted(row, np.arange(j - i))[row[order]]
            keep = order[place < top]
            parts.append(pd.DataFrame({"qid": left["qid"].to_numpy()[i + row[keep]], "cid": ids[col[keep]], "score": score[keep]}))
            i = j
        return pd.concat(parts)

    found = asks.groupBy("curve", "block", "part").cogroup(data.groupBy("d_curve", "d_block", "d_part")).applyInPandas(meet, "qid bigint, cid bigint, score double")
    found = found.groupBy("qid", "cid").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    found = written(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n"), "near_classes")

    members = rows.join(classes.select("vec", "cid"), "vec").select("id", "cid", "asked")
    first = written(members.withColumn("n", F.row_number().over(Window.partitionBy("cid").orderBy("id"))).where(F.col("n") <= k + 1).select("id", "cid"), "class_members")
    asking = members.where("asked").select(F.col("id").alias("query_id"), F.col("cid").alias("qid"))
    pairs = asking.join(found, "qid").select("query_id", "cid", "score").join(first, "cid").where(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
