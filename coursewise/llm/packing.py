"""Operator 1: best-fit decreasing packing with a segment tree over remaining capacities.

Documents become token pieces inside Spark tasks.  Best-fit decreasing only
looks at lengths, and there are at most ``max_tokens`` of them, so the plan is
made from the length histogram: lengths from long to short, and for each the
tightest open bin by a walk down a segment tree over remaining capacities.
Equal pieces and equal bins move together as runs, which gives exactly the
sequences that placing the pieces one by one gives, in time and memory that
depend on ``max_tokens`` and not on the number of documents.  Pieces then find
their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import vocabulary
from .common import BLOCK_CHARS, blocks, text_batches, written

MAX_TOKENS = 4096
END_ID = 1


class CapacityTree:
    """Segment tree over remaining capacities 0..n; a leaf holds the runs of open bins with that much room."""

    def __init__(self, n: int) -> None:
        self._base = 1 << (n + 1).bit_length()
        self._open = bytearray(2 * self._base)
        self._runs: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]

    def put(self, room: int, first_bin: int, bins: int) -> None:
        self._runs[room].append((first_bin, bins))
        at = self._base + room
        while at and not self._open[at]:
            self._open[at] = 1
            at >>= 1

    def take(self, room: int) -> tuple[int, int]:
        run = self._runs[room].pop()
        at = self._base + room
        if not self._runs[room]:
            self._open[at] = 0
            while at > 1:
                at >>= 1
                self._open[at] = self._open[2 * at] | self._open[2 * at + 1]
        return run

    def tightest(self, need: int) -> int | None:
        """The smallest capacity of at least ``need`` that an open bin has."""
        at = self._base + need
        while not self._open[at]:
            while at & 1:  # a right child: what lies further right belongs to an ancestor's sibling
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self._base:
            at = 2 * at + (not self._open[2 * at])
        return at - self._base


def best_fit_plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces, first bin, pieces a bin, offset) sorted by length and rank.

    A bin with the most room that a piece may still use takes such pieces
    until they no longer fit, as it stays the tightest one.  Every length
    starts at most three new runs and shortens the room of a run it meets by
    more than half, so there are at most about 3 * capacity * log2(capacity)
    rows, however many documents there are.
    """
    tree, plan, bins = CapacityTree(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, run = capacity, (bins, -(-left // (capacity // length)))
                bins += run[1]
            else:
                run = tree.take(room)
            each = room // length
            first, count = run
            full = min(count, left // each)
            if full:
                plan.append((length, rank, full * each, first, each, capacity - room))
                tree.put(room - each * length, first, full)
                rank, left, first, count = rank + full * each, left - full * each, first + full, count - full
            if count and left:  # fewer than a bin takes: left < each
                plan.append((length, rank, left, first, left, capacity - room))
                tree.put(room - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            if count:
                tree.put(room, first, count)
    return np.array(sorted(plan), np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids), with its rank among its task's pieces of that length."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, "
              "task int, task_rank bigint" + ", ids array<int>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = vocabulary(path), TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        for batch in batches:
            column = batch.column("text")
            for i, j in blocks(column.to_pylist(), 4 * BLOCK_CHARS):
                offsets, ids = bpe.encode(column.slice(i, j - i).to_pylist())
                ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
                offsets = offsets + np.arange(len(offsets))
                total = np.diff(offsets)
                parts = -(-total // max_tokens)
                owner = np.repeat(np.arange(len(total)), parts)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * max_tokens
                length = np.minimum(total[owner] - start, max_tokens)
                at = offsets[owner] + start
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                size = length[order]
                first = np.searchsorted(size, size)
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order)) - first + seen[size]
                seen += np.bincount(length, minlength=max_tokens + 1)
                out = [batch.column("id").slice(i, j - i).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                       pa.array(crc, pa.int64()), pa.array(np.full(len(owner), task), pa.int32()), pa.array(rank)]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, [f.split(" ")[0] for f in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pack every document of ``docs`` into sequences of at most ``max_tokens`` tokens.

    Returns a row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids).  A document is its ids followed by ``end_id``; only one
    longer than a sequence is cut.  A null or empty text is the end id alone.
    Null or repeated ids are packed row by row, an empty table gives no rows,
    and other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, path, id_col, text_col, max_tokens, end_id, with_ids), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = written(per_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece_counts")
    # at most max_tokens rows, whatever the size of the corpus
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit_plan(histogram, max_tokens))
    # a row a task and length grows with the corpus: merged, never broadcast
    ranked = cut.join(per_task.drop("n").hint("merge"), ["length", "task"]).withColumn("rank", F.col("before") + F.col("task_rank"))
    columns = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    fields = {f.name: f.dataType.simpleString() for f in ranked.schema}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        key = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = rows[np.searchsorted(key, (length << 48) + rank, "right") - 1]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(row[:, 3] + k // row[:, 4]), pa.array(row[:, 5] + k % row[:, 4] * length)],
                [*columns, "sequence_id", "offset"])

    out = ranked.select(*columns, "rank").mapInArrow(
        place, ", ".join(f"{c} {fields[c]}" for c in columns) + ", sequence_id bigint, offset bigint")
    return out.withColumnRenamed("id", id_col)
