"""Operator 11: ranked lexical search by a dual tree over items and documents.

Items (the queries) and documents are both put into hierarchies.  A node holds
the maximum of every coordinate below it: of an item's term counts, or of a
document's term impacts.  The product of two nodes' maxima bounds every score
between them; a pair of nodes whose bound is below the weakest kth score of
its items is left out with all that is below it.  All numbers are integers, so
bounds and scores are exact and nothing is lost.

Documents become vectors over the items' terms in one pass.  Spark deals them
out by range of their weightiest terms, so that a task's tree has alike
documents near each other; every task searches all items of a block and gives
at most k rows an item.  Tasks start from scores that k documents of the table
are known to reach: those of a part of the table that was searched before.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursewise.session import work_dir

from .common import text_batches, written

K = 10
#: Items that are searched together, and distinct terms from which on a block takes no more items: what the driver and a
#: task hold of the items is bounded by a block.  More items are more blocks, each with a pass over the documents.
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 14
#: One in so many documents is searched first, for scores to start from.  It bounds nothing and changes no result.
SEED_SHARE = 64
_ITEM_LEAF, _DOC_LEAF_BITS, _FANOUT_BITS, _LEVELS = 8, 6, 3, 3
#: Documents of one tree, and postings from which on it takes no more documents.
_TREE_DOCS, _TREE_POSTINGS = 1 << _DOC_LEAF_BITS + _FANOUT_BITS * (_LEVELS - 1), 1 << 20
#: Products that are held at once where scores are added up.
_PRODUCTS = 1 << 21

# Terms: ASCII letters (A-Z as a-z), digits and whatever is not ASCII; on UTF-8 bytes that is a table
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return (text or b"").translate(_TERM_BYTES).split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id bigint, n, terms, tfs) of every document with a term: its length, and its counts of the vocabulary's terms."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, ids, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                words = terms(text.as_py())
                if not words:
                    continue
                known = [t for t in map(vocabulary.get, words) if t is not None]
                own, count = np.unique(np.array(known, np.int32), return_counts=True)
                rows.append(i)
                lengths.append(len(words))
                ids.append(own)
                counts.append(count)
                ends.append(ends[-1] + len(own))
            flat = [np.concatenate([np.empty(0, np.int32), *x]).astype(np.int32) for x in (ids, counts)]
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat)],
                ["id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, tfs array<int>")


class Weights:
    """Corpus statistics: impact of a term in a document, as integers."""

    def __init__(self, n_docs: int, n_terms: int, df: np.ndarray) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def impact(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Score of one occurrence of ``term`` in an item, for documents with ``tf`` of it among ``length`` terms."""
        m = 100 - 75 + 75 * length * self.n_docs // self.n_terms
        return self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class ItemTree:
    """Items in a hierarchy of halves, alike items together; nodes are ranges of the ordered items.

    ``counts`` (items x terms) are in that order, which ``order`` gives;
    ``maxima`` has the largest count of each term below each node.
    """

    def __init__(self, counts: np.ndarray, weight: np.ndarray) -> None:
        alike = counts * weight.astype(float)
        alike /= np.maximum(np.linalg.norm(alike, axis=1, keepdims=True), 1e-9)
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[tuple[int, int]] = []
        self.order = np.empty(0, np.int64)

        def grow(rows: np.ndarray) -> int:
            node, at = len(self.low), len(self.order)
            self.low.append(at)
            self.high.append(at + len(rows))
            self.children.append((-1, -1))
            if len(rows) <= _ITEM_LEAF:
                self.order = np.append(self.order, rows)
                return node
            one = rows[np.argmin(alike[rows] @ alike[rows].mean(axis=0))]
            two = rows[np.argmin(alike[rows] @ alike[one])]
            rows = rows[np.argsort(alike[rows] @ (alike[two] - alike[one]), kind="stable")]
            half = len(rows) // 2
            self.children[node] = grow(rows[:half]), grow(rows[half:])
            return node

        grow(np.arange(len(counts)))
        self.counts = counts[self.order]
        self.maxima = np.stack([self.counts[a:b].max(axis=0) for a, b in zip(self.low, self.high, strict=True)])
        self.child = np.array(self.children)
        self.ranges = np.column_stack([self.low, self.high]).ravel()

    def inner(self, nodes: np.ndarray) -> np.ndarray:
        return self.child[nodes, 0] >= 0

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The nodes' children; leaves stay."""
        inner = self.inner(nodes)
        return np.concatenate([nodes[~inner], self.child[nodes[inner]].ravel()])

    def weakest(self, kth: np.ndarray) -> np.ndarray:
        """The smallest kth score of each node's items."""
        return np.minimum.reduceat(np.append(kth, 0), self.ranges)[::2]

    def bounds(self, nodes: np.ndarray, term: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Largest score that an item of each node can have with documents whose impacts are at most ``most``."""
        return self.maxima[np.ix_(nodes, term)].astype(np.int64) @ most


class DocTree:
    """Documents in leaves of 64, nodes of 512 and a root: CSR postings and the largest impact of each term below each node."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, offsets: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        self.ids, self.null, self.offsets, self.term, self.impact = ids, null, offsets, term, impact
        node, most = np.repeat(np.arange(len(ids)), np.diff(offsets)), impact
        self.levels = []
        for level in range(_LEVELS):
            node = node >> (_FANOUT_BITS if level else _DOC_LEAF_BITS)
            order = np.lexsort((term, node))
            node, term, most = node[order], term[order], most[order]
            fresh = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (term[1:] != term[:-1]))) if len(node) else np.empty(0, np.int64)
            most = np.maximum.reduceat(most, fresh) if len(fresh) else most
            node, term = node[fresh], term[fresh]
            last = (len(ids) - 1) >> (_DOC_LEAF_BITS + _FANOUT_BITS * level)
            self.levels.append((np.searchsorted(node, np.arange(last + 2)), term, most))

    def maxima(self, level: int, node: int) -> tuple[np.ndarray, np.ndarray]:
        offsets, term, most = self.levels[level]
        a, b = offsets[node], offsets[node + 1]
        return term[a:b], most[a:b]

    def children(self, level: int, node: int) -> range:
        first = node << _FANOUT_BITS
        return range(first, min(first + (1 << _FANOUT_BITS), len(self.levels[level - 1][0]) - 1))


class Search:
    """The best documents of every item so far: at most ``k`` an item, ties to smaller ids, null ids last."""

    def __init__(self, items: ItemTree, k: int, seeds: np.ndarray) -> None:
        self.items, self.k = items, k
        self.seeds = np.maximum(seeds, 1)  # a score of zero is no result
        self.kth = self.seeds.copy()
        self.weak = items.weakest(self.kth)
        empty = np.empty(0, np.int64)
        self.best = (empty, empty, np.empty(0, bool), empty)  # item, score, null, id
        self.scored = 0

    def add(self, docs: DocTree) -> None:
        """Search one tree of documents against all items."""
        root, top = np.array([0]), _LEVELS - 1
        stack = [(top, 0, root, self.items.bounds(root, *docs.maxima(top, 0)))]
        while stack:
            level, node, pairs, bound = stack.pop()
            pairs = pairs[bound >= self.weak[pairs]]
            if not len(pairs):
                continue
            if level:
                pairs = self.items.below(pairs)
                todo = []
                for child in docs.children(level, node):
                    bound = self.items.bounds(pairs, *docs.maxima(level - 1, child))
                    if len(bound):
                        todo.append((int(bound.max()), child, bound))
                # the most promising child is the next: it raises the scores that the others have to reach
                stack.extend((level - 1, child, pairs, bound) for _, child, bound in sorted(todo, key=lambda x: x[:2]))
                continue
            while self.items.inner(pairs).any():
                pairs = self.items.below(pairs)
                pairs = pairs[self.items.bounds(pairs, *docs.maxima(0, node)) >= self.weak[pairs]]
            if len(pairs):
                self._score(docs, node, np.concatenate([np.arange(self.items.low[p], self.items.high[p]) for p in pairs.tolist()]))

    def _score(self, docs: DocTree, leaf: int, items: np.ndarray) -> None:
        first = leaf << _DOC_LEAF_BITS
        offsets = docs.offsets[first:first + (1 << _DOC_LEAF_BITS) + 1]
        a, b = offsets[0], offsets[-1]
        has = np.flatnonzero(np.diff(offsets))
        score = np.zeros((len(items), len(has)), np.int64)
        step = max(1, _PRODUCTS // max(1, b - a))
        for i in range(0, len(items), step):  # a block of items at a time
            product = self.items.counts[np.ix_(items[i:i + step], docs.term[a:b])] * docs.impact[a:b]
            score[i:i + step] = np.add.reduceat(product, offsets[has] - a, axis=1)
        self.scored += score.size
        row, col = np.nonzero(score >= self.kth[items][:, None])
        if not len(row):
            return
        doc = first + has[col]
        found = (items[row], score[row, col], docs.null[doc], docs.ids[doc])
        item, score, null, ids = (np.concatenate(x) for x in zip(self.best, found, strict=True))
        order = np.lexsort((ids, null, -score, item))
        item, score, null, ids = item[order], score[order], null[order], ids[order]
        start = np.searchsorted(item, np.arange(len(self.kth) + 1))
        place = np.arange(len(item)) - start[item]
        keep = place < self.k
        self.best = item[keep], score[keep], null[keep], ids[keep]
        full = place == self.k - 1
        self.kth[item[full]] = np.maximum(self.seeds[item[full]], score[full])
        self.weak = self.items.weakest(self.kth)


def _trees(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[DocTree]:
    """The rows' trees, each of a bounded number of documents and postings."""
    held: list[tuple[np.ndarray, ...]] = []

    def tree() -> DocTree:
        ids, null, n, size, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        return DocTree(ids, null, np.append(0, np.cumsum(size)), term, weights.impact(term, tf.astype(np.int64), np.repeat(n, size)))

    docs = postings = 0
    for batch in batches:
        size = np.asarray(batch.column("terms").value_lengths()).astype(np.int64)
        ends, done = np.cumsum(size), 0
        while done < len(size):
            before = ends[done] - size[done]
            stop = min(done + _TREE_DOCS - docs, max(done + 1, int(np.searchsorted(ends, before + _TREE_POSTINGS - postings, "right"))))
            part = batch.slice(done, stop - done)
            ids = part.column("id")
            held.append((np.asarray(ids.fill_null(0)), np.asarray(ids.is_null().to_numpy(zero_copy_only=False)), part.column("n").to_numpy(), size[done:stop],
                         np.asarray(part.column("terms").flatten()), np.asarray(part.column("tfs").flatten())))
            docs, postings, done = docs + stop - done, postings + int(ends[stop - 1] - before), stop
            if docs >= _TREE_DOCS or postings >= _TREE_POSTINGS:
                yield tree()
                docs = postings = 0
    if held:
        yield tree()


def _search(rows: DataFrame, items: ItemTree, weights: Weights, seeds: np.ndarray, k: int) -> DataFrame:
    """(item, id, score): for each task's rows at most ``k`` an item; item is its place in the tree's order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, k, seeds)
        for tree in _trees(batches, weights):
            search.add(tree)
        item, score, null, ids = search.best
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids, mask=null), pa.array(score)], ["item", "id", "score"])

    return rows.select("id", "n", "terms", "tfs").mapInArrow(run, "item int, id bigint, score bigint")


def _near(rows: DataFrame, weights: Weights) -> DataFrame:
    """The rows dealt out and sorted by the two terms that weigh most in them, so that alike documents share a leaf."""
    schema = "first int, second int, id bigint, n bigint, terms array<int>, tfs array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column("terms").value_lengths()).astype(np.int64)
            term, tf = (np.asarray(batch.column(c).flatten()) for c in ("terms", "tfs"))
            impact = weights.impact(term, tf.astype(np.int64), np.repeat(batch.column("n").to_numpy(), size))
            doc = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((term, -impact, doc))
            start = np.cumsum(size) - size
            first = term[order[start]] if len(size) else term
            second = np.where(size > 1, term[order[np.minimum(start + 1, len(order) - 1)]], -1) if len(size) else term
            yield pa.RecordBatch.from_arrays([pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), *batch.columns], ["first", "second", *batch.schema.names])

    # a place in the written table splits what has the same terms, such as a large group of copies
    keyed = rows.mapInArrow(run, schema).withColumn("place", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(parts, "first", "second", "place").sortWithinPartitions("first", "second", "place")


def _search_block(docs: DataFrame, block: list[tuple], k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, id, score): the best of all documents for the items of a block, which are (place, term counts)."""
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(count for _, count in block))))}
    rows = written(vectors(docs, vocabulary, id_col, text_col), "term_vectors")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the block
        df[term] = n
    weights = Weights(n_docs, n_terms or 1, df)
    counts = np.zeros((len(block), len(vocabulary)), np.int32)
    for i, (_, count) in enumerate(block):
        counts[i, [vocabulary[t] for t in count]] = list(count.values())
    items = ItemTree(counts, weights.weight)

    rows = rows.where(F.size("terms") > 0).select("id", "n", "terms", "tfs")
    none = np.zeros(len(block), np.int64)
    part = _search(rows.where(F.pmod(F.xxhash64("id", "terms"), F.lit(SEED_SHARE)) == 0), items, weights, none, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    seeds = none.copy()
    for r in part.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == k).collect():  # at most a row an item
        seeds[r["item"]] = r["score"]
    found = _search(_near(rows, weights), items, weights, seeds, k)
    place = F.array(*(F.lit(block[i][0]) for i in items.order.tolist()))
    return found.select(F.element_at(place, F.col("item") + 1).alias("item"), "id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, id, score) of the ``k`` best documents with a score above 0 for every item.

    Terms are runs of ASCII letters and digits and of whatever is not ASCII,
    A-Z in lower case.  Ranks are unique, from 1; equal scores are in the order
    of ids, null ids last.  Rows are documents one by one, also those that
    repeat an id or a text; rows of ``items`` that repeat id and text count
    once, and other texts under an id are ranked by themselves.  Null and empty
    texts have no terms: such items have no rows, and such documents take no
    part in any count.  Very long texts are read whole.  Without documents or
    items there are no rows; other columns are not read.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "ranked")
    schema = "item bigint, id bigint, score bigint"
    # the items' rows get places to tell them apart; a block of them at a time comes to the driver
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
    asked = written(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    block: list[tuple] = []
    seen: set[bytes] = set()

    def flush() -> None:
        if block:
            _search_block(docs, block, k, id_col, text_col).write.mode("append").parquet(path)
            block.clear()
            seen.clear()

    for row in asked.select("item", "text").toLocalIterator():
        count = Counter(terms((row["text"] or "").encode()))
        if not count:
            continue
        if len(block) >= BLOCK_ITEMS or len(seen | count.keys()) > BLOCK_TERMS:
            flush()
        block.append((row["item"], count))
        seen.update(count)
    flush()

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
