"""Operator 12: near-duplicate vectors by lattice hashing.

Unit vectors are projected at random on eight coordinates a few times, moved,
and decoded to the nearest point of the E8 lattice; the points of a table's
projections together are its cell.  A vector lies in one cell of every table
and also visits the neighbouring cells that it is nearest to.  Owners of a cell
meet its other members, and what meets is verified by cosine.

A pair may meet in several cells but counts in the first one only, which both
vectors' cells tell: so links are counted where they are found and never
written out, and a group of near copies costs rows in proportion to its size.
Cells are found in whole numbers, so they are the same wherever they are
computed.  Equal vectors are one class, linked once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

MIN_COSINE = 0.95
#: Lattice units per unit of length (in 64 dimensions), cells visited besides the own one, and the share of pairs at just
#: the threshold that have to meet; closer pairs meet more often.
SCALE, PROBES, RECALL = 4.0, 4, 0.98
#: Vectors in random directions that meet in a table, at most.
_STRANGERS = 32
#: Owners and members of a cell that meet in one piece of work; a larger cell is dealt out in blocks of these.
_OWNERS, _MEMBERS = 1024, 4096
_PAIRS = 1 << 17
_GRID = 1 << 12  # whole numbers of 1/4096
# The 240 shortest vectors of E8, in halves
_ROOTS = np.array([[*v] for v in itertools.chain(
    (tuple(2 * (a if k == i else b if k == j else 0) for k in range(8)) for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)),
    (v for v in itertools.product((1, -1), repeat=8) if math.prod(v) == 1))], float)
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def e8_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row of 8 numbers (on a grid of 1/4096), in halves."""
    def even(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        rest = y - near
        far = np.abs(rest).argmax(axis=-1)[..., None]
        step = np.where(np.take_along_axis(rest, far, -1) >= 0, 1.0, -1.0)
        odd = near.sum(axis=-1, keepdims=True) % 2 != 0
        np.put_along_axis(near, far, np.take_along_axis(near, far, -1) + np.where(odd, step, 0.0), -1)
        return near

    whole, half = even(x), even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=-1, keepdims=True) < ((x - whole) ** 2).sum(axis=-1, keepdims=True)
    return 2 * np.where(closer, half, whole)


class Lattice:
    """Tables of ``blocks`` projections each, for vectors padded to ``size`` coordinates."""

    def __init__(self, size: int, tables: int, blocks: int, scale: float = SCALE, probes: int = PROBES, seed: int = 17) -> None:
        rng = np.random.default_rng(seed)
        self.size, self.tables, self.blocks, self.probes = size, tables, blocks, min(probes, 240 * blocks)
        width, wide = 8 * blocks, max(size, 8 * blocks)
        # rows of a random rotation: the projections of one table do not repeat each other
        turns = [np.linalg.qr(rng.standard_normal((wide, wide)))[0][:size, :width] for _ in range(tables)]
        scale *= math.sqrt(wide / 64)  # coordinates of a unit vector get smaller with the number of dimensions
        self.projection = np.rint(np.concatenate(turns, axis=1) * scale * _GRID)
        self.shift = np.rint(rng.uniform(0, 1, tables * width) * _GRID)
        self.mix = rng.integers(1, 1 << 62, (blocks, 8), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def cells(self, units: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes): own cell first, then the neighbouring ones, nearest first."""
        n = len(units)
        whole = np.rint(units * _GRID) @ self.projection  # whole numbers below 2^53: exact in any order of adding
        x = np.floor(whole / _GRID + self.shift).reshape(n, self.tables, self.blocks, 8) / _GRID
        point = e8_point(x)
        own = self._hash(point)
        # a step along root v brings the point nearer by 2 x.v - 2 (in units of the lattice), so the largest products are next
        gain = (np.rint((x - point / 2) * _GRID) @ _ROOTS.T).reshape(n, self.tables, -1)
        near = np.argpartition(-gain, self.probes - 1, axis=-1)[..., :self.probes]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(gain, near, -1), axis=-1, kind="stable"), -1)
        block, root = near // 240, near % 240
        step = (self.mix[block] * _ROOTS.astype(np.int64).astype(np.uint64)[root]).sum(axis=-1, dtype=np.uint64)
        return _scrambled(np.concatenate([own[..., None], own[..., None] + step], axis=-1))

    def _hash(self, point: np.ndarray) -> np.ndarray:
        return (point.astype(np.int64).astype(np.uint64) * self.mix).sum(axis=(-2, -1), dtype=np.uint64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Linear sums, which let a neighbour's sum follow from one's own, made into evenly spread 64-bit numbers."""
    for mix in _MIX:
        x = (x ^ (x >> np.uint64(29))) * np.uint64(mix)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def plan(n: int, size: int, min_cosine: float, scale: float = SCALE, probes: int = PROBES, recall: float = RECALL) -> tuple[int, int]:
    """(tables, blocks) for ``n`` vectors.

    More blocks make smaller cells: there are enough of them that a vector meets
    few others in random directions, however many there are.  More tables make
    up for pairs that a table parts: the share that meets is measured on random
    pairs at just ``min_cosine``, so ``recall`` is reached at every size.
    """
    rng = np.random.default_rng(5)
    wide = max(size, 8)
    a, b, c = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((3, 2000, wide)))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = min_cosine * a + math.sqrt(1 - min_cosine ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    one = Lattice(wide, 4, 1, scale, probes)
    apart = (one.cells(a)[:, None] == one.cells(c[:200])[None, ..., :1]).any(axis=-1).mean()  # vectors that have nothing to do with each other
    blocks = 1
    while blocks < wide // 8 and n * apart ** blocks > _STRANGERS:
        blocks += 1
    own = Lattice(wide, 4, blocks, scale, probes)
    left, right = own.cells(a), own.cells(b)
    meet = ((left == right[..., :1]) | (right == left[..., :1])).any(axis=-1).mean()
    tables = math.ceil(math.log(1 - recall) / math.log(1 - min(meet, 0.999)))
    return tables, blocks


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares are in range
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows of doubles, short ones padded with zeros."""
    out = np.zeros((len(column), size))
    length = np.asarray(column.value_lengths())
    out[np.arange(size) < length[:, None]] = np.asarray(column.flatten(), float)
    return out


def _visits(classes: DataFrame, lattice: Lattice) -> DataFrame:
    """(tab, cell, cls, own): the cells of every class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                cells = lattice.cells(_unit(_matrix(part.column("vec"), lattice.size)))
                n, tables, each = cells.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), each), n)), pa.array(cells.ravel()), pa.array(np.repeat(part.column("cls").to_numpy(), tables * each)),
                     pa.array(np.tile(np.arange(each) == 0, n * tables))], ["tab", "cell", "cls", "own"])

    return classes.select("cls", "vec").mapInArrow(run, "tab int, cell bigint, cls bigint, own boolean")


def _spread(column: str, blocks: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(salt)), blocks)


def _work(visits: DataFrame, classes: DataFrame) -> DataFrame:
    """(unit, tab, cell, left, right, cls, n, vec, own): members of cells where an owner meets someone, dealt out in bounded units.

    A unit is a bundle of small cells, or one block of owners (left) and one of
    members (right) of a larger cell.
    """
    sizes = visits.groupBy("tab", "cell").agg(F.count_if("own").alias("owners"), F.count(F.lit(1)).alias("members"))
    sizes = sizes.where("owners >= 1 and members >= 2")
    sizes = written(sizes.select("tab", "cell", "members", F.ceil(F.col("owners") / _OWNERS).alias("lefts"), F.ceil(F.col("members") / _MEMBERS).alias("rights")), "cell_sizes")
    small = (F.col("lefts") == 1) & (F.col("rights") == 1)
    bundles = max(1, math.ceil((sizes.where(small).agg(F.sum("members")).first()[0] or 0) / _MEMBERS))
    met = visits.join(sizes, ["tab", "cell"])
    whole = F.struct(_spread("cell", F.lit(bundles), 3).alias("bundle"), F.lit(0).cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("r"), F.lit(True).alias("left"), F.lit(True).alias("right"))

    def block(l: Column, r: Column, left: bool) -> Column:
        return F.struct(F.lit(-1).cast("bigint").alias("bundle"), l.alias("l"), r.alias("r"), F.lit(left).alias("left"), F.lit(not left).alias("right"))

    as_right = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda l: block(l, _spread("cls", F.col("rights"), 2), False))
    as_left = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda r: block(_spread("cls", F.col("lefts"), 1), r, True))
    parts = F.when(small, F.array(whole)).when(F.col("own"), F.concat(as_left, as_right)).otherwise(as_right)
    placed = met.select("tab", "cell", "cls", "own", F.explode(parts).alias("part")).select("tab", "cell", "cls", "own", "part.*")
    # a bundle is named by its number, a block by its cell and place
    unit = F.when(F.col("bundle") >= 0, F.xxhash64("bundle")).otherwise(F.xxhash64("tab", "cell", "l", "r"))
    return placed.select(unit.alias("unit"), "tab", "cell", "left", "right", "cls", "own").join(classes.select("cls", "n", "vec"), "cls")


class _Meeting:
    """Pairs of a unit that are linked and whose first meeting is here."""

    def __init__(self, lattice: Lattice, min_cosine: float, cls: np.ndarray, units: np.ndarray) -> None:
        self.lattice, self.min_cosine, self.cls, self.units = lattice, min_cosine, cls, units
        self.known = np.full(len(cls), -1)
        self.cells = np.empty((0, lattice.tables, 1 + lattice.probes), np.int64)

    def _cells(self, rows: np.ndarray) -> np.ndarray:
        new = np.unique(rows[self.known[rows] < 0])
        if len(new):
            self.known[new] = len(self.cells) + np.arange(len(new))
            parts = [self.lattice.cells(self.units[new[i:i + 500]]) for i in range(0, len(new), 500)]
            self.cells = np.concatenate([self.cells, *parts])
        return self.cells[self.known[rows]]

    def pairs(self, tab: int, cell: int, left: np.ndarray, right: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, rows) of links between owners ``left`` and members ``right`` of a cell, in blocks."""
        for i in range(0, len(left), max(1, _PAIRS // len(right))):
            part = left[i:i + max(1, _PAIRS // len(right))]
            a, b = np.nonzero(self.units[part] @ self.units[right].T >= self.min_cosine)
            a, b = part[a], right[b]
            keep = np.where(own[b], self.cls[a] < self.cls[b], self.cls[a] != self.cls[b])  # two owners meet once
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            low = self.cls[a] < self.cls[b]
            one, two = self._cells(np.where(low, a, b)), self._cells(np.where(low, b, a))
            here = (one[:, tab, :1] == two[:, tab]).any(axis=1)  # the larger one comes to the smaller one's cell, or else the other way
            first = np.where(here, one[:, tab, 0], two[:, tab, 0]) == cell
            for t in range(tab):
                first &= ~((one[:, t, :1] == two[:, t]).any(axis=1) | (two[:, t, :1] == one[:, t]).any(axis=1))
            yield a[first], b[first]


def _found(work: DataFrame, lattice: Lattice, min_cosine: float) -> DataFrame:
    """(cls, root, links): rows at the links of each class, and a smaller class that it hangs together with (or itself)."""
    def meet(table: pa.Table) -> pa.Table:
        column = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "cell", "left", "right", "cls", "n", "own")}
        units = _unit(_matrix(pa.concat_arrays(table.column("vec").chunks), lattice.size))
        cls, own = column["cls"], column["own"].astype(bool)
        meeting = _Meeting(lattice, min_cosine, cls, units)
        names, at = np.unique(cls, return_inverse=True)
        size = np.zeros(len(names), np.int64)
        size[at] = column["n"]
        links, root = np.zeros(len(names), np.int64), np.arange(len(names))
        order = np.lexsort((column["cell"], column["tab"]))
        tab, cell = column["tab"][order], column["cell"][order]
        starts = np.flatnonzero(np.append(True, (tab[1:] != tab[:-1]) | (cell[1:] != cell[:-1])))
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
            rows = order[i:j]
            left, right = rows[column["left"][rows].astype(bool) & own[rows]], rows[column["right"][rows].astype(bool)]
            if not len(left) or not len(right):
                continue
            for a, b in meeting.pairs(int(tab[i]), int(cell[i]), left, right, own):
                a, b = at[a], at[b]
                np.add.at(links, a, size[b])
                np.add.at(links, b, size[a])
                while True:  # the smaller root of each link becomes the other's, until nothing moves
                    ra, rb = root[a], root[b]
                    if (ra == rb).all():
                        break
                    np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
                    while (root != (up := root[root])).any():
                        root = up
        hit = np.flatnonzero(links)
        return pa.table([names[hit], names[root[hit]], links[hit]], ["cls", "root", "links"])

    return work.groupBy("unit").applyInArrow(meet, "cls bigint, root bigint, links bigint")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id, n_links, component, kept) of every row: vectors are linked if their cosine, in doubles, is at least ``min_cosine``.

    ``n_links`` counts the other rows that a row is linked to, ``component`` is
    the smallest id reachable, ``kept`` whether that is its own.  A link is
    only found where cells meet (see ``plan``); none is below the threshold.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and are their own component.  A shorter vector counts as
    padded with zeros.  Rows that repeat an id or a vector count one by one; a
    null id comes after all others, and is a component only where nothing else
    is reachable.  No rows, no result; other columns are not read.
    """
    if not 0 < min_cosine < 1:
        raise ValueError("min_cosine lies between 0 and 1")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("vec", lambda x: x != 0)
    usable = F.coalesce(F.col("vec").isNotNull() & finite, F.lit(False))
    classes = rows.where(usable).groupBy("vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "vector_classes")
    n, size = classes.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    alone = rows.where(~usable).select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), F.lit(True).alias("kept"))
    if not n:
        return alone
    lattice = Lattice(size, *plan(n, size, min_cosine))
    visits = written(_visits(classes, lattice), "cells")
    found = written(_found(_work(visits, classes), lattice, min_cosine), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.where("cls != root").select("cls", "root"))
    of_class = classes.join(links, "cls", "left").join(roots, F.col("cls") == F.col("node"), "left")
    of_class = written(of_class.select("cls", "vec", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "cls").alias("root")), "class_links")
    named = of_class.groupBy("root").agg(F.min("least").alias("component"))
    named = of_class.join(named, "root").select("vec", "n_links", "component")
    linked = rows.where(usable).join(named, "vec").select(F.col("id").alias(id_col), "n_links", "component", F.col("id").eqNullSafe(F.col("component")).alias("kept"))
    return linked.unionByName(alone)
