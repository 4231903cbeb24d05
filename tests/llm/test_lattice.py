"""Operator 12: lattice points, links and components against all pairs."""

import math

import numpy as np
import pytest

from coursewise.llm import lattice, queries


def plain(rows, min_cosine=0.95):
    """(id, n_links, component, kept) of every row from the cosines of all pairs."""
    size = max([len(v) for _, v in rows if v] or [1])
    usable = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = np.zeros((len(rows), size))
    for i, (_, v) in enumerate(rows):
        if usable[i]:
            units[i, :len(v)] = np.array(v, float) / max(abs(x) for x in v)
            units[i] /= np.linalg.norm(units[i])
    linked = units @ units.T >= min_cosine
    np.fill_diagonal(linked, False)
    root = list(range(len(rows)))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    place = {i: k for k, i in enumerate(order)}
    for start in order:
        if root[start] == start:
            todo = [start]
            while todo:
                i = todo.pop()
                for j in np.flatnonzero(linked[i]).tolist():
                    if root[j] == j and j != start and place[j] > place[start]:
                        root[j] = start
                        todo.append(j)
    return sorted(((i, int(linked[k].sum()), rows[root[k]][0], i == rows[root[k]][0]) for k, (i, _) in enumerate(rows)), key=repr), int(linked.sum())


def found(frame):
    return sorted(map(tuple, frame.select("vec_id", "n_links", "component", "kept").collect()), key=repr)


def make(spark, rows, kind="float"):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], f"vec_id bigint, embedding array<{kind}>")
    return frame.selectExpr("*", "1 AS cls", "'x' AS vec", "2 AS n", "3 AS root", "4 AS cell", "5 AS links", "6 AS component")


def clouds(rng, n, size, groups, spread):
    """Random directions, and groups of near copies of some of them."""
    base = rng.standard_normal((n, size))
    rows = [b for b in base]
    for g, m in enumerate(groups):
        rows += [base[g] + spread * rng.standard_normal(size) for _ in range(m)]
    return [(i, np.float32(v).tolist()) for i, v in enumerate(rows)]


def test_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = np.rint(rng.uniform(-2, 2, (300, 8)) * 4096) / 4096
    point = lattice.e8_point(x)
    whole, odd = (point % 2 == 0).all(axis=1), (point % 2 == 1).all(axis=1)
    assert (whole | odd).all() and (point.sum(axis=1) % 4 == 0).all()  # all whole or all half, sum even
    own = ((x - point / 2) ** 2).sum(axis=1)
    steps = ((x[:, None] - point[:, None] / 2 - lattice._ROOTS[None] / 2) ** 2).sum(axis=2)
    assert (own <= steps.min(axis=1) + 1e-12).all() and (own <= 1 + 1e-9).all()  # no neighbour is nearer; the covering radius is 1
    assert len(np.unique(lattice._ROOTS, axis=0)) == 240 and ((lattice._ROOTS ** 2).sum(axis=1) == 8).all()


def test_neighbouring_cells_are_cells_of_the_neighbours():
    """A visited cell is the own cell of a vector whose point is that neighbour."""
    own = lattice.Lattice(64, 3, 2, probes=9)
    rng = np.random.default_rng(2)
    point = 2.0 * rng.integers(-3, 3, (50, 3, 2, 8))
    point[..., 0] += 2 * ((point.sum(axis=-1) / 2) % 2)
    for root in (0, 100, 239):
        moved = point.copy()
        moved[:, :, 1] += lattice._ROOTS[root]
        step = (own.mix[1] * lattice._ROOTS[root].astype(np.int64).astype(np.uint64)).sum(dtype=np.uint64)
        assert (own._hash(moved) == own._hash(point) + step).all()


@pytest.mark.parametrize("size, blocks", [(64, 1), (64, 3), (3, 1), (200, 4)])
def test_cells_do_not_depend_on_the_batch(size, blocks):
    model = lattice.Lattice(size, 4, blocks)
    units = lattice._unit(np.random.default_rng(3).standard_normal((100, size)))
    whole = model.cells(units)
    assert (whole == np.concatenate([model.cells(units[i:i + 7]) for i in range(0, 100, 7)])).all()
    assert whole.shape == (100, 4, 1 + model.probes) and (np.diff(np.sort(whole, axis=-1), axis=-1) != 0).all()


def test_links_of_random_groups_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = clouds(rng, 1500, 64, [1, 2, 5, 40, 200], 0.15)
    got, (want, links) = found(lattice.near_duplicate_vectors(make(spark, rows))), plain(rows)
    by_id = {r[0]: r for r in want}
    assert all(n <= by_id[i][1] for i, n, _, _ in got)  # nothing below the threshold, and no pair counts twice
    assert sum(n for _, n, _, _ in got) >= 0.97 * links
    assert sum(a[2] == by_id[a[0]][2] for a in got) >= 0.99 * len(rows)


@pytest.mark.parametrize("size", [16, 64, 256])
def test_recall_at_the_threshold(spark, size):
    """Pairs whose cosine is just the threshold: the worst case."""
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((2, 700, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.9502 * a + math.sqrt(1 - 0.9502 ** 2) * b
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, near]))]
    got = found(lattice.near_duplicate_vectors(make(spark, rows, "double")))
    links = plain(rows)[1]
    assert links >= 1400 and sum(r[1] for r in got) >= 0.9 * links


def test_large_cells_are_dealt_out_and_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = clouds(rng, 50, 32, [300], 0.05)
    want, links = plain(rows)
    assert found(lattice.near_duplicate_vectors(make(spark, rows))) == want
    monkeypatch.setattr(lattice, "_OWNERS", 16)
    monkeypatch.setattr(lattice, "_MEMBERS", 50)
    monkeypatch.setattr(lattice, "_PAIRS", 64)
    assert found(lattice.near_duplicate_vectors(make(spark, rows))) == want and links > 80000


ODD = [(1, [1, 0, 0]), (2, [1, 0, 0]), (2, [1, 0, 0]), (3, [2, 0, 0]), (4, [1, 0.01]), (5, None), (6, []), (7, [0, 0, 0]), (8, [1, None, 0]), (9, [math.nan, 1, 0]),
       (10, [math.inf, 0, 0]), (None, [1, 0, 0.001]), (None, [0, 1, 0]), (None, None), (11, [-1, 0, 0]), (12, [1e-30, 0, 0]), (13, [-0.0, 5, 0.0]), (14, [0.0, 5, -0.0]), (7, [3, 3, 3])]


def test_odd_rows_repeats_and_clashing_columns(spark):
    assert found(lattice.near_duplicate_vectors(make(spark, ODD))) == plain(ODD)[0]


def test_empty_tables_and_nothing_usable(spark):
    assert found(lattice.near_duplicate_vectors(make(spark, ODD).limit(0))) == []
    none = [(1, None), (2, [0, 0]), (2, [0, 0])]
    assert found(lattice.near_duplicate_vectors(make(spark, none))) == [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True)]


def test_query_against_all_pairs(spark):
    import duckdb

    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.001/embeddings.parquet'").fetchall()
    got = queries.op12_lattice_dedup(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr) == plain(rows)[0]
