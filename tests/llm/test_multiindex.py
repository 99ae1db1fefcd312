"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest

from vacantia.llm import multiindex
from vacantia.llm.multiindex import Grid
from vacantia.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, least=0.93):
    """(id, n_links, component_id, kept) of rows (id, vector, label), in their order, by all pairs."""
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    x = np.zeros((len(rows), width))
    good = np.zeros(len(rows), dtype=bool)
    for k, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            x[k, :len(v)] = v
            x[k] /= np.linalg.norm(x[k])
            good[k] = True
    labels = np.array([str(r[2]) for r in rows])
    near = (x @ x.T >= least) & (labels[:, None] == labels) & good[:, None] & good
    np.fill_diagonal(near, False)
    tree = np.arange(len(rows))
    for k in range(len(rows)):
        trees = np.unique(tree[np.append(np.flatnonzero(near[k]), k)])
        tree[np.isin(tree, trees)] = trees.min()
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [rows[m][0] for m in np.flatnonzero(tree == tree[k]) if rows[m][0] is not None]
        component = min(ids, default=None)
        out.append((i, int(near[k].sum()), component, i == component))
    return out


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], f"vec_id bigint, embedding array<{kind}>, label int, node int, cell string, n int")


def got(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def drawn(rng, groups, sizes, width=24, labels=3, noise=0.03):
    """Groups of near copies, and vectors like no other."""
    rows = []
    for _ in range(groups):
        base = rng.standard_normal(width)
        base /= np.linalg.norm(base)
        for _ in range(int(rng.choice(sizes))):
            rows.append((len(rows), [float(np.float32(c)) for c in base + noise * rng.standard_normal(width)], int(rng.integers(labels))))
    order = rng.permutation(len(rows))
    return [(int(order[k]), v, label) for k, (_, v, label) in enumerate(rows)]


def recalled(found, wanted, least=0.98):
    """No link is made up, and hardly any is missed by the traversal."""
    found, wanted = ({r[0]: r for r in rows} for rows in (found, wanted))
    assert found.keys() == wanted.keys()
    assert all(found[i][1] <= wanted[i][1] for i in wanted)
    assert sum(r[1] for r in found.values()) >= least * sum(r[1] for r in wanted.values())
    assert sum(found[i][2:] == wanted[i][2:] for i in wanted) >= least * len(wanted)


def test_embeddings_as_by_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(QUERIES["op13_embedding_near_dedup"](spark, SF)) == sorted(plain(rows), key=str)


def test_groups_of_near_copies(spark):
    rows = drawn(np.random.default_rng(3), 400, [1, 1, 2, 5, 20])
    recalled(got(multiindex.near_vectors(frame(spark, rows))), plain(rows))


@pytest.mark.parametrize("members, queries", [(16, 8), (200, 50)])
def test_crowded_cells_are_split_without_a_loss(spark, monkeypatch, members, queries):
    """One group holds a third of the rows: its core is counted, all others are compared in blocks."""
    monkeypatch.setattr(multiindex, "MEMBERS", members)
    monkeypatch.setattr(multiindex, "QUERIES", queries)
    rng = np.random.default_rng(4)
    rows = drawn(rng, 1, [400], labels=1, noise=0.04) + drawn(rng, 1, [300], labels=1, noise=0.065) + drawn(rng, 300, [1, 2], labels=2)
    rows = [(k, v, label) for k, (_, v, label) in enumerate(rows)]
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(40)]
    recalled(got(multiindex.near_vectors(frame(spark, rows))), plain(rows))


def test_the_core_is_counted_as_if_compared(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, v, 0) for k, (_, v, _) in enumerate(drawn(rng, 1, [300], labels=1, noise=0.03) + drawn(rng, 3, [1], labels=1))]
    whole = got(multiindex.near_vectors(frame(spark, rows)))
    monkeypatch.setattr(multiindex, "MEMBERS", 32)
    assert got(multiindex.near_vectors(frame(spark, rows))) == whole == sorted(plain(rows), key=str)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    v = [float(np.float32(c)) for c in rng.standard_normal(6)]
    w = [float(np.float32(c)) for c in rng.standard_normal(6)]
    rows = [(1, v, 0), (2, v, 0), (2, w, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [None] * 6, 0), (7, [float("nan")] * 6, 0),
            (8, [0.0] * 6, 0), (9, [], 0), (10, [2 * c for c in v], 0), (11, [1.0], 2), (12, [1.0, 0.0], 2), (13, [1.0, -0.0], 2),
            (None, w, 0), (None, [1.0, 5.0], 3), (14, [float("inf")] * 6, 0), (15, [1e-30] * 6, 4), (16, [1e30] * 6, 4), (-1, [-c for c in v], 0)]
    assert got(multiindex.near_vectors(frame(spark, rows))) == sorted(plain(rows), key=str)
    for none in ([], rows[4:10], [(1, [3.0], 0), (2, [5.0], 0), (3, [-1.0], 0)]):
        assert got(multiindex.near_vectors(frame(spark, none))) == sorted(plain(none), key=str)


def test_multi_sequence_order_and_rank():
    rng = np.random.default_rng(8)
    points = rng.standard_normal((200, 7))
    grid = Grid(points, 6)
    a, b = grid.distances(points[:30])
    cost = (a[:, :, None] + b[:, None, :]).reshape(30, -1)
    for count in (1, 3, 8, 36, 100):
        cells = grid.visited(points[:30], count)
        assert cells.shape[1] == min(count, grid.cells)
        assert np.allclose(np.take_along_axis(cost, cells, 1), np.sort(cost, axis=1)[:, :count])
    ranks = [grid.rank(a[k], b[k], int(c)) for k in range(30) for c in grid.visited(points[:30], 36)[k]]
    assert np.abs(np.array(ranks).reshape(30, -1) - np.arange(36)).max() <= 1
