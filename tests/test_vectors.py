"""Exact neighbours of many queries against the full scan."""

import math
import random

import pytest

from vacantia.operators import vectors


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def usable(v):
    return v is not None and None not in v and all(map(math.isfinite, v)) and any(v)


def compared(spark, data, asked, n, centres=None):
    df = spark.createDataFrame(data, "id bigint, v array<double>, _n string")
    rows, clusters = vectors.index(df, ["id"], "v", centres)
    queries = spark.createDataFrame(asked, "q bigint, v array<double>")
    best, scanned = vectors.nearest(queries, ["q"], "v", rows, clusters, ["id"], n)
    got = {}
    for r in best.collect():
        got.setdefault(r["q"], []).append((r["rank"], r["id"], r["similarity"]))
    for q, v in asked:
        wanted = sorted(((-round(cosine(v, w), 10), i) for i, w, _ in data if usable(w)))[:n] if usable(v) else []
        found = sorted(got.get(q, []))
        assert [r for r, _, _ in found] == list(range(1, len(wanted) + 1))
        assert [s for _, _, s in found] == pytest.approx([-s for s, _ in wanted], abs=1e-9)
        assert {i for _, i, _ in found} == {i for _, i in wanted} or len({s for s, _ in wanted}) < len(wanted)
    return {r["q"]: r["scanned"] / r["rows"] for r in scanned.collect()}


def test_clusters_are_passed_over(spark):
    """A hundred queries on grouped vectors: exact, and most rows are not compared."""
    rng = random.Random(1)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    data = [(i, [m + rng.gauss(0, .1) for m in middles[i % 60]], "x") for i in range(3000)]
    asked = [(i, [x + rng.gauss(0, .05) for x in data[i * 7][1]]) for i in range(100)]
    share = compared(spark, data, asked, 5)
    assert len(share) == 100 and sum(share.values()) / 100 < 0.3


@pytest.mark.parametrize("n, centres", [(3, None), (50, 1), (200, 7)])
def test_neighbours_of_unlike_vectors(spark, n, centres):
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) for _ in range(5)], "x") for i in range(150)]
    data += [(200 + i, data[i][1], "x") for i in range(20)]
    data += [(300, None, "x"), (301, [None] * 5, "x"), (302, [0.0] * 5, "x"), (303, [float("nan")] * 5, "x"), (304, [float("inf"), 0.0, 0.0, 0.0, 0.0], "x")]
    asked = [(1, data[3][1]), (2, [rng.gauss(0, 1) for _ in range(5)]), (3, None), (4, [0.0] * 5), (5, [-x for x in data[3][1]])]
    compared(spark, data, asked, n, centres)


def test_no_rows(spark):
    assert compared(spark, [], [(1, [1.0])], 3) == {}
    assert compared(spark, [(1, [1.0], "x")], [], 3) == {}


def test_blocks_meet_in_numpy(spark, monkeypatch):
    """Large clusters and many queries are cut into blocks; copies tie by key, as in one scan."""
    monkeypatch.setattr(vectors, "ROWS", 16)
    monkeypatch.setattr(vectors, "QUERIES", 8)
    rng = random.Random(3)
    data = [(i, [rng.gauss(0, 1) for _ in range(6)], "x") for i in range(200)]
    data += [(1000 - i, data[0][1], "x") for i in range(60)] + [(2000, [1.0, 2.0], "x")]
    asked = [(i, data[i][1]) for i in range(30)]
    df = spark.createDataFrame(data, "id bigint, v array<double>, _n string")
    rows, clusters = vectors.index(df, ["id"], "v", 2)
    best, _ = vectors.nearest(spark.createDataFrame(asked, "q bigint, v array<double>"), ["q"], "v", rows, clusters, ["id"], 5)
    got = {}
    for r in best.collect():
        got.setdefault(r["q"], []).append((r["rank"], r["id"]))
    for q, v in asked:
        wanted = sorted((-round(cosine(v, w), 10), i) for i, w, _ in data if len(w) == 6)[:5]
        assert [i for _, i in sorted(got[q])] == [i for _, i in wanted]
