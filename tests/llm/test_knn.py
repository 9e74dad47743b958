import math

import numpy as np

from bankscope.llm import knn


def brute(rows, k):
    out = []
    v = {i: [math.floor(256 * float(x)) for x in e] for i, e in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for q in sorted(v):
        if q % 50 == 0:
            best = sorted(((-dot(v[q], v[i]), i) for i in v if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def _run(spark, rows, k=5):
    df = knn.integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id int, v int"))
    return sorted(map(tuple, knn.top_k(df, df.where("id % 50 = 0"), k).collect()))


def test_like_brute_force_with_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(8, 12))
    rows = [(i, (centers[i % 8] + rng.normal(size=12) * 0.05).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, rows[0][1]) for i in range(700, 1100)]  # one vector many times
    got = _run(spark, [(*r, 1, 2, 3) for r in rows])
    assert got == sorted(brute(rows, 5))


def test_unusable_vectors_take_no_part(spark):
    good = [(0, [0.5, -0.25]), (50, [1.0, 1.0]), (7, [0.1, 0.9])]
    bad = [(100, None), (8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0])]
    got = _run(spark, [(*r, None, None, None) for r in good + bad])
    assert got == sorted(brute(good, 5)) and len(got) == 4


def test_empty_and_single(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(50, [1.0], 1, 1, 1)]) == []


def test_bounds_leave_out_groups_but_no_answer():
    rng = np.random.default_rng(5)
    pivots = (rng.normal(size=(20, 6)) * 1000).astype(np.int64)
    data = (pivots[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 6)) * 20).astype(np.int64)
    cell, dist = knn._nearest(data, pivots)
    cells = np.unique(cell)
    radius = np.array([dist[cell == c].max() for c in cells])
    near = [np.sort(dist[cell == c])[:6].tolist() for c in cells]
    q = (rng.normal(size=(50, 6)) * 1000).astype(np.int64)
    to = knn._routes(pivots, cells, radius, near, 5)(q)
    assert to.mean() < 0.5
    best = np.argsort(-(q @ data.T), axis=1)[:, :5]
    for i in range(50):
        assert to[i, np.searchsorted(cells, cell[best[i]])].all()


def test_products_beyond_floating_point():
    a = np.array([[2**40, 1], [3, -5]])
    assert knn._products(a, np.array([[2**20, 1]])).tolist() == [[2**60 + 1], [3 * 2**20 - 5]]


def test_null_and_repeated_ids(spark):
    """A row without an id takes no part; equal rows are candidates of their own."""
    schema = "vec_id long, embedding array<float>"
    rows = [(0, [0.5, 0.5]), (None, [9.0, 9.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [0.25, 0.0]), (50, [1.0, 0.0])]
    df = knn.integers(spark.createDataFrame(rows, schema))
    asked = df.where("id % 50 = 0")
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in knn.top_k(df, asked.unionByName(asked), 3).collect()}
    assert got == {(0, 1): (7, 65536), (0, 2): (7, 65536), (0, 3): (50, 32768), (50, 1): (7, 65536), (50, 2): (7, 65536), (50, 3): (0, 32768)}


def test_blocks_go_only_where_they_are_visited(spark, monkeypatch):
    """With many parts of the queries: the same answers."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(1500)]
    monkeypatch.setattr(knn, "MOST_ROWS", 7)
    assert _run(spark, [(*r, 1, 2, 3) for r in rows]) == sorted(brute(rows, 5))
