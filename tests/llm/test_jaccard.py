import random

from bankscope.llm import common, jaccard

from . import fixtures as B


def _check(spark, texts, size, similarity):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(df, size, similarity).collect()}
    assert got == B.jaccard(texts, size, *similarity)
    return got


def test_like_brute_force(spark, texts):
    got = _check(spark, texts, 3, (90, 100))
    assert len({c for _, c in got.values()}) < len(texts) - 10
    _check(spark, texts, 5, (80, 100))


def test_edges_of_the_table(docs, empty):
    got = jaccard.link(docs).collect()
    assert len(got) == docs.count()
    none = [r for r in got if r.doc_id is None]
    assert len(none) == 1 and none[0].component_id is None and none[0].n_shingles > 0
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    assert jaccard.link(empty).collect() == []


def test_large_group_of_near_copies(spark, monkeypatch):
    """A group that only the comparison in blocks can finish."""
    monkeypatch.setattr(common, "FEW", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    texts = {}
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice((2, 4, 5, 6, 7, 9))):
            w[rng.randrange(300)] = f"x{rng.randrange(40)}"
        texts[i] = " ".join(w)
    got = _check(spark, texts, 3, (90, 100))
    assert 2 < len({c for _, c in got.values()}) < 90


def test_signatures_are_shared_by_all_similar_sets():
    import numpy as np

    rng = np.random.default_rng(1)
    for a, b in ((90, 100), (80, 100)):
        edges = jaccard._band_edges((a, b))
        for n in (1, 4, 9, 10, 11, 20, 57, 300, 1500):
            for _ in range(20):
                x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                gone = int(rng.integers(0, len(x) * (b - a) // b + 1))
                y = x[gone:]
                while True:  # add as many as similarity allows
                    z = np.unique(np.append(y, rng.integers(0, 1 << 63, 1, dtype=np.uint64)))
                    both = len(np.intersect1d(x, z))
                    if both * b < (len(x) + len(z) - both) * a:
                        break
                    y = z
                sx, sy = (set(jaccard.signatures(s, (a, b), edges).tolist()) for s in (x, y))
                assert sx & sy, (a, n, gone)


def test_sets_are_shuffled_only_if_an_id_comes_again(spark, monkeypatch):
    plans, stage = [], jaccard.stage

    def noted(df, name):
        if name == "jaccard-sets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(jaccard, "stage", noted)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{text} x{i % 3}") for i in range(6)] + [(9, "unlike all others")]
    for more in ([], [(0, f"{text} x0")]):
        df = spark.createDataFrame(rows + more, "doc_id long, text string")
        got = {(r.doc_id, r.component_id) for r in jaccard.link(df).collect()}
        assert got == {(i, 0) for i in range(6)} | {(9, 9)}
    assert ["hashpartitioning(rep" in p for p in plans] == [False, True]
