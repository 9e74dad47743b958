"""Boosted trees, clusters of several starts and exact hold-out figures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankscope.functions import stats as S
from bankscope.operators import boosting as B
from bankscope.operators import clusters as K

SCHEMA = "customer_id string, a double, b double, c double, y double"


def _rows(n: int = 900) -> list[tuple]:
    rng = random.Random(4)
    out = []
    for i in range(n):
        a, b, c = rng.random(), rng.choice((0.0, 1.0, None)), rng.gauss(0, 1)
        out.append((f"c{i}", a, b, c, 3 * a + (b or 0) * (c > 0) + rng.gauss(0, 0.05)))
    return out


def _same(one: B.TreeModel, other: B.TreeModel) -> bool:
    return (one.base, one.unit, len(one.trees)) == (other.base, other.unit, len(other.trees)) and all(
        np.array_equal(getattr(x, k), getattr(y, k)) for x, y in zip(one.trees, other.trees) for k in ("column", "threshold", "bin", "value"))


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_one_task_and_passes_grow_the_same_trees(spark, monkeypatch, loss):
    """Also where margins are written in between, on other partitions, and by shuffled cells."""
    monkeypatch.setattr(B, "EVERY", 2)
    df = spark.createDataFrame(_rows(), SCHEMA).withColumn("y", F.expr("double(y > 1.5)") if loss == "logistic" else F.col("y"))
    s = B.Settings(loss, trees=3, depth=3, rate=0.3)
    one = B.fit(df, ["a", "b", "c"], "y", s)
    assert _same(one, B.fit(df.repartition(5), ["a", "b", "c"], "y", s, at_once=0))
    monkeypatch.setattr(B, "FEW", 0)
    assert _same(one, B.fit(df.repartition(3), ["a", "b", "c"], "y", s, at_once=0))
    assert all(len(set(t.column[t.column >= 0])) <= 2 for t in one.trees)  # 0.8 of three columns


def test_passes_are_small_jobs_over_persisted_blocks(spark, monkeypatch):
    """A pass over few rows has one task, however many parts the stage has; nothing stays persisted."""
    sc = spark.sparkContext
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5)
    s = B.Settings("squared", trees=5, depth=3, rate=0.3)
    one = B.fit(df, ["a", "b", "c"], "y", s)
    monkeypatch.setattr(B, "EVERY", 2)
    tasks, real, kept = [], B._cells, sc._jsc.sc().getPersistentRDDs().size()

    def counted(blocks, *rest):
        tasks.append(blocks.getNumPartitions())
        assert sc._jsc.sc().getPersistentRDDs().size() - kept <= 2
        return real(blocks, *rest)

    monkeypatch.setattr(B, "_cells", counted)
    assert _same(one, B.fit(df, ["a", "b", "c"], "y", s, at_once=0))
    assert set(tasks) == {1} and len(tasks) <= 5 * 3
    assert sc._jsc.sc().getPersistentRDDs().size() == kept


def test_many_tasks_add_up_their_cells_in_a_tree(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), SCHEMA)
    s = B.Settings("logistic", trees=2, depth=3, rate=0.3)
    df = df.withColumn("y", F.expr("double(y > 1.5)"))
    one = B.fit(df, ["a", "b", "c"], "y", s)
    for name, value in (("FEW", 0), ("_TASK", 1), ("_BLOCK", 50)):
        monkeypatch.setattr(B, name, value)
    assert _same(one, B.fit(df.repartition(9), ["a", "b", "c"], "y", s, at_once=0))


def test_trees_learn_and_come_back(spark, tmp_path):
    df = spark.createDataFrame(_rows(), SCHEMA)
    model = B.fit(df, ["a", "b", "c"], "y", B.Settings("squared", trees=60, depth=4, rate=0.2))
    scored = model.transform(df)
    assert scored.columns == [*df.columns, "prediction"]
    q = S.fit_quality(scored, "prediction", "y").first()
    assert q.n == 900 and q.r2 > 0.95
    again = B.TreeModel.load(spark, model.save(spark, f"file://{tmp_path}/m"))
    assert _same(model, again)
    want = {r.customer_id: r.prediction for r in scored.collect()}
    assert {r.customer_id: r.prediction for r in again.transform(df).collect()} == want


def test_trees_of_no_rows_and_of_one_label(spark):
    df = spark.createDataFrame(_rows(20), SCHEMA)
    s = B.Settings("logistic", trees=2, depth=2)
    assert {r.prediction for r in B.fit(df.where("false"), ["a"], "y", s).transform(df).collect()} == {0.5}
    one = B.fit(df.withColumn("y", F.lit(0.0)), ["a"], "y", s).transform(df.limit(1)).first().prediction
    assert 0 <= one < 0.01
    assert B.fit(df.withColumn("y", F.lit(None).cast("double")), ["a"], "y", s).trees == []


def test_auc_is_the_share_of_ordered_pairs(spark):
    rng = random.Random(2)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)] + [(0.0, 0), (1.0, 1), (None, 1), (0.5, None)]
    r = S.auc(spark.createDataFrame(rows, "p double, y int"), "p", "y").first()
    some = [(p, y) for p, y in rows if p is not None and y is not None]
    pos, neg = [p for p, y in some if y], [p for p, y in some if not y]
    assert (r.n, r.n_positive) == (len(some), len(pos))
    assert r.auc == sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    none = S.auc(spark.createDataFrame([(0.1, 1)], "p double, y int"), "p", "y").first()
    assert (none.n, none.auc) == (1, None) and S.auc(spark.createDataFrame([], "p double, y int"), "p", "y").first().n == 0


def test_fit_quality(spark):
    r = S.fit_quality(spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.5), (None, 1.0)], "p double, y double"), "p", "y").first()
    assert r.n == 3 and r.mae == pytest.approx(1 / 3) and r.r2 == pytest.approx(1 - 0.5 / (np.var([1.5, 2, 3.5]) * 3))


def test_clusters_of_all_starts(spark):
    """Three clouds are found; the cost is that of the assignment; partitions do not matter."""
    rng = random.Random(9)
    rows = [(f"c{i}", cx + rng.gauss(0, 0.02), cy + rng.gauss(0, 0.02)) for i, (cx, cy) in enumerate([(0.1, 0.1), (0.9, 0.2), (0.5, 0.9)] * 60)]
    df = spark.createDataFrame(rows, "customer_id string, x double, y double")
    out, cost = K.kmeans(df, ["x", "y"], 3, 4)
    got = {r.customer_id: r.cluster for r in out.collect()}
    assert sorted(np.bincount(list(got.values())).tolist()) == [60, 60, 60] and len({got[f"c{i}"] for i in range(3)}) == 3
    points = np.array([r[1:] for r in rows])
    group = np.array([got[r[0]] for r in rows])
    want = sum(((points[group == g] - points[group == g].mean(0)) ** 2).sum() for g in range(3))
    assert cost == pytest.approx(want, rel=1e-3)
    again, other = K.kmeans(df.repartition(7), ["x", "y"], 3, 4)
    assert other == cost and {r.customer_id: r.cluster for r in again.collect()} == got


def test_clusters_of_few_points(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", None)], "customer_id string, x double")
    out, cost = K.kmeans(df, ["x"], 3, 2)
    got = {r.customer_id: r.cluster for r in out.collect()}
    assert cost == 0 and got["a"] == got["b"] != got["c"]
    assert K.kmeans(df.where("false"), ["x"], 3, 2)[1] == 0


def test_repeated_customers_do_not_repeat_their_transactions(spark, tmp_path):
    """The revenue matrix counts each order once where a customer has two rows."""
    from bankscope.plans.pipeline import clear_cache, fixture_stages
    from bankscope.sources import fixtures as FX

    from .conftest import SF_SMALL
    for t in ("orders", "nation", "region", "customer"):
        df = FX.table(spark, SF_SMALL, t)
        (df.union(df) if t == "customer" else df).write.parquet(f"file://{tmp_path}/{t}.parquet")
    want = FX.table(spark, SF_SMALL, "orders").groupBy("o_custkey").count().collect()
    got = {r.customer_id: r.tx_count for r in fixture_stages(spark, f"file://{tmp_path}").revenue_matrix.collect()}
    clear_cache()
    assert all(got[str(r[0])] == r[1] for r in want if str(r[0]) in got)


def test_passes_add_up_one_of_two_children(spark, monkeypatch):
    """A pass has cells for half of a level's nodes at most; the trees are the same."""
    df = spark.createDataFrame(_rows(), SCHEMA)
    s = B.Settings("squared", trees=3, depth=4, rate=0.3)
    one = B.fit(df, ["a", "b", "c"], "y", s)
    nodes, real = [], B._cells

    def counted(sample, tree, level, *rest):
        found = real(sample, tree, level, *rest)
        nodes.append((level, found.shape[1]))
        return found

    monkeypatch.setattr(B, "_cells", counted)
    assert _same(one, B.fit(df, ["a", "b", "c"], "y", s, at_once=0))
    assert all(n <= max(1, 2 ** (level - 1)) for level, n in nodes) and max(n for _, n in nodes) > 1


def test_checkpoints_of_passes_are_deleted(spark, monkeypatch):
    import os
    monkeypatch.setattr(B, "EVERY", 2)
    found, real = [], B.delete
    monkeypatch.setattr(B, "delete", lambda sp, path: (found.append(path), real(sp, path)))
    B.fit(spark.createDataFrame(_rows(), SCHEMA), ["a", "b", "c"], "y", B.Settings("squared", trees=5, depth=2), at_once=0)
    assert len(set(found)) == 2 and not any(os.path.exists(p.removeprefix("file:")) for p in found)


def test_a_query_trains_its_own_model_only(spark, monkeypatch):
    from bankscope.operators import models as MD
    from bankscope.plans import catalog
    from bankscope.plans.pipeline import clear_cache, fixture_stages

    from .conftest import SF_SMALL
    clear_cache()
    asked = []
    for kind in ("churn", "revenue"):
        real = getattr(MD, f"fit_{kind}")
        monkeypatch.setattr(MD, f"fit_{kind}", lambda rows, params, n, kind=kind, real=real: (asked.append(kind), real(rows, params, 2))[1])
    n = catalog.QUERIES["revenue_model"](spark, SF_SMALL).count()
    st = fixture_stages(spark, SF_SMALL)
    assert n == st.customers.count() and asked == ["revenue"] and "cells" not in st.__dict__ and "churn_matrix" not in st.__dict__
    assert catalog.QUERIES["churn_model"](spark, SF_SMALL).count() == n and asked == ["revenue", "churn"] and "cells" not in st.__dict__
    assert st.model_dir and asked == ["revenue", "churn"]
    clear_cache()


def test_totals_are_those_of_the_activity(spark):
    """Also where the orders of a customer with several rows repeat."""
    from bankscope.operators import txfeatures as T
    rows = [(f"t{i}" if i % 7 else None, f"c{i % 5}" if i % 11 else None, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", None if i % 6 == 0 else i * 1.37,
             i % 12 if i % 9 else None, ["online", "ATM", "branch", "fax", None][i % 5 if i % 4 else 4]) for i in range(200)]
    tx = spark.createDataFrame(rows, "transaction_id string, customer_id string, t string, amount double, month int, channel string")
    tx = tx.withColumn("timestamp", F.to_timestamp("t")).drop("t")
    copies = spark.createDataFrame([("c0", 1), ("c1", 3), ("c2", 2)], "customer_id string, _copies long")
    got = T.customer_totals(tx)
    for totals, of in ((got, tx), (T.repeated(got.join(copies, "customer_id", "left"), "_copies"),
                                   tx.join(copies, "customer_id", "left").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_copies", F.lit(1))))))):
        want = T.customer_activity(of, unknown=True)
        assert dict(totals.dtypes) == {c: t for c, t in want.dtypes if c in totals.columns}
        assert sorted(map(str, totals.collect())) == sorted(map(str, want.select(*totals.columns).collect()))
