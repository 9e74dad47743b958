"""Distributed statistics vs numpy: quantiles, top-k sums, histograms, samples."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankscope.functions import stats as S


def test_distributed_quantiles_match_numpy(spark):
    rng = random.Random(5)
    vals = [round(rng.uniform(-50, 50), 2) for _ in range(997)] + [7.0] * 300
    g = [rng.choice("ab") for _ in vals]
    df = spark.createDataFrame(list(zip(g, vals)), "g string, v double")
    probs = {"p10": 0.1, "p33": 0.33, "med": 0.5, "p90": 0.9}
    whole = S.quantiles(df, "v", probs).first()
    for k, p in probs.items():
        assert whole[k] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)
    per = {r["g"]: r for r in S.quantiles(df, "v", probs, ["g"]).collect()}
    for key in "ab":
        sub = [v for v, gg in zip(vals, g) if gg == key]
        for k, p in probs.items():
            assert per[key][k] == pytest.approx(float(np.quantile(sub, p)), abs=1e-9)


def test_exact_decimal_median_of_even_count(spark):
    df = spark.createDataFrame([(0.01,), (0.02,)], "v double")
    q = S.quantiles(df, "v", {"m": 0.5}, scale=2).first()["m"]
    assert q == Decimal("0.015")  # exact midpoint, later rounded half-even


def test_top_k_sum_is_tie_safe(spark):
    vals = [5.0, 5.0, 5.0, 3.0, 1.0, 9.0, 9.0, 2.0, 2.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = S.top_k_sum(df, "v", 0.3).first()  # k = 3 -> 9 + 9 + 5
    assert r["k"] == 3 and r["top_sum"] == 23.0
    r = S.top_k_sum(df, "v", 0.01).first()  # k = max(1, 0) = 1
    assert r["k"] == 1 and r["top_sum"] == 9.0


def test_histogram_covers_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    h = S.histogram(df, "v", 10, ["g"]).collect()
    assert sum(r["count"] for r in h) == 1000
    assert max(r["bin"] for r in h) == 9 and min(r["bin"] for r in h) == 0


def test_stable_sample_ignores_partitioning(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("customer_id"))
    a = {r[0] for r in S.stable_sample(df.repartition(3), 100, 42).collect()}
    b = {r[0] for r in S.stable_sample(df.repartition(11), 100, 42).collect()}
    assert a == b and len(a) == 100


def test_quantiles_keep_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in S.quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


@pytest.mark.parametrize("reuse,adaptive", [("true", "true"), ("false", "true"), ("true", "false"), ("false", "false")])
def test_exact_quantiles_under_any_plan(spark, reuse, adaptive):
    """A million distinct values, a null group and 200 partitions."""
    n = 1_000_000
    x = ((np.arange(n, dtype=np.int64) * 7919 + 13) % 1_000_003).astype(float) / 4 - 30_000
    g = np.arange(n) % 3
    keep = {"spark.sql.shuffle.partitions": "200", "spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive}
    old = {k: spark.conf.get(k) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        df = spark.range(n, numPartitions=7).select(
            F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("g"),
            (((F.col("id") * 7919 + 13) % 1_000_003).cast("double") / 4 - 30_000).alias("v"))
        probs = {"a": 0.001, "b": 0.5, "c": 0.9, "d": 1.0}
        r = S.quantile_row(df, "v", probs).first()
        assert [r[k] for k in probs] == pytest.approx([np.quantile(x, p) for p in probs.values()], abs=1e-9)
        got = {r.g: r for r in S.five_numbers(df, "v", ["g"]).collect()}
        assert set(got) == {None, "1", "2"}
        for i, k in enumerate((None, "1", "2")):
            want = [np.quantile(x[g == i], p) for p in (0, 0.25, 0.5, 0.75, 1)]
            assert [got[k].min, got[k].q1, got[k].median, got[k].q3, got[k].max] == pytest.approx(want, abs=1e-9)
        top = S.top_k_sum(df, "v", 0.1).first()
        assert top.top_sum == pytest.approx(np.sort(x)[-100_000:].sum(), abs=0.01)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
