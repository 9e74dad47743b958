"""Models (rows and sanity metrics) and a skewed-customer input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bankscope.config import Calendar
from bankscope.operators import models as MD
from bankscope.operators import txfeatures as T
from bankscope.sources import fixtures as FX

from .conftest import SF_SMALL


def test_churn_model_scores_every_customer(spark):
    cust, tx = FX.customers(spark, SF_SMALL), FX.transactions(spark, SF_SMALL)
    rep = MD.churn_model_report(cust, tx, max_iter=5)
    rows = rep.collect()
    assert len(rows) == cust.count()
    assert all(0.0 <= r["churn_probability"] <= 1.0 for r in rows)
    assert rows[0]["holdout_auc"] > 0.5


def test_revenue_model_learns_the_target(spark):
    cust, tx = FX.customers(spark, SF_SMALL), FX.transactions(spark, SF_SMALL)
    rep = MD.revenue_model_report(cust, tx, max_iter=10)
    r = rep.agg(F.min("predicted_revenue_annual").alias("lo"), F.first("holdout_r2").alias("r2")).first()
    assert r["lo"] >= 0.0 and r["r2"] > 0.0


def test_split_is_stable_and_stratified(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("customer_id"), F.expr("if(id % 250 = 0, 1, if(id % 333 = 0, null, 0))").alias("y"))
    a = {r[0]: r[1] for r in MD.split(df.repartition(2), "y")[1].collect()}
    b = {r[0]: r[1] for r in MD.split(df.repartition(9), "y")[1].collect()}
    n = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    assert a == b and {y: list(a.values()).count(y) for y in n} == {y: -(-c // 5) for y, c in n.items()}
    train, test = MD.split(df)
    assert test.count() == 400 and train.join(test, "customer_id").count() == 0 and train.count() == 1600


def test_missing_values_count_as_zero(spark):
    cust = spark.createDataFrame([("a", None, None, None, None, None, None, None)],
                                 "customer_id string, age int, income double, account_balance double, segment string, "
                                 "churn_risk_score double, tenure_months int, region string")
    tx = FX.transactions(spark, SF_SMALL).where("false")
    r = MD.churn_features(cust, tx).first().asDict()
    assert r == {"customer_id": "a", "age": 0, "income": 0.0, "account_balance": 0.0, "tenure_months": 0, "tx_count": 0,
                 "tx_avg_amount": 0.0, "tx_std_amount": 0.0, "tx_recency_days": 365, "online_ratio": 0.5, "atm_ratio": 0.3,
                 "segment_retail": 0, "segment_premium": 0, "segment_hnw": 0, "churn_label": 0}
    assert all(v == 0 or k == "customer_id" for k, v in MD.revenue_features(cust, tx).first().asDict().items())


def test_unreadable_model_is_an_error(spark, tmp_path):
    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "junk").write_text("x")
    with pytest.raises(Exception):
        MD.load_or_train(f"file://{tmp_path}/model", lambda: pytest.fail("must not train"))
    assert (tmp_path / "model" / "junk").exists()


def test_risk_clusters_named_by_churn(spark):
    from bankscope.plans.pipeline import fixture_stages
    enr = fixture_stages(spark, SF_SMALL).enriched
    rc = MD.risk_cluster_assignments(enr, n_init=2).join(enr.select("customer_id", "churn_probability"), "customer_id")
    means = {r["risk_cluster"]: r["m"] for r in rc.groupBy("risk_cluster").agg(F.avg("churn_probability").alias("m")).collect()}
    assert set(means) == {"low", "medium", "high"}
    assert means["low"] <= means["medium"] <= means["high"]


def test_hot_customer_with_a_third_of_all_transactions(spark):
    """One customer owns a third of the rows: the roll-up pre-aggregates it
    map-side and the features stay exact."""
    cal = Calendar(start=dt.date(2023, 1, 1), n_months=24, obs_days=723)
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("customer_id"),
        F.col("id").cast("string").alias("transaction_id"),
        F.expr("timestamp'2023-01-01 08:00:00' + make_interval(0, 0, 0, cast(id % 700 as int))").alias("timestamp"),
        (F.col("id") % 50 + 1).cast("double").alias("amount"),
        F.lit("payment").alias("type"),
        F.when(F.col("id") % 2 == 0, "online").otherwise("ATM").alias("channel"),
    )
    tx = base.withColumn("month", ((F.year("timestamp") - 2023) * 12 + F.month("timestamp") - 1).cast("int"))
    f = {r["customer_id"]: r for r in T.churn_tx_features(tx, cal).collect()}
    hot = tx.where(F.col("customer_id") == "hot")
    n = hot.count()
    assert n == 10000 and f["hot"]["tx_count"] == n
    assert f["hot"]["tx_avg_amount"] == pytest.approx(hot.agg(F.avg("amount")).first()[0])
    assert f["hot"]["online_ratio"] == pytest.approx(hot.where(F.col("channel") == "online").count() / n)
