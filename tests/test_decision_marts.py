"""Decisions, enrichment, marts and KPIs: rules, relations and golden values."""

import pytest
from pyspark.sql import functions as F

from bankscope import config as C
from bankscope.operators import decision as D
from bankscope.operators import enrich as E
from bankscope.operators import kpis as K
from bankscope.operators import marts as M
from bankscope.operators import scoring as SC
from bankscope.plans.pipeline import fixture_stages

from .conftest import SF_SMALL

SCORING = ("customer_id string, segment string, age int, income double, account_balance double, "
           "tenure_months int, region string, churn_risk_score double, churn_probability double, "
           "predicted_revenue_annual double, clv double, financial_value_score double")


def test_hnw_high_risk_low_value_gets_premium_retention(spark):
    rows = [("h", "high_net_worth", 40, 1e5, 1e4, 12, "X", 0.9, 0.9, 10.0, 1.0, 0.0),
            ("r", "retail", 40, 1e5, 1e4, 12, "X", 0.9, 0.9, 10.0, 1.0, 0.0),
            ("l1", "retail", 40, 1e5, 1e4, 12, "X", 0.1, 0.1, 10.0, 1.0, 1.0),
            ("l2", "premium", 40, 1e5, 1e4, 12, "X", 0.2, 0.2, 10.0, 1.0, 0.5),
            ("l3", "premium", 40, 1e5, 1e4, 12, "X", 0.1, 0.1, 10.0, 1.0, 0.8),
            ("l4", "premium", 40, 1e5, 1e4, 12, "X", 0.1, 0.1, 10.0, 1.0, 0.9)]
    rec = {r["customer_id"]: r for r in D.apply_recommendations(spark.createDataFrame(rows, SCORING)).collect()}
    assert rec["h"]["risk_level"] == "High" and rec["h"]["financial_value"] == "Low"
    assert rec["h"]["recommended_action"] == C.RETAIN_PREMIUM
    assert rec["h"]["action_rationale"].startswith("risk High, value ") and rec["h"]["action_rationale"].endswith(f"-> {C.RETAIN_PREMIUM}")
    assert rec["r"]["recommended_action"] == C.MONITOR
    # priority = 0.5 * 0.9 * 3 + 0.5 * 0 * 1 = 1.35 (unchanged by the override)
    assert rec["h"]["priority_score"] == 1.35


def test_flat_clv_scores_half(spark):
    ch = spark.createDataFrame([("a", 0.2), ("b", 0.2)], "customer_id string, churn_probability double")
    rv = spark.createDataFrame([("a", 100.0), ("b", 100.0)], "customer_id string, predicted_revenue_annual double")
    got = [r["financial_value_score"] for r in SC.compute_clv(ch, rv).collect()]
    assert got == [0.5, 0.5]


def test_clv_formula(spark):
    ch = spark.createDataFrame([("a", 0.25)], "customer_id string, churn_probability double")
    rv = spark.createDataFrame([("a", 1000.0)], "customer_id string, predicted_revenue_annual double")
    clv = SC.compute_clv(ch, rv).first()["clv"]
    assert clv == round(1000 * 0.18 * 0.75 * C.DEFAULT_PARAMS.discount_factor, 2)


def test_unknown_segment_costs_default(spark):
    df = spark.createDataFrame([("x", "mystery", 100.0, 0.5, 0.3, 24)],
                               "customer_id string, segment string, predicted_revenue_annual double, "
                               "churn_probability double, financial_value_score double, tenure_months int")
    r = E.financial_features(df).first()
    assert r["cost_to_serve"] == 250.0
    assert r["estimated_margin_per_client"] == 18.0 and r["net_profit_per_client"] == -232.0
    assert r["revenue_at_risk"] == 50.0 and r["balance_decay_rate"] == 0.3
    assert r["customer_tenure_years"] == 2.0


@pytest.fixture(scope="module")
def stages(spark):
    return fixture_stages(spark, SF_SMALL)


def test_customers_without_transactions_get_zero_features(spark, stages):
    r = E.enrich(stages.recommendations, stages.transactions.where("customer_id <> '7'")).where("customer_id = '7'").first()
    assert r["avg_transaction_amount"] == 0.0
    assert r["transaction_count_30d"] == 0 and r["days_since_last_transaction"] == 0
    assert r["inactivity_streak"] == 0 and r["online_channel_ratio"] == 0.0


def test_every_aggregation_level_covers_all_customers(spark, stages):
    fa = M.financial_aggregates(stages.enriched).collect()
    n = stages.enriched.count()
    crit = [r for r in fa if r["aggregation_level"] == "total"][0]["critical_count"]
    levels = {r["aggregation_level"] for r in fa}
    assert len(levels) == 8
    for lvl in levels:
        rows = [r for r in fa if r["aggregation_level"] == lvl]
        assert sum(r["n_customers"] for r in rows) == n
        assert sum(r["critical_count"] for r in rows) == crit
    seg = [r for r in fa if r["aggregation_level"] == "by_segment"]
    assert all(r["segment"] is not None and r["region"] is None for r in seg)


def test_buckets_cover_all_rows_and_scores_in_range(spark, stages):
    rec = stages.recommendations
    assert rec.where(F.col("risk_level").isNull() | F.col("recommended_action").isNull()).count() == 0
    e = stages.enriched.agg(F.min("engagement_index"), F.max("engagement_index"),
                            F.min("financial_value_score"), F.max("financial_value_score")).first()
    assert 0 <= e[0] <= e[1] <= 1 and e[2] == 0.0 and e[3] == 1.0


def test_time_series_relations(spark, stages):
    ts = M.time_series(stages.transactions_with_segment, stages.enriched).orderBy("calendar_ym").collect()
    assert len(ts) == 80 and [r["month_index"] for r in ts] == list(range(1, 81))
    for r in ts:
        parts = sum(r[c] for c in M.SEGMENT_AMOUNTS)
        assert parts == pytest.approx(r["total_transaction_amount"], abs=1e-6)
        assert r["estimated_monthly_revenue"] == pytest.approx(r["total_transaction_amount"] * 0.18 / 80, abs=0.006)
    assert ts[0]["revenue_mom_growth_pct"] is None


# Golden rows: the published 24-month series (revenue, volume) of the
# original pipeline's output, typed in as literals.
GOLDEN = [("2023-01", 198282.3, 20900), ("2023-02", 190444.52, 20721), ("2023-03", 179161.84, 20826),
          ("2023-04", 158164.41, 20857), ("2023-05", 138586.81, 21084), ("2023-06", 119391.57, 20648),
          ("2023-07", 113037.62, 20668), ("2023-08", 119187.64, 20715), ("2023-09", 134113.72, 20897),
          ("2023-10", 151901.65, 20789), ("2023-11", 170782.35, 20867), ("2023-12", 184013.18, 21102),
          ("2024-01", 188449.45, 21024), ("2024-02", 178752.07, 21009), ("2024-03", 168276.74, 20828),
          ("2024-04", 146125.99, 20941), ("2024-05", 125885.47, 20670), ("2024-06", 113649.12, 20886),
          ("2024-07", 108395.42, 20862), ("2024-08", 112162.71, 20544), ("2024-09", 124432.13, 20872),
          ("2024-10", 142367.25, 21018), ("2024-11", 156390.99, 20488), ("2024-12", 170445.07, 20784)]


def golden(spark):
    return spark.createDataFrame(GOLDEN, "calendar_ym string, estimated_monthly_revenue double, "
                                         "transaction_volume bigint")


def test_golden_time_series_kpis(spark):
    k = K.kpi_time_series(golden(spark)).first()
    assert k["revenue_trend_6m_slope"] == 13167.66
    assert k["revenue_trend_direction"] == "GROWING"
    assert k["peak_revenue_month"] == "2023-01" and k["peak_monthly_revenue"] == 198282.3
    assert k["latest_month"] == "2024-12" and k["latest_monthly_revenue"] == 170445.07
    assert k["avg_monthly_revenue"] == 149683.33 and k["avg_monthly_tx_volume"] == 20833.0


def test_golden_rolling_and_growth(spark):
    t = golden(spark).select("calendar_ym", *M.revenue_trends(golden(spark))).orderBy("calendar_ym").collect()
    assert [r["revenue_3m_rolling_avg"] for r in t[:5]] == [198282.3, 194363.41, 189296.22, 175923.59, 158637.69]
    assert [r["revenue_mom_growth_pct"] for r in t[:4]] == [None, -3.95, -5.92, -11.72]
    assert [r["tx_volume_3m_rolling_avg"] for r in t[:3]] == [20900.0, 20810.0, 20816.0]
    assert t[-1]["revenue_3m_rolling_avg"] == 156401.1


def test_series_of_one_month_has_no_trend_kpis(spark):
    one = spark.createDataFrame([("2023-01", 10.0, 5)], "calendar_ym string, estimated_monthly_revenue double, "
                                                          "transaction_volume bigint")
    assert K.kpi_time_series(one).count() == 0


def test_general_scoring_table_equals_staged_scorer(spark, stages):
    """C3 with separate prediction tables gives the same table as the
    single-join deterministic scorer used by the pipeline."""
    from bankscope.plans.catalog import _scoring_general
    a = sorted(tuple(r) for r in _scoring_general(spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in stages.scoring.collect())
    assert a == b


def test_stages_are_built_only_when_read(spark):
    from bankscope.plans.pipeline import fixture_stages as fs
    st = fs(spark, SF_SMALL, reuse=False)
    assert st.scoring.count() == st.customers.count()
    assert "_base" in st.__dict__ and "_rec" not in st.__dict__ and "enriched" not in st.__dict__
    st.recommendations.count()
    assert "_rec" in st.__dict__ and "enriched" not in st.__dict__
