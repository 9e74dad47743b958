"""Missing values, gaps, unknown segments, scans of the fact table, stages."""

import datetime as dt

import pytest

from bankscope import session
from bankscope.operators import marts as M
from bankscope.operators import scoring as SC
from bankscope.operators import txfeatures as T
from bankscope.plans import catalog
from bankscope.plans.pipeline import clear_cache, fixture_stages
from bankscope.sources import fixtures as FX
from bankscope.sources import readers, schema

from .conftest import SF_SMALL

TX = "transaction_id string, customer_id string, timestamp timestamp, amount double, type string, channel string, month int, segment string"


def _tx(spark, rows):
    return spark.createDataFrame([(str(i), c, dt.datetime(1995 + m // 12, m % 12 + 1, 5), a, "payment", "online", m, s)
                                  for i, (c, m, a, s) in enumerate(rows)], TX)


def test_all_orders_are_transactions(spark):
    assert FX.transactions(spark, SF_SMALL).count() == FX.table(spark, SF_SMALL, "orders").count()


def test_nan_amounts_are_missing(spark, tmp_path):
    _tx(spark, [("a", 0, 10.0, "retail"), ("a", 0, float("nan"), "retail")]).write.parquet(f"file://{tmp_path}/tx.parquet")
    tx = readers.read_table(spark, f"file://{tmp_path}/tx.parquet", schema.TX_SCHEMA)
    r = T.transaction_features(tx).first()
    assert r.avg_transaction_amount == 10.0
    none = T.transaction_features(_tx(spark, [("b", 0, None, None)])).first()
    assert none.avg_transaction_amount == 0.0


def test_segment_amounts_sum_to_the_month(spark):
    tx = _tx(spark, [("a", 0, 10.0, "retail"), ("b", 0, 5.0, "unknown"), ("c", 0, 2.5, None), ("a", 1, 1.0, "premium")])
    enr = spark.createDataFrame([("a", 0.5, 1.0, "High")], "customer_id string, churn_probability double, revenue_at_risk double, risk_level string")
    for r in M.time_series(tx, enr).collect():
        assert sum(r[c] for c in M.SEGMENT_AMOUNTS) == r.total_transaction_amount
    long = M.monthly_segment_amount(tx)
    assert {(r.calendar_ym, r.segment): r.amount for r in long.collect()} == {
        ("1995-01", "retail"): 10.0, ("1995-01", "unknown"): 5.0, ("1995-01", None): 2.5, ("1995-02", "premium"): 1.0}


def test_rolling_mean_leaves_out_months_without_a_value(spark):
    tx = _tx(spark, [("a", 0, 1.0, None), ("zz", 1, 1.0, None), ("a", 2, 1.0, None)])
    enr = spark.createDataFrame([("a", 0.5, 1.0, "High")], "customer_id string, churn_probability double, revenue_at_risk double, risk_level string")
    got = [r.churn_prob_3m_rolling_avg for r in M.time_series(tx, enr).orderBy("calendar_ym").collect()]
    assert got == [0.5, 0.5, 0.5]


def test_missing_churn_score(spark):
    cust = spark.createDataFrame([("a", None), ("b", 0.25)], "customer_id string, churn_risk_score double").selectExpr(
        "*", "'retail' as segment", "1 as age", "1d as income", "1d as account_balance", "1 as tenure_months", "'x' as region")
    out = {r.customer_id: r for r in SC.exact_scoring_table(cust, _tx(spark, [("a", 0, 100.0, None), ("b", 0, 100.0, None)])).collect()}
    assert (out["a"].churn_probability, out["a"].clv, out["a"].financial_value_score) == (0.5, 0.0, 0.0)
    assert out["b"].clv > 0


@pytest.mark.parametrize("name", ["churn_matrix", "clv", "kpi_time_series", "view_v10_trend_cards", "churn_tx_features"])
def test_orders_are_read_once(spark, name):
    """Rows of orders that the query reads, stages included."""
    clear_cache()
    acc = spark.sparkContext.accumulator(0)
    real = FX.table

    def counted(s, d, t):
        df = real(s, d, t)
        if t != "orders":
            return df

        def each(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b

        return df.mapInArrow(each, df.schema)

    FX.table = counted
    try:
        catalog.QUERIES[name](spark, SF_SMALL).collect()
    finally:
        FX.table = real
        clear_cache()
    assert acc.value == real(spark, SF_SMALL, "orders").count()


@pytest.mark.parametrize("name", ["monthly_segment_columns", "monthly_risk", "revenue_matrix"])
def test_orders_are_read_once_by_series_and_matrices(spark, name):
    test_orders_are_read_once(spark, name)


def test_no_scratch_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_stages_are_deleted_and_follow_their_inputs(spark):
    import os

    clear_cache()
    st = fixture_stages(spark, SF_SMALL)
    path = st.scoring.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert os.path.exists(path) and fixture_stages(spark, SF_SMALL + "/") is st
    clear_cache()
    assert not os.path.exists(path) and fixture_stages(spark, SF_SMALL) is not st
    clear_cache()


def test_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "a.parquet").write_text("no table")
    with pytest.raises(Exception) as e:
        readers.read_first_available(spark, [f"file://{tmp_path}/a.parquet"]).collect()
    assert not isinstance(e.value, readers.InputMissing)
