"""Transaction features: closed forms vs the dense 24-month grid, edge cases."""

import datetime as dt
import random

import numpy as np
import pytest

from bankscope.config import Calendar
from bankscope.operators import txfeatures as T

CAL = Calendar(start=dt.date(2023, 1, 1), n_months=24, obs_days=723)
SCHEMA = "transaction_id string, customer_id string, timestamp timestamp, amount double, type string, channel string, month int"


def tx_row(i, cust, month, amount, channel="online", day=3):
    ts = dt.datetime(2023 + (month // 12), month % 12 + 1, day, 10, 0)
    return (f"t{i}", cust, ts, float(amount), "payment", channel, month)


def dense_stats(amounts_by_month):
    a = np.zeros(24)
    for m, v in amounts_by_month.items():
        a[m] += v
    x = np.arange(24) - 11.5
    slope = float(a.dot(x) / (x ** 2).sum())
    vol = float(np.std(a, ddof=1))
    active = a > 0
    streak = 0
    for v in active[::-1]:
        if v:
            break
        streak += 1
    return slope, vol, streak


def test_closed_forms_match_dense_grid(spark):
    rng = random.Random(3)
    rows, truth, i = [], {}, 0
    for c in range(40):
        months = {}
        for _ in range(rng.randint(1, 30)):
            m = rng.randrange(24)
            v = round(rng.uniform(1, 5000), 2)
            months[m] = months.get(m, 0) + v
            rows.append(tx_row(i, f"c{c}", m, v, rng.choice(["online", "ATM", "branch"]), rng.randint(1, 28)))
            i += 1
        truth[f"c{c}"] = dense_stats(months)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["customer_id"]: r for r in T.transaction_features(df, CAL).collect()}
    for c, (slope, vol, streak) in truth.items():
        assert got[c]["spending_trend_slope"] == pytest.approx(slope, rel=1e-9, abs=1e-9)
        assert got[c]["spending_volatility"] == pytest.approx(vol, rel=1e-9, abs=1e-9)
        assert got[c]["inactivity_streak"] == streak


def test_constant_spend_and_single_month(spark):
    rows = [tx_row(m, "flat", m, 100.0) for m in range(24)] + [tx_row(100, "first", 0, 50.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["customer_id"]: r for r in T.transaction_features(df, CAL).collect()}
    assert got["flat"]["spending_trend_slope"] == 0.0
    assert got["flat"]["spending_volatility"] == 0.0
    assert got["flat"]["inactivity_streak"] == 0
    assert got["first"]["inactivity_streak"] == 23


def test_recency_can_be_negative_and_std_of_one_is_zero(spark):
    # calendar end is 2024-12-24; a transaction on 2024-12-28 gives -4 days
    rows = [("t1", "late", dt.datetime(2024, 12, 28, 0, 0), 10.0, "payment", "ATM", 23)]
    df = spark.createDataFrame(rows, SCHEMA)
    f = T.transaction_features(df, CAL).first()
    assert f["days_since_last_transaction"] == -4
    c = T.churn_tx_features(df, CAL).first()
    assert c["tx_std_amount"] == 0.0 and c["tx_count"] == 1
    assert c["atm_ratio"] == 1.0 and c["online_ratio"] == 0.0


def test_windowed_counts_and_active_days(spark):
    end = CAL.end  # 2024-12-24
    rows = [("a", "c", dt.datetime(2024, 12, 20, 9), 1.0, "payment", "online", 23),
            ("b", "c", dt.datetime(2024, 12, 20, 18), 2.0, "payment", "branch", 23),
            ("d", "c", dt.datetime(2024, 10, 1, 9), 3.0, "payment", "online", 21),
            ("e", "c", dt.datetime(2024, 1, 1, 9), 4.0, "payment", "online", 12)]
    assert end == dt.date(2024, 12, 24)
    df = spark.createDataFrame(rows, SCHEMA)
    f = T.transaction_features(df, CAL).first()
    assert f["transaction_count_30d"] == 2
    assert f["transaction_count_90d"] == 3
    assert f["active_days_ratio"] == pytest.approx(3 / 723)
    assert f["online_channel_ratio"] == pytest.approx(0.75)
    assert f["avg_transaction_amount"] == pytest.approx(2.5)


def test_active_days_where_a_day_has_several_months(spark):
    """Each day counts once, however its transactions' months are set, also
    before 1970 and without a time; against the set of days in Python."""
    at = [dt.datetime(2024, 3, 1, 0, 0), dt.datetime(2024, 3, 1, 23, 59), dt.datetime(2024, 3, 1, 12), dt.datetime(2024, 5, 4, 1),
          dt.datetime(1969, 12, 31, 1), dt.datetime(1969, 10, 28, 1), dt.datetime(1970, 1, 1), None]
    at += [dt.datetime(2023, 1, 1) + dt.timedelta(days=i * 7 % 400) for i in range(200)]
    rows = [(str(i), "c" if i % 3 else "d", t, 1.0, "payment", "online", (None, 3, 5, 14)[i % 4]) for i, t in enumerate(at)]
    want = {c: len({r[2].date() for r in rows if r[1] == c and r[2]}) for c in "cd"}
    got = {r.customer_id: r.active_days for r in T.active_days(spark.createDataFrame(rows, SCHEMA), CAL).collect()}
    assert got == want
