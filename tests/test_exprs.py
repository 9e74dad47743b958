"""Scalar rules X2-X8, P5-P15: rounding, bins, clipping, day floors."""

import datetime as dt

from pyspark.sql import functions as F

from bankscope.functions import exprs as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_half_even_rounding_matches_numpy(spark):
    assert one(spark, F.bround(F.lit(2.5), 0)) == 2.0
    assert one(spark, F.bround(F.lit(0.125), 2)) == 0.12


def test_round_ratio_ties_are_exact(spark):
    # 0.05 / 2 = 0.025 -> 0.02 ; 0.07 / 2 = 0.035 -> 0.04 (half-even on the true value)
    assert one(spark, X.round_ratio(F.lit(5), F.lit(200), 2)) == 0.02
    assert one(spark, X.round_ratio(F.lit(7), F.lit(200), 2)) == 0.04
    assert one(spark, X.round_ratio(F.lit(-7), F.lit(200), 2)) == -0.04
    assert one(spark, X.round_ratio(F.lit(1), F.lit(3), 4)) == 0.3333
    assert one(spark, X.round_ratio(F.lit(1), F.lit(0), 2)) is None


def test_round_avg_and_pct(spark):
    s = F.lit("36020.37").cast("decimal(18,2)")
    assert one(spark, X.round_avg(s, F.lit(2), 2, 2)) == 18010.18  # 18010.185 -> even
    assert one(spark, X.round_pct(F.lit("1").cast("decimal(18,2)"), F.lit("32").cast("decimal(18,2)"), 2, 2)) == 3.12
    assert one(spark, X.round_pct(F.lit("1").cast("decimal(18,2)"), F.lit("0").cast("decimal(18,2)"), 2, 2)) is None


def test_cut_right_edges_belong_to_lower_band(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (3.0,), (9.0,), (None,)], "x double")
    out = df.select("x", X.cut_right("x", [2.0, 3.0], ["low", "medium", "high"]).alias("b")).collect()
    got = {r["x"]: r["b"] for r in out}
    assert got == {1.0: "low", 2.0: "low", 2.5: "medium", 3.0: "medium", 9.0: "high", None: None}


def test_levels_edge_belongs_to_upper_level(spark):
    df = spark.createDataFrame([(0.65,), (0.35,), (0.2,)], "p double")
    got = [r[0] for r in df.select(X.level_at_least("p", F.lit(0.65), F.lit(0.35))).collect()]
    assert got == ["High", "Medium", "Low"]


def test_age_band_outside_is_null(spark):
    from bankscope.operators.marts import age_band
    df = spark.createDataFrame([(17,), (18,), (29,), (30,), (75,), (76,)], "age int")
    got = [r[0] for r in df.select(age_band("age")).collect()]
    assert got == [None, "18-29", "18-29", "30-39", "60+", None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    got = [r[0] for r in df.select(X.clip("x", 0.0, 1.0)).collect()]
    assert got == [None, 0.0, 1.0]


def test_floor_days_floors_elapsed_time(spark):
    a = X.ts_lit(dt.datetime(2024, 1, 2, 0, 0))
    assert one(spark, X.floor_days(a, X.ts_lit(dt.datetime(2024, 1, 1, 1, 0)))) == 0
    assert one(spark, X.floor_days(a, X.ts_lit(dt.datetime(2024, 1, 5, 0, 0)))) == -3


def test_safe_ratio_and_maps(spark):
    assert one(spark, X.safe_ratio(F.lit(1), F.lit(0), 0.5)) == 0.5
    assert one(spark, X.map_values(F.lit("unknown"), {"retail": 180.0}, 250.0)) == 250.0
    assert one(spark, X.map_values(F.lit("other"), {"retail": "Retail"}, keep=True)) == "other"


def test_month_label_and_date(spark):
    assert one(spark, X.month_label(F.lit(5), dt.date(2023, 1, 1))) == "2023-06"


def test_search_is_case_insensitive_regex(spark):
    from bankscope.operators.views import search_customer
    df = spark.createDataFrame([("CID_0012",), ("cid_0120",), ("X9",)], "customer_id string")
    assert search_customer(df, "cid_001").first()["customer_id"] == "CID_0012"
    assert search_customer(df, "0.2").first()["customer_id"] == "CID_0012"
    assert search_customer(df, "0.2", regex=False).first() is None
