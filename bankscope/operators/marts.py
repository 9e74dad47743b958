"""The three marts: customer table (B1), financial aggregates (A16, A17,
U1) and the monthly time series (B2: A18-A21, W1-W3, J6-J8)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import config as C
from ..config import DEFAULT_CALENDAR, DEFAULT_PARAMS, Calendar, Params
from ..functions import exprs as X
from ..functions import stats as S
from . import txfeatures as TXF

# -- B1: customer mart --------------------------------------------------------

# (source column, mart column) in mart order.
# Names and order of the output columns.
CUSTOMER_MART_MAP = [
    ("customer_id", "customer_id"), ("segment", "segment"), ("region", "region"), ("age", "age"),
    ("income", "income"), ("account_balance", "account_balance"),
    ("customer_tenure_years", "customer_tenure_years"),
    ("transaction_count_30d", "transaction_count_30d"), ("transaction_count_90d", "transaction_count_90d"),
    ("active_days_ratio", "active_days_ratio"), ("spending_trend_slope", "spending_trend_slope"),
    ("spending_volatility", "spending_volatility"), ("avg_transaction_amount", "avg_transaction_amount"),
    ("engagement_index", "engagement_index"),
    ("days_since_last_transaction", "days_since_last_transaction"), ("inactivity_streak", "inactivity_streak"),
    ("balance_decay_rate", "balance_decay_rate"),
    ("total_revenue_generated", "total_revenue_generated"),
    ("estimated_margin_per_client", "estimated_margin_per_client"), ("cost_to_serve", "cost_to_serve"),
    ("net_profit_per_client", "net_profit_per_client"), ("clv", "clv_5yr"),
    ("churn_probability", "churn_probability"), ("churn_probability_pct", "churn_probability_pct"),
    ("revenue_at_risk", "revenue_at_risk"), ("risk_level", "risk_level"), ("risk_cluster", "risk_cluster"),
    ("value_cluster", "value_cluster"), ("financial_value", "financial_value"),
    ("financial_value_score", "financial_value_score"), ("customer_value_score", "customer_value_score"),
    ("risk_adjusted_value_score", "risk_adjusted_value_score"),
    ("recommended_action", "recommended_action"), ("priority_score", "priority_score"),
]


def value_tier(clv: str, df: DataFrame, params: Params = DEFAULT_PARAMS) -> Column:
    """CLV p40/p70/p90 bands, right-closed -> Standard..Elite."""
    names = ["p40", "p70", "p90"]
    q = S.scalars(S.quantile_row(df, clv, dict(zip(names, params.tier_ps))))
    return X.cut_right(clv, [q[n] for n in names], list(C.VALUE_TIERS))


def age_band(age: str = "age") -> Column:
    """(17,29] 18-29 ... (59,75] 60+; outside -> null."""
    return X.cut_right(age, list(C.AGE_BAND_EDGES), list(C.AGE_BANDS), open_ends=False)


def customer_mart(enriched: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """B1 (P2, P11-P14): 34 projected columns + 8 display columns."""
    out = enriched.select(*[F.col(s).alias(t) for s, t in CUSTOMER_MART_MAP if s in enriched.columns])
    out = out.withColumns({
        "segment_label": X.map_values("segment", C.SEGMENT_LABEL, keep=True),
        "action_urgency": X.map_values("recommended_action", C.ACTION_URGENCY, C.DEFAULT_URGENCY),
        "action_code": X.map_values("recommended_action", C.ACTION_CODE, C.DEFAULT_ACTION_CODE),
    })
    out = out.withColumns({"value_tier": value_tier("clv_5yr", out, params), "age_band": age_band("age")})
    hr = (F.col("risk_level") == "High").cast("int")
    hv = (F.col("financial_value") == "High").cast("int")
    return out.withColumns({"is_high_risk": hr, "is_high_value": hv, "is_critical": hr * hv})


# -- A16: financial aggregates -------------------------------------------------

# Dimensions and level names of the aggregates.
DIMENSIONS = ["segment", "region", "risk_level", "recommended_action"]
# (level name, grouped columns in key order); fixed level names of the mart.
LEVELS = [
    ("total", []),
    ("by_segment", ["segment"]),
    ("by_region", ["region"]),
    ("by_risk_level", ["risk_level"]),
    ("by_action", ["recommended_action"]),
    ("by_segment_risk", ["segment", "risk_level"]),
    ("by_segment_region", ["segment", "region"]),
    ("by_risk_action", ["risk_level", "recommended_action"]),
]
# Names and order of the output columns.
AGG_COLUMNS = [
    "dimension_key", "aggregation_level", "n_customers", "total_revenue", "avg_revenue_per_customer",
    "total_revenue_at_risk", "total_net_profit", "avg_net_profit", "total_clv", "avg_clv",
    "avg_churn_probability", "high_risk_count", "high_value_count", "critical_count", "avg_engagement",
    "avg_priority_score", "total_cost_to_serve", "churn_rate_pct", "revenue_at_risk_pct",
    "profitability_ratio", "segment", "region", "risk_level", "recommended_action",
]


def _gid(cols: list[str]) -> int:
    return sum(1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS) if d not in cols)


def financial_aggregates(enriched: DataFrame) -> DataFrame:
    """A16 + A17 + U1 (P10): 15 measures and 3 ratios at 8 levels.

    One GROUPING SETS aggregation (a single scan with Expand and map-side
    partial aggregation) instead of eight group-bys and a union.  Groups
    whose key has a null value are dropped, as a group-by would.
    """
    hr = F.col("risk_level") == "High"
    hv = F.col("financial_value") == "High"
    g = enriched.groupingSets([[F.col(c) for c in cols] for _, cols in LEVELS], *DIMENSIONS).agg(
        F.grouping_id().alias("_gid"),
        F.count("customer_id").alias("n_customers"),
        X.exact_sum("predicted_revenue_annual", 2).alias("_rev"), F.count("predicted_revenue_annual").alias("_nrev"),
        X.exact_sum("revenue_at_risk", 2).alias("_rar"),
        X.exact_sum("net_profit_per_client", 2).alias("_np"), F.count("net_profit_per_client").alias("_nnp"),
        X.exact_sum("clv", 2).alias("_clv"), F.count("clv").alias("_nclv"),
        X.exact_sum("churn_probability", 4).alias("_p"), F.count("churn_probability").alias("_np4"),
        X.count_if(hr).alias("high_risk_count"), X.count_if(hv).alias("high_value_count"),
        X.count_if(hr & hv).alias("critical_count"),
        X.exact_sum("engagement_index", 4).alias("_eng"), F.count("engagement_index").alias("_neng"),
        X.exact_sum("priority_score", 4).alias("_pri"), F.count("priority_score").alias("_npri"),
        X.exact_sum("cost_to_serve", 2).alias("_cost"),
    )
    # The levels are a few dozen rows.  A stage boundary keeps the exact
    # rounding projection out of the aggregate's generated method (which
    # would otherwise exceed the JVM's 64 KB method size and fall back to
    # interpreted evaluation).
    g = g.repartition(1)
    level = None
    valid = None
    key = None
    for name, cols in LEVELS:
        is_level = F.col("_gid") == _gid(cols)
        level = F.when(is_level, name) if level is None else level.when(is_level, name)
        ok = F.lit(True)
        for c in cols:
            ok = ok & F.col(c).isNotNull()
        valid = F.when(is_level, ok) if valid is None else valid.when(is_level, ok)
        k = F.lit("ALL") if not cols else X.dimension_key(cols)
        key = F.when(is_level, k) if key is None else key.when(is_level, k)
    total = F.col("_gid") == _gid([])

    def avg2(s: str, n: str, scale: int) -> Column:
        # total row: round to 4 dp first, then to 2 dp (two-step as in the mart)
        four = X.round_avg(F.col(s), F.col(n), scale, 4)
        two = X.round_avg(F.col(s), F.col(n), scale, 2)
        return F.when(total, X.dround(X.dec(four, 4), 2)).otherwise(two)

    out = g.where(valid).select(
        key.alias("dimension_key"), level.alias("aggregation_level"), "n_customers",
        X.dround(F.col("_rev"), 2).alias("total_revenue"),
        X.round_avg(F.col("_rev"), F.col("_nrev"), 2, 2).alias("avg_revenue_per_customer"),
        X.dround(F.col("_rar"), 2).alias("total_revenue_at_risk"),
        X.dround(F.col("_np"), 2).alias("total_net_profit"),
        X.round_avg(F.col("_np"), F.col("_nnp"), 2, 2).alias("avg_net_profit"),
        X.dround(F.col("_clv"), 2).alias("total_clv"),
        X.round_avg(F.col("_clv"), F.col("_nclv"), 2, 2).alias("avg_clv"),
        avg2("_p", "_np4", 4).alias("avg_churn_probability"),
        "high_risk_count", "high_value_count", "critical_count",
        avg2("_eng", "_neng", 4).alias("avg_engagement"),
        avg2("_pri", "_npri", 4).alias("avg_priority_score"),
        X.dround(F.col("_cost"), 2).alias("total_cost_to_serve"),
        X.round_ratio(F.col("high_risk_count") * F.lit(100), F.col("n_customers"), 2).alias("churn_rate_pct"),
        X.round_pct(F.col("_rar"), F.col("_rev"), 2, 2).alias("revenue_at_risk_pct"),
        X.round_pct(F.col("_np"), F.col("_rev"), 2, 2).alias("profitability_ratio"),
        *DIMENSIONS,
    )
    return out


# -- B2: monthly time series ----------------------------------------------------

# Names and order of the output columns.
TS_COLUMNS = [
    "calendar_ym", "transaction_volume", "total_transaction_amount", "avg_transaction_amount",
    "unique_active_customers", "estimated_monthly_revenue", "avg_churn_probability", "high_risk_active_count",
    "monthly_revenue_at_risk", "tx_amount_high_net_worth", "tx_amount_premium", "tx_amount_retail", "tx_amount_other",
    "calendar_date", "month_index", "revenue_3m_rolling_avg", "churn_prob_3m_rolling_avg",
    "tx_volume_3m_rolling_avg", "revenue_mom_growth_pct",
]


def customer_months(tx: DataFrame) -> DataFrame:
    """(customer, month) cells: transaction rows, ids, amounts (exact), in all
    and by the transaction's segment (``other``: none or an unknown one)."""
    return (tx.where(F.col("month").isNotNull())
              .groupBy("customer_id", "month")
              .agg(F.count(F.lit(1)).alias("n_rows"), F.count("transaction_id").alias("n_tx"),
                   F.count("amount").alias("n_amt"), X.exact_sum("amount", 4).alias("amt"), *TXF.segment_amounts(tx.columns)))


def cells_of(month_cells: DataFrame) -> DataFrame:
    """The same cells from the table of ``txfeatures.month_cells``."""
    return month_cells.where(F.col("month").isNotNull()).withColumnsRenamed({"n": "n_tx", "a": "amt"})


SEGMENT_AMOUNTS = [f"tx_amount_{s}" for s in [*sorted(C.SEGMENTS), "other"]]


def monthly_segment_amount(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """One row per month and segment found among the transactions."""
    return (tx.where(F.col("month").isNotNull()).groupBy("month", "segment").agg(X.exact_sum("amount", 4).alias("_a"))
              .select(X.month_label("month", cal.start).alias("calendar_ym"), "segment",
                      F.coalesce(X.dround(F.col("_a"), 4), F.lit(0.0)).alias("amount")))


def monthly_tx(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR, params: Params = DEFAULT_PARAMS,
               cells: DataFrame | None = None) -> DataFrame:
    """Volume, amount, mean, distinct customers, estimated revenue."""
    cm = cells if cells is not None else customer_months(tx)
    per = (Decimal(str(params.margin_rate)) / Decimal(cal.n_months)).quantize(Decimal("1e-10"))
    g = cm.groupBy("month").agg(F.sum("n_tx").alias("transaction_volume"), F.sum("amt").alias("_amt"),
                                F.sum("n_amt").alias("_namt"), F.count("customer_id").alias("unique_active_customers"))
    return g.select(
        X.month_label("month", cal.start).alias("calendar_ym"), "transaction_volume",
        X.dround(F.col("_amt"), 4).alias("total_transaction_amount"),
        X.round_avg(F.col("_amt"), F.col("_namt"), 4, 4).alias("avg_transaction_amount"),
        "unique_active_customers",
        X.dround(F.col("_amt").cast(DecimalType(20, 4)) * X.dlit(format(per, "f"), 12, 10), 2)
        .alias("estimated_monthly_revenue"),
    )


def monthly_risk(tx: DataFrame | None, enriched: DataFrame, cal: Calendar = DEFAULT_CALENDAR,
                 cells: DataFrame | None = None) -> DataFrame:
    """A19 + A20 + A21 (J6, J8): transaction-weighted churn, High-risk
    transaction count, revenue at risk / months of the calendar, spend per segment.

    Transactions are first reduced to (customer, month) cells with a row
    count ``n``; the cells (not the transactions) are joined to the
    customer table and every measure is weighted by ``n``:
    avg = sum(p n) / sum(n over known p).  Same numbers as joining each
    transaction, far fewer joined rows.
    """
    cm = cells if cells is not None else customer_months(tx)
    cust = enriched.select("customer_id", "churn_probability", "revenue_at_risk", "risk_level")
    j = cm.join(cust, "customer_id", "left")
    n = F.col("n_rows").cast(DecimalType(20, 0))
    seg_cols = {c: F.sum(c.removeprefix("tx_").replace("amount", "amt")) for c in SEGMENT_AMOUNTS}
    g = j.groupBy("month").agg(
        F.sum(F.col("churn_probability").cast(DecimalType(10, 4)) * n).alias("_pn"),
        F.sum(F.when(F.col("churn_probability").isNotNull(), F.col("n_rows"))).alias("_pcount"),
        F.sum(F.when(F.col("risk_level") == "High", F.col("n_rows")).otherwise(0)).alias("high_risk_active_count"),
        F.sum(F.col("revenue_at_risk").cast(DecimalType(18, 2)) * n).alias("_rar"),
        *[v.alias(k) for k, v in seg_cols.items()],
    )
    return g.select(
        X.month_label("month", cal.start).alias("calendar_ym"),
        X.round_avg(F.col("_pn"), F.col("_pcount"), 4, 4).alias("avg_churn_probability"),
        F.col("_pn").cast("double").alias("_avg_churn_raw"),
        F.col("_pcount"),
        "high_risk_active_count",
        X.round_ratio(X.scaled_int(F.coalesce(F.col("_rar"), F.lit(0).cast(DecimalType(18, 2))), 2),
                      F.lit(cal.n_months * 100), 4).alias("monthly_revenue_at_risk"),
        *[F.coalesce(X.dround(F.col(k), 4), F.lit(0.0)).alias(k) for k in seg_cols],
    )


def revenue_trends(ts: DataFrame) -> list[Column]:
    """W1-W3 on a monthly table: month index, 3-month rolling means of
    revenue (2 dp) and volume (0 dp), month-over-month revenue growth in %
    (2 dp, first month null).  Exact half-even rounding of the ratios."""
    w = Window.orderBy("calendar_ym")
    rev_c = X.scaled_int(F.col("estimated_monthly_revenue"), 2)
    lag1, lag2 = F.lag(rev_c, 1).over(w), F.lag(rev_c, 2).over(w)
    k = F.least(F.row_number().over(w), F.lit(3))
    rsum = rev_c + F.coalesce(lag1, F.lit(0)) + F.coalesce(lag2, F.lit(0))
    vol = F.col("transaction_volume")
    vsum = vol + F.coalesce(F.lag(vol, 1).over(w), F.lit(0)) + F.coalesce(F.lag(vol, 2).over(w), F.lit(0))
    return [
        F.row_number().over(w).cast("bigint").alias("month_index"),
        X.round_ratio(rsum, k * F.lit(100), 2).alias("revenue_3m_rolling_avg"),
        X.round_ratio(vsum, k, 0).alias("tx_volume_3m_rolling_avg"),
        X.round_ratio((rev_c - lag1) * F.lit(100), lag1, 2).alias("revenue_mom_growth_pct"),
    ]


def time_series(tx: DataFrame | None, enriched: DataFrame, cal: Calendar = DEFAULT_CALENDAR,
                params: Params = DEFAULT_PARAMS, cells: DataFrame | None = None) -> DataFrame:
    """B2: monthly series with 3-month rolling means and MoM growth.

    One pass: transactions -> (customer, month) cells -> LEFT JOIN the
    customer table at cell grain -> one aggregation by month carrying the
    transaction measures (A18), the transaction-weighted risk measures
    (A19, A20) and the per-segment amounts (A21).  The windows then run over
    at most ``n_months`` rows, so an unpartitioned window is bounded here.
    """
    cm = cells if cells is not None else customer_months(tx)
    cust = enriched.select("customer_id", "churn_probability", "revenue_at_risk", "risk_level")
    j = cm.join(cust, "customer_id", "left")
    n = F.col("n_rows").cast(DecimalType(20, 0))
    per = (Decimal(str(params.margin_rate)) / Decimal(cal.n_months)).quantize(Decimal("1e-10"))
    segs = {c: F.sum(c.removeprefix("tx_").replace("amount", "amt")) for c in SEGMENT_AMOUNTS}
    g = j.groupBy("month").agg(
        F.sum("n_tx").alias("transaction_volume"), F.sum("amt").alias("_amt"), F.sum("n_amt").alias("_namt"),
        F.count("customer_id").alias("unique_active_customers"),
        F.sum(F.col("churn_probability").cast(DecimalType(10, 4)) * n).alias("_pn"),
        F.sum(F.when(F.col("churn_probability").isNotNull(), F.col("n_rows"))).alias("_pcount"),
        F.sum(F.when(F.col("risk_level") == "High", F.col("n_rows")).otherwise(0)).alias("high_risk_active_count"),
        F.sum(F.col("revenue_at_risk").cast(DecimalType(18, 2)) * n).alias("_rar"),
        *[v.alias(k) for k, v in segs.items()],
    )
    ts = g.select(
        X.month_label("month", cal.start).alias("calendar_ym"), "transaction_volume",
        X.dround(F.col("_amt"), 4).alias("total_transaction_amount"),
        X.round_avg(F.col("_amt"), F.col("_namt"), 4, 4).alias("avg_transaction_amount"),
        "unique_active_customers",
        X.dround(F.col("_amt").cast(DecimalType(20, 4)) * X.dlit(format(per, "f"), 12, 10), 2)
        .alias("estimated_monthly_revenue"),
        X.round_avg(F.col("_pn"), F.col("_pcount"), 4, 4).alias("avg_churn_probability"),
        (F.col("_pn").cast("double") / F.col("_pcount").cast("double")).alias("_raw"),
        "high_risk_active_count",
        X.round_ratio(X.scaled_int(F.coalesce(F.col("_rar"), F.lit(0).cast(DecimalType(18, 2))), 2),
                      F.lit(cal.n_months * 100), 4).alias("monthly_revenue_at_risk"),
        *[F.coalesce(X.dround(F.col(k), 4), F.lit(0.0)).alias(k) for k in segs],
    )
    w = Window.orderBy("calendar_ym")
    raw = F.col("_raw")
    last3 = [F.lag(raw, 2).over(w), F.lag(raw, 1).over(w), raw]  # months without a value are left out
    csum = sum((F.coalesce(c, F.lit(0.0)) for c in last3[1:]), F.coalesce(last3[0], F.lit(0.0)))
    k = sum((c.isNotNull().cast("int") for c in last3[1:]), last3[0].isNotNull().cast("int"))
    out = ts.select(
        *[c for c in ts.columns if not c.startswith("_")],
        F.to_timestamp(F.concat(F.col("calendar_ym"), F.lit("-01"))).alias("calendar_date"),
        *revenue_trends(ts),
        F.bround(F.try_divide(csum, k.cast("double")), 4).alias("churn_prob_3m_rolling_avg"),
    )
    return out.select(*TS_COLUMNS)
