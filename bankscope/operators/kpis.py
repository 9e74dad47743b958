"""Portfolio metrics and executive KPIs.

Each KPI is a small DataFrame (one row, or one row per dimension value)
computed by one distributed aggregation; ``kpi_report`` nests them into a
single-row struct for the JSON report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..config import DEFAULT_PARAMS, Params
from ..functions import exprs as X
from ..functions import stats as S

P8 = DecimalType(12, 8)
def _high() -> Column:
    return F.col("risk_level") == "High"


def _crit() -> Column:
    return (F.col("risk_level") == "High") & (F.col("financial_value") == "High")




def _loss() -> Column:
    return X.dec("predicted_revenue_annual", 2) * F.col("churn_probability").cast(P8)


def portfolio_metrics(rec: DataFrame) -> DataFrame:
    """A13 + C10: one row of portfolio totals."""
    g = rec.agg(
        F.count(F.lit(1)).alias("n_customers"),
        X.count_if(_high()).alias("_hr"),
        F.sum(F.when(_high(), X.dec("predicted_revenue_annual", 2))).alias("_rar"),
        F.sum(_loss()).alias("_loss"),
        F.sum(F.when(_high(), X.dec("clv", 2))).alias("_clvr"),
        X.count_if(_crit()).alias("high_value_at_risk"),
        X.exact_sum("predicted_revenue_annual", 2).alias("_rev"),
        X.exact_sum("clv", 2).alias("_clv"),
    )
    zero = F.lit(0).cast(DecimalType(18, 2))
    return g.select(
        "n_customers",
        X.round_ratio(F.col("_hr"), F.col("n_customers"), 4).alias("churn_rate"),
        X.round_ratio(F.col("_hr") * F.lit(100), F.col("n_customers"), 2).alias("churn_rate_pct"),
        X.dround(F.coalesce(F.col("_rar"), zero), 2).alias("revenue_at_risk"),
        X.dround(F.col("_loss"), 2).alias("total_expected_loss"),
        X.dround(F.coalesce(F.col("_clvr"), zero), 2).alias("clv_at_risk"),
        "high_value_at_risk",
        X.dround(F.col("_rev"), 2).alias("total_revenue"),
        X.dround(F.col("_clv"), 2).alias("total_clv"),
        F.coalesce(X.round_pct(F.coalesce(F.col("_rar"), zero), F.col("_rev"), 2, 2), F.lit(0.0))
        .alias("revenue_at_risk_pct"),
    )


def segment_breakdown(rec: DataFrame) -> DataFrame:
    """Per segment n, mean churn, High count, RAR of High, mean CLV,
    revenue (2 dp) and High share in % (1 dp)."""
    g = rec.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("customer_id").alias("n_customers"),
        X.exact_sum("churn_probability", 4).alias("_p"), F.count("churn_probability").alias("_np"),
        X.count_if(_high()).alias("high_risk_count"),
        F.sum(F.when(_high(), X.dec("predicted_revenue_annual", 2))).alias("_rar"),
        X.exact_sum("clv", 2).alias("_clv"), F.count("clv").alias("_nclv"),
        X.exact_sum("predicted_revenue_annual", 2).alias("_rev"),
    )
    return g.select(
        "segment", "n_customers",
        X.round_avg(F.col("_p"), F.col("_np"), 4, 2).alias("avg_churn_prob"),
        "high_risk_count",
        F.coalesce(X.dround(F.col("_rar"), 2), F.lit(0.0)).alias("revenue_at_risk_seg"),
        X.round_avg(F.col("_clv"), F.col("_nclv"), 2, 2).alias("avg_clv"),
        X.dround(F.col("_rev"), 2).alias("total_revenue_seg"),
        X.round_ratio(F.col("high_risk_count") * F.lit(100), F.col("n_customers"), 1).alias("churn_rate_pct"),
    )


def action_distribution(rec: DataFrame) -> DataFrame:
    """A15 + V23: customers per action (descending) and share in % (1 dp)."""
    g = rec.where(F.col("recommended_action").isNotNull()).groupBy("recommended_action").agg(
        F.count(F.lit(1)).alias("n_customers"))
    total = rec.agg(F.count(F.lit(1))).scalar()
    return g.select("recommended_action", "n_customers",
                    X.round_ratio(F.col("n_customers") * F.lit(100), total, 1).alias("pct_of_customers")
                    ).orderBy(F.desc("n_customers"), "recommended_action")


def _levels(df: DataFrame, dims: list[str], aggs: list[Column]) -> DataFrame:
    """Total plus one level per dimension: GROUPING SETS ((), (d1), (d2) ...)."""
    sets = [[]] + [[F.col(d)] for d in dims]
    g = df.groupingSets(sets, *[F.col(d) for d in dims]).agg(F.grouping_id().alias("_gid"), *aggs)
    level = F.when(F.col("_gid") == (1 << len(dims)) - 1, F.lit("total"))
    key = F.when(F.col("_gid") == (1 << len(dims)) - 1, F.lit("ALL"))
    valid = F.when(F.col("_gid") == (1 << len(dims)) - 1, F.lit(True))
    for i, d in enumerate(dims):
        gid = ((1 << len(dims)) - 1) ^ (1 << (len(dims) - 1 - i))
        level = level.when(F.col("_gid") == gid, F.lit(d))
        key = key.when(F.col("_gid") == gid, F.col(d).cast("string"))
        valid = valid.when(F.col("_gid") == gid, F.col(d).isNotNull())
    return g.where(valid).withColumns({"dimension": level, "key": key}).drop("_gid", *dims)


def kpi_revenue_at_risk(enr: DataFrame) -> DataFrame:
    """RAR total (+ % of revenue) and by segment / region."""
    g = _levels(enr, ["segment", "region"], [X.exact_sum("revenue_at_risk", 2).alias("_rar"),
                                               X.exact_sum("predicted_revenue_annual", 2).alias("_rev")])
    return g.select("dimension", "key", X.dround(F.col("_rar"), 2).alias("revenue_at_risk"),
                    X.format_money(X.dround(F.col("_rar"), 2)).alias("value_formatted"),
                    X.round_pct(F.col("_rar"), F.col("_rev"), 2, 2).alias("pct_of_revenue"))


def kpi_churn_rate(enr: DataFrame) -> DataFrame:
    """High share in % (total 2 dp, segments 1 dp), expected churners
    round(mean p * n) = round(sum p), mean probability (4 dp)."""
    g = _levels(enr, ["segment"], [F.count(F.lit(1)).alias("n_customers"), X.count_if(_high()).alias("_hr"),
                                    X.exact_sum("churn_probability", 4).alias("_p"),
                                    F.count("churn_probability").alias("_np")])
    tot = F.col("dimension") == "total"
    return g.select(
        "dimension", "key", "n_customers",
        F.when(tot, X.round_ratio(F.col("_hr") * F.lit(100), F.col("n_customers"), 2))
         .otherwise(X.round_ratio(F.col("_hr") * F.lit(100), F.col("n_customers"), 1)).alias("churn_rate_pct"),
        X.format_pct(X.round_ratio(F.col("_hr") * F.lit(100), F.col("n_customers"), 1), 1).alias("value_formatted"),
        X.dround(F.col("_p"), 0).cast("bigint").alias("expected_annual_loss_count"),
        X.round_avg(F.col("_p"), F.col("_np"), 4, 4).alias("avg_churn_probability"),
    )


def kpi_clv(enr: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Total / mean / median / p90 / at-risk CLV, by segment mean /
    total / median; discount factor (4 dp)."""
    g = _levels(enr, ["segment"], [X.exact_sum("clv", 2).alias("_clv"), F.count("clv").alias("_n"),
                                    F.sum(F.when(_high(), X.dec("clv", 2))).alias("_risk")])
    # one order-statistic search for the portfolio and every segment: rows are
    # keyed 'ALL' and by segment (a narrow union, no shuffle of its own)
    keyed = enr.select(F.lit("ALL").alias("key"), "clv").unionByName(
        enr.where(F.col("segment").isNotNull()).select(F.col("segment").alias("key"), "clv"))
    q = S.quantiles(keyed, "clv", {"median": 0.5, "p90": 0.9}, ["key"], scale=2)
    tot = F.col("dimension") == "total"
    return g.join(q, "key", "left").select(
        "dimension", "key",
        X.dround(F.col("_clv"), 2).alias("total_clv"),
        X.format_money(X.dround(F.col("_clv"), 2)).alias("total_clv_formatted"),
        X.round_avg(F.col("_clv"), F.col("_n"), 2, 2).alias("avg_clv"),
        X.dround(F.col("median"), 2).alias("median_clv"),
        F.when(tot, X.dround(F.col("p90"), 2)).alias("p90_clv"),
        F.when(tot, X.dround(F.coalesce(F.col("_risk"), F.lit(0).cast(DecimalType(18, 2))), 2)).alias("clv_at_risk"),
        F.when(tot, F.lit(round(params.discount_factor, 4))).alias("discount_factor"),
    )


def kpi_high_value_at_risk(enr: DataFrame) -> DataFrame:
    """The High-risk x High-value cohort; segments only where present."""
    crit = enr.where(_crit())
    g = _levels(crit, ["segment"], [F.count("customer_id").alias("count"),
                                     X.exact_sum("predicted_revenue_annual", 2).alias("_rev"),
                                     X.exact_sum("clv", 2).alias("_clv"),
                                     X.exact_sum("churn_probability", 4).alias("_p"),
                                     F.count("churn_probability").alias("_np")])
    tot = S.scalars(enr.agg(F.count(F.lit(1)).alias("n"), X.exact_sum("predicted_revenue_annual", 2).alias("rev")))
    n_all, rev_all = tot["n"], tot["rev"]
    is_tot = F.col("dimension") == "total"
    return g.select(
        "dimension", "key", "count",
        X.dround(F.coalesce(F.col("_rev"), F.lit(0).cast(DecimalType(18, 2))), 2).alias("revenue_at_stake"),
        X.dround(F.coalesce(F.col("_clv"), F.lit(0).cast(DecimalType(18, 2))), 2).alias("clv_at_stake"),
        X.round_avg(F.col("_p"), F.col("_np"), 4, 4).alias("avg_churn_probability"),
        F.when(is_tot, X.round_ratio(F.col("count") * F.lit(100), n_all, 2)).alias("pct_of_total_customers"),
        F.when(is_tot, X.round_pct(F.coalesce(F.col("_rev"), F.lit(0).cast(DecimalType(18, 2))), rev_all, 2, 2))
         .alias("pct_of_total_revenue"),
    )


def kpi_net_profit(enr: DataFrame) -> DataFrame:
    """Profit totals, overall margin %, five measures per segment."""
    g = _levels(enr, ["segment"], [
        X.exact_sum("net_profit_per_client", 2).alias("_np"), F.count("net_profit_per_client").alias("_nnp"),
        X.exact_sum("estimated_margin_per_client", 2).alias("_m"), X.exact_sum("cost_to_serve", 2).alias("_c"),
        F.count("customer_id").alias("n_customers"), X.exact_sum("predicted_revenue_annual", 2).alias("_rev")])
    return g.select(
        "dimension", "key",
        X.dround(F.col("_np"), 2).alias("total_net_profit"),
        X.format_money(X.dround(F.col("_np"), 2)).alias("total_net_profit_formatted"),
        X.round_avg(F.col("_np"), F.col("_nnp"), 2, 2).alias("avg_net_profit"),
        X.dround(F.col("_m"), 2).alias("total_margin"),
        X.dround(F.col("_c"), 2).alias("total_cost"),
        "n_customers",
        F.when(F.col("dimension") == "total", X.round_pct(F.col("_np"), F.col("_rev"), 2, 2))
         .alias("overall_profit_margin_pct"),
    )


def exact_corr(x: str, y: str, scale: int = 4) -> list[Column]:
    """Pearson correlation parts from exact DECIMAL sums (4-dp inputs)."""
    dx, dy = X.dec(x, scale), X.dec(y, scale)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return [X.count_if(both).alias("_cn"),
            F.sum(F.when(both, dx)).alias("_sx"), F.sum(F.when(both, dy)).alias("_sy"),
            F.sum(F.when(both, dx * dx)).alias("_sxx"), F.sum(F.when(both, dy * dy)).alias("_syy"),
            F.sum(F.when(both, dx * dy)).alias("_sxy")]


def corr_from_parts() -> Column:
    from .txfeatures import exact_centered_ss
    n = F.col("_cn")
    vx = exact_centered_ss(n, F.col("_sx"), F.col("_sxx")).cast("double")
    vy = exact_centered_ss(n, F.col("_sy"), F.col("_syy")).cast("double")
    cxy = (n.cast(DecimalType(10, 0)) * F.col("_sxy").cast(DecimalType(26, 8))
           - F.col("_sx").cast(DecimalType(18, 4)) * F.col("_sy").cast(DecimalType(18, 4))).cast("double")
    return F.when((vx > 0) & (vy > 0), cxy / F.sqrt(vx * vy))


def kpi_engagement(enr: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """A27 + A28: mean engagement, low-engagement count and %, correlation
    with churn probability (total), mean by segment."""
    low = F.col("engagement_index") < params.low_engagement
    g = _levels(enr, ["segment"], [X.exact_sum("engagement_index", 4).alias("_e"),
                                    F.count("engagement_index").alias("_ne"), X.count_if(low).alias("_low"),
                                    F.count(F.lit(1)).alias("_n"),
                                    *exact_corr("engagement_index", "churn_probability")])
    tot = F.col("dimension") == "total"
    return g.select(
        "dimension", "key",
        X.round_avg(F.col("_e"), F.col("_ne"), 4, 4).alias("avg_engagement"),
        F.col("_low").alias("low_engagement_count"),
        X.round_ratio(F.col("_low") * F.lit(100), F.col("_n"), 2).alias("low_engagement_pct"),
        F.when(tot, F.bround(corr_from_parts(), 4)).alias("corr_with_churn_prob"),
    )


def kpi_revenue_concentration(enr: DataFrame) -> DataFrame:
    """A29 (T5): revenue share of the top 10 % / 20 % customers,
    k = max(1, int(n * p)); exact, tie-safe, fully distributed."""
    rev_all = enr.agg(X.exact_sum("predicted_revenue_annual", 2)).scalar()
    t = S.top_k_sums(enr, "predicted_revenue_annual", {"10": 0.10, "20": 0.20})
    j = t.select(F.col("k_10").alias("top_10pct_customer_count"), F.col("top_10").alias("_t10"),
                 F.col("top_20").alias("_t20"))
    return j.select(
        X.round_pct(X.dec("_t10", 2), rev_all, 2, 2).alias("top_10pct_revenue_share"),
        F.bround("_t10", 2).alias("top_10pct_revenue_amount"),
        X.round_pct(X.dec("_t20", 2), rev_all, 2, 2).alias("top_20pct_revenue_share"),
        "top_10pct_customer_count",
    )


def kpi_time_series(ts: DataFrame, last_n: int = 6) -> DataFrame:
    """A30 (+V10): latest month, 6-month OLS slope and direction, peak month,
    means; no row when the series has fewer than two months.

    The series has one row per month, so the windows are over a bounded
    number of rows.
    """
    w_desc = Window.orderBy(F.desc("calendar_ym"))
    t = ts.withColumn("_rd", F.row_number().over(w_desc))
    k_all = ts.agg(F.count(F.lit(1))).scalar()
    tail = t.where(F.col("_rd") <= last_n)
    k = F.least(k_all, F.lit(last_n))
    x = (k - F.col("_rd"))  # 0 .. k-1 in time order
    yc = X.scaled_int(F.col("estimated_monthly_revenue"), 2)
    slope_parts = tail.agg(F.sum((x * 2 - (k - 1)).cast(DecimalType(10, 0)) * yc).alias("_num"))
    num = slope_parts.select("_num").scalar()
    den = k * (k * k - 1) / 6 * 100
    slope = X.round_ratio(num, den.cast("bigint"), 2)
    peak_rev = ts.agg(F.max("estimated_monthly_revenue")).scalar()
    peak_month = ts.where(F.col("estimated_monthly_revenue") == peak_rev).agg(F.min("calendar_ym")).scalar()
    g = ts.agg(
        F.max("calendar_ym").alias("latest_month"),
        F.max_by("estimated_monthly_revenue", "calendar_ym").alias("latest_monthly_revenue"),
        X.exact_sum("estimated_monthly_revenue", 2).alias("_s"), F.count("estimated_monthly_revenue").alias("_n"),
        F.sum("transaction_volume").alias("_v"), F.count("transaction_volume").alias("_nv"),
        F.count(F.lit(1)).alias("_months"),
    )
    out = g.select(
        "latest_month", "latest_monthly_revenue",
        slope.alias("revenue_trend_6m_slope"),
        F.when(slope > 0, F.lit("GROWING")).otherwise(F.lit("DECLINING")).alias("revenue_trend_direction"),
        peak_month.alias("peak_revenue_month"), peak_rev.alias("peak_monthly_revenue"),
        X.round_avg(F.col("_s"), F.col("_n"), 2, 2).alias("avg_monthly_revenue"),
        X.round_ratio(F.col("_v"), F.col("_nv"), 0).alias("avg_monthly_tx_volume"),
        F.col("_months"),
    )
    return out.where(F.col("_months") >= 2).drop("_months")


def kpi_summary(enr: DataFrame) -> DataFrame:
    """A32 summary block: seven portfolio numbers (one row)."""
    g = enr.agg(
        X.exact_sum("predicted_revenue_annual", 2).alias("_rev"), X.exact_sum("revenue_at_risk", 2).alias("_rar"),
        F.count(F.lit(1)).alias("_n"), X.count_if(_high()).alias("_hr"), X.exact_sum("clv", 2).alias("_clv"),
        X.exact_sum("net_profit_per_client", 2).alias("_np"), X.count_if(_crit()).alias("critical_customers"))
    return g.select(
        X.dround(F.col("_rev"), 2).alias("total_revenue"),
        X.dround(F.col("_rar"), 2).alias("total_revenue_at_risk"),
        X.round_pct(F.col("_rar"), F.col("_rev"), 2, 2).alias("rar_pct"),
        X.round_ratio(F.col("_hr") * F.lit(100), F.col("_n"), 2).alias("churn_rate_pct"),
        X.dround(F.col("_clv"), 2).alias("total_clv"),
        X.dround(F.col("_np"), 2).alias("total_net_profit"),
        "critical_customers",
    )


# KPI catalogue: names and codes are the report's keys; the formula texts are
# our own short wording.
KPI_CATALOGUE = [
    ("revenue_at_risk", "Revenue at Risk", "RAR", "sum of annual revenue x churn probability"),
    ("churn_rate", "Churn Rate", "CR", "High-risk customers / all customers x 100"),
    ("customer_lifetime_value", "Customer Lifetime Value", "CLV",
     "revenue x margin x (1 - churn probability) x discounted 5-year annuity"),
    ("high_value_at_risk", "High-Value Customers at Risk", "HVAR", "customers with High risk and High value"),
    ("net_profit_per_segment", "Net Profit per Segment", "NPS_SEG", "sum of (margin - cost to serve) by segment"),
    ("engagement_distribution", "Engagement Score Distribution", "ESD",
     "0.3 active days + 0.3 90-day frequency + 0.2 online share + 0.2 recency"),
    ("revenue_concentration", "Revenue Concentration Index", "RCI", "revenue of the top 10 % customers / all revenue"),
    ("time_series", "Time-Series KPIs", "TS", "latest month, 6-month OLS slope, peak month, means"),
]


def kpi_report(enr: DataFrame, ts: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """One row: metadata, summary and the eight KPI blocks as structs /
    arrays of structs (each block is a small aggregate; nothing is collected)."""
    def block(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.collect_list(F.struct(*df.columns)).alias(name))

    meta = enr.agg(F.count(F.lit(1)).alias("n_customers")).select(F.struct(
        F.current_timestamp().alias("generated_at"), "n_customers", F.lit("USD").alias("currency"),
        F.lit(params.margin_rate).alias("margin_rate"), F.lit(params.discount_rate).alias("clv_discount_rate"),
        F.lit(params.clv_years).alias("clv_horizon_years")).alias("metadata"))
    parts = [meta, kpi_summary(enr).select(F.struct("*").alias("summary")),
             block(kpi_revenue_at_risk(enr), "revenue_at_risk"), block(kpi_churn_rate(enr), "churn_rate"),
             block(kpi_clv(enr, params), "customer_lifetime_value"),
             block(kpi_high_value_at_risk(enr), "high_value_at_risk"),
             block(kpi_net_profit(enr), "net_profit_per_segment"),
             block(kpi_engagement(enr, params), "engagement_distribution"),
             block(kpi_revenue_concentration(enr), "revenue_concentration"),
             block(kpi_time_series(ts), "time_series")]
    cols = {}
    for p in parts:
        cols.update(S.scalars(p))  # every part is one row: one scalar subquery per block
    cols["catalogue"] = F.array(*[F.struct(F.lit(k).alias("kpi"), F.lit(n).alias("name"), F.lit(c).alias("code"),
                                           F.lit(f).alias("formula")) for k, n, c, f in KPI_CATALOGUE])
    return S.one_row(enr.sparkSession, cols)
