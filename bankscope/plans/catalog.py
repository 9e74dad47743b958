"""Registered queries: Spark plan + independent SQL per name.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the fixture tables of
``sf_dir``; ``SQL[name]`` computes the same rows in DuckDB from the raw
tables.  Models have a row of facts with a constant answer beside their
scores; the scores and the nested report are checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_CALENDAR as CAL
from ..config import DEFAULT_PARAMS as PAR
from ..operators import decision as D
from ..operators import enrich as E
from ..operators import kpis as K
from ..operators import marts as M
from ..operators import scoring as SC
from ..operators import txfeatures as TXF
from ..operators import views as V
from ..sources import fixtures as FX
from . import oracle as O
from .pipeline import fixture_stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _tx(spark, d):
    return FX.transactions(spark, d)


def _enr(spark, d):
    return fixture_stages(spark, d).enriched


def _rec(spark, d):
    return fixture_stages(spark, d).recommendations


def _mart(spark, d):
    return M.customer_mart(_enr(spark, d))


def _fa(spark, d):
    return M.financial_aggregates(_enr(spark, d))


def _risk(spark, d):
    """Per-customer risk columns for the monthly series: a projection of the
    recommendations stage (revenue at risk is a row expression), so the
    time-series queries do not need the enriched stage."""
    return E.financial_features(fixture_stages(spark, d).recommendations)


def _ts(spark, d):
    return fixture_stages(spark, d).time_series


# -- sources -------------------------------------------------------------------

register("src_customers", O.q("customers", "SELECT * FROM customers"))(
    lambda s, d: FX.customers(s, d))
register("src_transactions", O.q("txs", "SELECT * FROM txs"))(lambda s, d: FX.transactions_with_segment(s, d))

# -- transaction features -------------------------------------------------------

register("tx_features", O.q("txf", "SELECT * FROM txf"))(lambda s, d: TXF.transaction_features(_tx(s, d)))

_STD = (f"coalesce(CASE WHEN n_amt >= 2 THEN sqrt(greatest({O._var_num('n_amt', 'amt_total', 'amt_sq')} "
        f"/ (CAST(n_amt AS DOUBLE) * CAST(n_amt - 1 AS DOUBLE)), 0.0::DOUBLE)) END, 0.0::DOUBLE)")
_KNOWN = "(CASE WHEN n_online + n_atm + n_branch = 0 THEN 1 ELSE n_online + n_atm + n_branch END)"
register("churn_tx_features", O.q(["tx_cstat", "tx"], f"""
SELECT customer_id, n_tx AS tx_count,
       CASE WHEN n_amt = 0 THEN NULL ELSE CAST(amt_total AS DOUBLE) / CAST(n_amt AS DOUBLE) END AS tx_avg_amount,
       {_STD} AS tx_std_amount, last_ts AS last_tx_date,
       CAST(floor((epoch((SELECT max("timestamp") FROM tx)) - epoch(last_ts)) / 86400) AS BIGINT) AS tx_recency_days,
       CASE WHEN n_chan > 0 THEN CAST(n_online AS DOUBLE) / CAST({_KNOWN} AS DOUBLE) END AS online_ratio,
       CASE WHEN n_chan > 0 THEN CAST(n_atm AS DOUBLE) / CAST({_KNOWN} AS DOUBLE) END AS atm_ratio
FROM tx_cstat"""))(lambda s, d: TXF.churn_tx_features(_tx(s, d)))

register("channel_ratios", O.q("tx_cstat", f"""
SELECT customer_id, n_online AS online_cnt, n_atm AS atm_cnt, n_branch AS branch_cnt,
       CASE WHEN n_chan > 0 THEN CAST(n_online AS DOUBLE) / CAST({_KNOWN} AS DOUBLE) END AS online_ratio,
       CASE WHEN n_chan > 0 THEN CAST(n_atm AS DOUBLE) / CAST({_KNOWN} AS DOUBLE) END AS atm_ratio
FROM tx_cstat"""))(lambda s, d: TXF.channel_ratios(_tx(s, d)))

register("revenue_tx_features", O.q("tx_cstat", f"""
SELECT customer_id, n_tx AS tx_count,
       CASE WHEN n_amt = 0 THEN NULL ELSE CAST(amt_total AS DOUBLE) / CAST(n_amt AS DOUBLE) END AS tx_avg_amount,
       CAST(amt_total AS DOUBLE) AS tx_total_volume,
       coalesce(CASE WHEN n_chan > 0 THEN CAST(n_online AS DOUBLE) / CAST({_KNOWN} AS DOUBLE) END, 0.5::DOUBLE)
         AS online_ratio
FROM tx_cstat"""))(lambda s, d: TXF.revenue_tx_features(_tx(s, d)))

register("tx_window_counts", O.q("txf", """
SELECT customer_id, transaction_count_30d, transaction_count_90d, days_since_last_transaction FROM txf"""))(
    lambda s, d: TXF.tx_window_counts(_tx(s, d)))

register("active_days", O.q("tx_cstat", f"""
SELECT customer_id, n_days AS active_days,
       least(greatest(CAST(n_days AS DOUBLE) / {float(CAL.obs_days)}::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS active_days_ratio
FROM tx_cstat"""))(lambda s, d: TXF.active_days(_tx(s, d)))

register("monthly_spend", O.q("tx", f"""
SELECT customer_id, month, CAST({O.esum('amount', 4)} AS DOUBLE) AS spend
FROM tx WHERE customer_id IS NOT NULL AND month >= 0 AND month < {CAL.n_months} GROUP BY customer_id, month"""))(
    lambda s, d: TXF.monthly_spend(_tx(s, d)))

register("spend_trend_grid", O.with_("tx").rstrip() + f""",
grid AS (SELECT c.customer_id, m.m AS month, coalesce(s.a, 0.0::DOUBLE) AS a
              FROM (SELECT DISTINCT customer_id FROM tx WHERE customer_id IS NOT NULL) c
              CROSS JOIN (SELECT unnest(range({CAL.n_months})) AS m) m
              LEFT JOIN (SELECT customer_id, month, sum(amount) AS a FROM tx GROUP BY customer_id, month) s
                ON s.customer_id = c.customer_id AND s.month = m.m)
SELECT customer_id, round(stddev_samp(a), 3) AS volatility, round(regr_slope(a, month), 3) AS slope,
       CAST({CAL.n_months} - 1 - coalesce(max(month) FILTER (WHERE a > 0), -1) AS INTEGER) AS inactivity_streak
FROM grid GROUP BY customer_id""")(
    lambda s, d: TXF.spend_trend(_tx(s, d)).select("customer_id", F.round("spending_volatility", 3).alias("volatility"),
                                                   F.round("spending_trend_slope", 3).alias("slope"), "inactivity_streak"))

register("spend_trend", O.q("txf", """
SELECT customer_id, spending_volatility, spending_trend_slope, inactivity_streak FROM txf"""))(
    lambda s, d: TXF.spend_trend(_tx(s, d)))

# -- models' feature matrices and the revenue target ----------------------------------


def _churn_matrix(spark, d):
    return fixture_stages(spark, d).churn_matrix


register("churn_matrix", O.q(["customers", "tx_cstat", "tx"], f"""
SELECT c.customer_id, c.age, c.income, c.account_balance, c.tenure_months,
       coalesce(t.n_tx, 0) AS tx_count,
       coalesce(CASE WHEN t.n_amt = 0 THEN NULL ELSE CAST(t.amt_total AS DOUBLE) / CAST(t.n_amt AS DOUBLE) END, 0.0::DOUBLE)
         AS tx_avg_amount,
       coalesce(CASE WHEN t.n_amt >= 2 THEN sqrt(greatest({O._var_num('t.n_amt', 't.amt_total', 't.amt_sq')}
         / (CAST(t.n_amt AS DOUBLE) * CAST(t.n_amt - 1 AS DOUBLE)), 0.0::DOUBLE)) END, 0.0::DOUBLE) AS tx_std_amount,
       coalesce(CAST(floor((epoch((SELECT max("timestamp") FROM tx)) - epoch(t.last_ts)) / 86400) AS BIGINT), 365)
         AS tx_recency_days,
       coalesce(CASE WHEN t.n_chan > 0 THEN CAST(t.n_online AS DOUBLE) / CAST(CASE WHEN t.n_online + t.n_atm + t.n_branch = 0
         THEN 1 ELSE t.n_online + t.n_atm + t.n_branch END AS DOUBLE) END, 0.5::DOUBLE) AS online_ratio,
       coalesce(CASE WHEN t.n_chan > 0 THEN CAST(t.n_atm AS DOUBLE) / CAST(CASE WHEN t.n_online + t.n_atm + t.n_branch = 0
         THEN 1 ELSE t.n_online + t.n_atm + t.n_branch END AS DOUBLE) END, 0.3::DOUBLE) AS atm_ratio,
       CAST(c.segment = 'retail' AS INTEGER) AS segment_retail,
       CAST(c.segment = 'premium' AS INTEGER) AS segment_premium,
       CAST(c.segment = 'high_net_worth' AS INTEGER) AS segment_hnw,
       CAST(c.churn_risk_score > {PAR.churn_label_cut} AS INTEGER) AS churn_label
FROM customers c LEFT JOIN tx_cstat t USING (customer_id)"""))(_churn_matrix)

register("revenue_target", O.q("tx_cstat", f"""
SELECT customer_id, CAST(amt_total AS DOUBLE) AS tx_total_volume,
       CAST(amt_total AS DOUBLE) * {12.0 / CAL.n_months}::DOUBLE AS annual_tx_volume,
       {O.dr(O.d4('amt_total') + " * CAST('" + O.FACTOR + "' AS DECIMAL(10,8))", 2)} AS predicted_revenue_actual
FROM tx_cstat"""))(lambda s, d: SC.revenue_target(_tx(s, d)))

# -- scoring and decisions ------------------------------------------------------------

register("clv", O.q("scoring", "SELECT customer_id, clv, financial_value_score FROM scoring"))(
    lambda s, d: SC.compute_clv(*(lambda p: (p.select("customer_id", "churn_probability"),
                                             p.select("customer_id", "predicted_revenue_annual")))(fixture_stages(s, d).scoring)))


def _scoring_general(spark, d):
    cust = FX.customers(spark, d)
    preds = SC.exact_predictions(cust, _tx(spark, d))
    return SC.scoring_table(cust, preds.select("customer_id", "churn_probability"),
                            preds.select("customer_id", "predicted_revenue_annual"))


register("scoring_general", O.q("scoring", "SELECT * FROM scoring"))(_scoring_general)
register("scoring_table", O.q("scoring", "SELECT * FROM scoring"))(lambda s, d: fixture_stages(s, d).scoring)
register("recommendations", O.q("rec", "SELECT * FROM rec"))(lambda s, d: _rec(s, d))

register("portfolio_metrics", O.q("rec", f"""
SELECT count(*) AS n_customers,
       {O.rr("count(*) FILTER (WHERE risk_level = 'High')", 'count(*)', 4)} AS churn_rate,
       {O.rr("count(*) FILTER (WHERE risk_level = 'High') * 100", 'count(*)', 2)} AS churn_rate_pct,
       {O.dr("coalesce(sum(" + O.d2('predicted_revenue_annual') + ") FILTER (WHERE risk_level = 'High'), 0)", 2)}
         AS revenue_at_risk,
       {O.dr('sum(' + O.d2('predicted_revenue_annual') + ' * ' + O.p8('churn_probability') + ')', 2)} AS total_expected_loss,
       {O.dr("coalesce(sum(" + O.d2('clv') + ") FILTER (WHERE risk_level = 'High'), 0)", 2)} AS clv_at_risk,
       count(*) FILTER (WHERE risk_level = 'High' AND financial_value = 'High') AS high_value_at_risk,
       {O.dr(O.esum('predicted_revenue_annual', 2), 2)} AS total_revenue,
       {O.dr(O.esum('clv', 2), 2)} AS total_clv,
       coalesce({O.rpct("coalesce(sum(" + O.d2('predicted_revenue_annual') + ") FILTER (WHERE risk_level = 'High'), 0)",
                        O.esum('predicted_revenue_annual', 2), 2, 2)}, 0.0::DOUBLE) AS revenue_at_risk_pct
FROM rec"""))(lambda s, d: K.portfolio_metrics(_rec(s, d)))

register("segment_breakdown", O.q("rec", f"""
SELECT segment, count(customer_id) AS n_customers,
       {O.ravg(O.esum('churn_probability', 4), 'count(churn_probability)', 4, 2)} AS avg_churn_prob,
       count(*) FILTER (WHERE risk_level = 'High') AS high_risk_count,
       coalesce({O.dr("sum(" + O.d2('predicted_revenue_annual') + ") FILTER (WHERE risk_level = 'High')", 2)}, 0.0::DOUBLE)
         AS revenue_at_risk_seg,
       {O.ravg(O.esum('clv', 2), 'count(clv)', 2, 2)} AS avg_clv,
       {O.dr(O.esum('predicted_revenue_annual', 2), 2)} AS total_revenue_seg,
       {O.rr("count(*) FILTER (WHERE risk_level = 'High') * 100", 'count(customer_id)', 1)} AS churn_rate_pct
FROM rec WHERE segment IS NOT NULL GROUP BY segment"""))(lambda s, d: K.segment_breakdown(_rec(s, d)))

register("action_distribution", O.q("rec", f"""
SELECT recommended_action, count(*) AS n_customers,
       {O.rr('count(*) * 100', '(SELECT count(*) FROM rec)', 1)} AS pct_of_customers
FROM rec WHERE recommended_action IS NOT NULL GROUP BY recommended_action"""))(
    lambda s, d: K.action_distribution(_rec(s, d)))

# -- enrichment ----------------------------------------------------------------------

register("financial_features", O.q("enr", f"""
SELECT customer_id, {", ".join(E.FINANCIAL_COLUMNS)} FROM enr"""))(
    lambda s, d: _enr(s, d).select("customer_id", *E.FINANCIAL_COLUMNS))
register("engagement", O.q("enr", "SELECT customer_id, engagement_index FROM enr"))(
    lambda s, d: _enr(s, d).select("customer_id", "engagement_index"))
register("risk_adjusted_value", O.q("enr", """
SELECT customer_id, risk_adjusted_value_score, churn_probability_pct FROM enr"""))(
    lambda s, d: _enr(s, d).select("customer_id", "risk_adjusted_value_score", "churn_probability_pct"))
register("value_cluster", O.q("enr", "SELECT customer_id, clv, value_cluster FROM enr"))(
    lambda s, d: _enr(s, d).select("customer_id", "clv", "value_cluster"))
register("risk_tercile", O.q("enr", "SELECT customer_id, churn_probability, risk_cluster FROM enr"))(
    lambda s, d: _enr(s, d).select("customer_id", "churn_probability", "risk_cluster"))

_MM = ["churn_probability", "net_profit_per_client", "engagement_index"]
register("minmax_scaled", O.q("enr", "SELECT customer_id, " + ", ".join(
    f"CASE WHEN (SELECT max(coalesce({c}, 0.0)) FROM enr) > (SELECT min(coalesce({c}, 0.0)) FROM enr) "
    f"THEN (CAST(coalesce({c}, 0.0) AS DOUBLE) - (SELECT min(coalesce({c}, 0.0)) FROM enr)) / "
    f"((SELECT max(coalesce({c}, 0.0)) FROM enr) - (SELECT min(coalesce({c}, 0.0)) FROM enr)) ELSE 0.0 END AS {c}_scaled"
    for c in _MM) + " FROM enr"))(lambda s, d: E.minmax_scaled(_enr(s, d)))

register("enriched", O.q("enr", "SELECT * FROM enr"))(lambda s, d: _enr(s, d))

# -- marts -----------------------------------------------------------------------------

register("customer_mart", O.q("mart", "SELECT * FROM mart"))(_mart)
register("financial_aggregates", O.q("fa", "SELECT * FROM fa"))(_fa)
register("monthly_tx", O.q("mtx", """
SELECT calendar_ym, CAST(transaction_volume AS BIGINT) AS transaction_volume, total_transaction_amount,
       avg_transaction_amount, unique_active_customers, estimated_monthly_revenue FROM mtx"""))(
    lambda s, d: M.monthly_tx(_tx(s, d)))


def _mrisk(spark, d, cols):
    return M.monthly_risk(None, _risk(spark, d), cells=M.cells_of(fixture_stages(spark, d).cells)).select(*cols)


_RISK_COLS = ["calendar_ym", "avg_churn_probability", "high_risk_active_count", "monthly_revenue_at_risk"]
_SEG_COLS = ["calendar_ym", *M.SEGMENT_AMOUNTS]
register("monthly_risk", O.q("mrisk", """
SELECT calendar_ym, avg_churn_probability, CAST(high_risk_active_count AS BIGINT) AS high_risk_active_count,
       monthly_revenue_at_risk FROM mrisk"""))(lambda s, d: _mrisk(s, d, _RISK_COLS))
register("monthly_segment_columns", O.q("mrisk", "SELECT " + ", ".join(_SEG_COLS) + " FROM mrisk"))(
    lambda s, d: _mrisk(s, d, _SEG_COLS))
register("monthly_segment_amount", O.q("txs", f"""
SELECT {O._ym('month')} AS calendar_ym, segment, coalesce({O.dr(O.esum('amount', 4), 4)}, 0.0::DOUBLE) AS amount
FROM txs WHERE month IS NOT NULL GROUP BY month, segment"""))(
    lambda s, d: M.monthly_segment_amount(fixture_stages(s, d).transactions_with_segment))
register("time_series", O.q("ts", """
SELECT * REPLACE (CAST(transaction_volume AS BIGINT) AS transaction_volume,
                  CAST(high_risk_active_count AS BIGINT) AS high_risk_active_count) FROM ts"""))(_ts)
register("cumulative_rar", O.q("ts", """
SELECT calendar_ym, monthly_revenue_at_risk,
       CAST(round_even(sum(CAST(monthly_revenue_at_risk AS DECIMAL(18,4))) OVER (ORDER BY calendar_ym
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS DOUBLE) AS cumulative_revenue_at_risk
FROM ts"""))(lambda s, d: V.cumulative_rar(_ts(s, d)))


def qexact(value: str, p: float, s: int) -> str:
    """Exact linear-interpolated quantile of a fixed-precision column (aggregate expression)."""
    xs = f"list_sort(list({value}))"
    rk = f"(CAST(count({value}) - 1 AS DECIMAL(20,0)) * CAST('{p:.8f}' AS DECIMAL(10,8)))"
    lo = f"CAST({xs}[CAST(floor({rk}) AS BIGINT) + 1] AS DECIMAL(18,{s}))"
    hi = f"CAST({xs}[CAST(ceil({rk}) AS BIGINT) + 1] AS DECIMAL(18,{s}))"
    return f"({lo} + ({hi} - {lo}) * ({rk} - floor({rk})))"


def levels_sql(dims: list[str], measures: str, where: str = "TRUE", src: str = "enr") -> str:
    parts = [f"SELECT 'total' AS dimension, 'ALL' AS \"key\", {measures} FROM {src} WHERE {where}"]
    for dm in dims:
        parts.append(f"SELECT '{dm}' AS dimension, CAST({dm} AS VARCHAR) AS \"key\", {measures} FROM {src} "
                     f"WHERE {where} AND {dm} IS NOT NULL GROUP BY {dm}")
    return "\nUNION ALL\n".join(parts)


# -- KPIs -------------------------------------------------------------------------------

register("kpi_rar", O.q("enr", levels_sql(["segment", "region"], f"""
{O.dr(O.esum('revenue_at_risk', 2), 2)} AS revenue_at_risk,
'$' || format('{{:,.0f}}', round_even({O.dr(O.esum('revenue_at_risk', 2), 2)}, 0)) AS value_formatted,
{O.rpct(O.esum('revenue_at_risk', 2), O.esum('predicted_revenue_annual', 2), 2, 2)} AS pct_of_revenue""")))(
    lambda s, d: K.kpi_revenue_at_risk(_risk(s, d)))

_HR = "count(*) FILTER (WHERE risk_level = 'High')"
register("kpi_churn", O.q("enr", f"""
SELECT dimension, "key", n_customers,
       CASE WHEN dimension = 'total' THEN {O.rr('hr * 100', 'n_customers', 2)} ELSE {O.rr('hr * 100', 'n_customers', 1)} END
         AS churn_rate_pct,
       format('{{:,.1f}}', {O.rr('hr * 100', 'n_customers', 1)}) || '%' AS value_formatted,
       CAST(round_even(p, 0) AS BIGINT) AS expected_annual_loss_count,
       {O.ravg('p', 'np', 4, 4)} AS avg_churn_probability
FROM ({levels_sql(['segment'], f"count(*) AS n_customers, {_HR} AS hr, {O.esum('churn_probability', 4)} AS p, count(churn_probability) AS np")})"""))(
    lambda s, d: K.kpi_churn_rate(_risk(s, d)))

def _clvq() -> str:
    return f"{qexact('clv', 0.5, 2)} AS median, {qexact('clv', 0.9, 2)} AS p90"


register("kpi_clv", O.q("enr", f"""
SELECT l.dimension, l."key", {O.dr('l.s', 2)} AS total_clv,
       '$' || format('{{:,.0f}}', round_even({O.dr('l.s', 2)}, 0)) AS total_clv_formatted,
       {O.ravg('l.s', 'l.n', 2, 2)} AS avg_clv,
       CAST(round_even(q.median, 2) AS DOUBLE) AS median_clv,
       CASE WHEN l.dimension = 'total' THEN CAST(round_even(q.p90, 2) AS DOUBLE) END AS p90_clv,
       CASE WHEN l.dimension = 'total' THEN {O.dr('coalesce(l.r, 0)', 2)} END AS clv_at_risk,
       CASE WHEN l.dimension = 'total' THEN {round(PAR.discount_factor, 4)}::DOUBLE END AS discount_factor
FROM ({levels_sql(['segment'], f"{O.esum('clv', 2)} AS s, count(clv) AS n, sum({O.d2('clv')}) FILTER (WHERE risk_level = 'High') AS r")}) l
LEFT JOIN (SELECT 'ALL' AS "key", {_clvq()} FROM enr
           UNION ALL SELECT segment AS "key", {_clvq()} FROM enr WHERE segment IS NOT NULL GROUP BY segment) q
  ON l."key" = q."key" """))(lambda s, d: K.kpi_clv(_risk(s, d)))

_CRIT = "risk_level = 'High' AND financial_value = 'High'"
register("kpi_hvar", O.q("enr", f"""
SELECT dimension, "key", "count",
       {O.dr('coalesce(rev, 0)', 2)} AS revenue_at_stake, {O.dr('coalesce(clv, 0)', 2)} AS clv_at_stake,
       {O.ravg('p', 'np', 4, 4)} AS avg_churn_probability,
       CASE WHEN dimension = 'total' THEN {O.rr('"count" * 100', '(SELECT count(*) FROM enr)', 2)} END AS pct_of_total_customers,
       CASE WHEN dimension = 'total' THEN {O.rpct('coalesce(rev, 0)', '(SELECT ' + O.esum('predicted_revenue_annual', 2) + ' FROM enr)', 2, 2)} END
         AS pct_of_total_revenue
FROM ({levels_sql(['segment'], f"count(customer_id) AS \"count\", {O.esum('predicted_revenue_annual', 2)} AS rev, {O.esum('clv', 2)} AS clv, {O.esum('churn_probability', 4)} AS p, count(churn_probability) AS np", where=_CRIT)})"""))(
    lambda s, d: K.kpi_high_value_at_risk(_risk(s, d)))

register("kpi_net_profit", O.q("enr", f"""
SELECT dimension, "key", {O.dr('np', 2)} AS total_net_profit,
       '$' || format('{{:,.0f}}', round_even({O.dr('np', 2)}, 0)) AS total_net_profit_formatted,
       {O.ravg('np', 'nnp', 2, 2)} AS avg_net_profit,
       {O.dr('m', 2)} AS total_margin, {O.dr('c', 2)} AS total_cost, n_customers,
       CASE WHEN dimension = 'total' THEN {O.rpct('np', 'rev', 2, 2)} END AS overall_profit_margin_pct
FROM ({levels_sql(['segment'], f"{O.esum('net_profit_per_client', 2)} AS np, count(net_profit_per_client) AS nnp, {O.esum('estimated_margin_per_client', 2)} AS m, {O.esum('cost_to_serve', 2)} AS c, count(customer_id) AS n_customers, {O.esum('predicted_revenue_annual', 2)} AS rev")})"""))(
    lambda s, d: K.kpi_net_profit(_risk(s, d)))

_CORR_PARTS = (f"count(*) FILTER (WHERE engagement_index IS NOT NULL AND churn_probability IS NOT NULL) AS cn, "
               f"sum({O.d4('engagement_index')}) AS sx, sum({O.d4('churn_probability')}) AS sy, "
               f"sum({O.d4('engagement_index')} * {O.d4('engagement_index')}) AS sxx, "
               f"sum({O.d4('churn_probability')} * {O.d4('churn_probability')}) AS syy, "
               f"sum({O.d4('engagement_index')} * {O.d4('churn_probability')}) AS sxy")
_VX = O._var_num("cn", "sx", "sxx")
_VY = O._var_num("cn", "sy", "syy")
_CXY = ("CAST(CAST(cn AS DECIMAL(10,0)) * CAST(sxy AS DECIMAL(26,8)) - CAST(sx AS DECIMAL(18,4)) * "
        "CAST(sy AS DECIMAL(18,4)) AS DOUBLE)")
register("kpi_engagement", O.q("enr", f"""
SELECT dimension, "key", {O.ravg('e', 'ne', 4, 4)} AS avg_engagement,
       low AS low_engagement_count,
       {O.rr('low * 100', 'n', 2)} AS low_engagement_pct,
       CASE WHEN dimension = 'total' AND {_VX} > 0 AND {_VY} > 0 THEN round_even({_CXY} / sqrt({_VX} * {_VY}), 4) END
         AS corr_with_churn_prob
FROM ({levels_sql(['segment'], f"{O.esum('engagement_index', 4)} AS e, count(engagement_index) AS ne, count(*) FILTER (WHERE engagement_index < {PAR.low_engagement}) AS low, count(*) AS n, {_CORR_PARTS}")})"""))(
    lambda s, d: K.kpi_engagement(_enr(s, d)))


def _topk_sql(frac: float) -> str:
    return (f"(SELECT sum(v) FROM (SELECT {O.d2('predicted_revenue_annual')} AS v FROM enr "
            f"ORDER BY predicted_revenue_annual DESC LIMIT greatest(1, CAST(floor((SELECT count(*) FROM enr) * {frac}) AS BIGINT))))")


register("kpi_concentration", O.q("enr", f"""
SELECT {O.rpct(_topk_sql(0.1), '(SELECT ' + O.esum('predicted_revenue_annual', 2) + ' FROM enr)', 2, 2)} AS top_10pct_revenue_share,
       {O.dr(_topk_sql(0.1), 2)} AS top_10pct_revenue_amount,
       {O.rpct(_topk_sql(0.2), '(SELECT ' + O.esum('predicted_revenue_annual', 2) + ' FROM enr)', 2, 2)} AS top_20pct_revenue_share,
       greatest(1, CAST(floor((SELECT count(*) FROM enr) * 0.1) AS BIGINT)) AS top_10pct_customer_count"""))(
    lambda s, d: K.kpi_revenue_concentration(_risk(s, d)))

register("kpi_time_series", O.q("ts", f"""
SELECT (SELECT max(calendar_ym) FROM ts) AS latest_month,
       (SELECT estimated_monthly_revenue FROM ts ORDER BY calendar_ym DESC LIMIT 1) AS latest_monthly_revenue,
       slope AS revenue_trend_6m_slope,
       CASE WHEN slope > 0 THEN 'GROWING' ELSE 'DECLINING' END AS revenue_trend_direction,
       (SELECT min(calendar_ym) FROM ts WHERE estimated_monthly_revenue = (SELECT max(estimated_monthly_revenue) FROM ts))
         AS peak_revenue_month,
       (SELECT max(estimated_monthly_revenue) FROM ts) AS peak_monthly_revenue,
       (SELECT {O.ravg(O.esum('estimated_monthly_revenue', 2), 'count(estimated_monthly_revenue)', 2, 2)} FROM ts)
         AS avg_monthly_revenue,
       (SELECT {O.rr('sum(transaction_volume)', 'count(transaction_volume)', 0)} FROM ts) AS avg_monthly_tx_volume
FROM (SELECT {O.rr('sum((2 * x - (k - 1)) * yc)', 'max(k) * (max(k) * max(k) - 1) // 6 * 100', 2)} AS slope
      FROM (SELECT k - rd AS x, k, {O.si('estimated_monthly_revenue', 2)} AS yc
            FROM (SELECT *, row_number() OVER (ORDER BY calendar_ym DESC) AS rd,
                         least(6, count(*) OVER ()) AS k FROM ts) WHERE rd <= 6))
WHERE (SELECT count(*) FROM ts) >= 2"""))(lambda s, d: K.kpi_time_series(_ts(s, d)))

# -- filters, top-k, views ----------------------------------------------------------------

_F3 = dict(segments=["retail", "premium"], risks=["High", "Medium"], income_range=(40000.0, 200000.0),
           actions=[a for a in C.ACTIONS if a != C.NO_ACTION], regions=["AMERICA", "ASIA", "EUROPE"])
_F3_COLS = ["customer_id", "segment", "risk_level", "income", "recommended_action", "region"]
register("filter_portfolio", O.q("enr", f"""
SELECT {", ".join(_F3_COLS)} FROM enr
WHERE segment IN ('retail', 'premium') AND risk_level IN ('High', 'Medium') AND income BETWEEN 40000.0 AND 200000.0
  AND recommended_action IN ({", ".join(O._q(a) for a in _F3['actions'])}) AND region IN ('AMERICA', 'ASIA', 'EUROPE')"""))(
    lambda s, d: V.filter_portfolio(_enr(s, d), **_F3).select(*_F3_COLS))

_F6 = {"value_tier": ["Elite", "Premium"], "churn_probability_pct": (20.0, 90.0), "clv_5yr__min": 100.0,
       "action_code": ["RETAIN_PREMIUM", "RETAIN_STANDARD", "MONITOR", "CROSS_SELL"]}
_F6_COLS = ["customer_id", "value_tier", "churn_probability_pct", "clv_5yr", "action_code"]
register("dashboard_filters", O.q("mart", f"""
SELECT {", ".join(_F6_COLS)} FROM mart
WHERE value_tier IN ('Elite', 'Premium') AND churn_probability_pct >= 20.0 AND churn_probability_pct <= 90.0
  AND clv_5yr >= 100.0 AND action_code IN ('RETAIN_PREMIUM', 'RETAIN_STANDARD', 'MONITOR', 'CROSS_SELL')"""))(
    lambda s, d: V.dashboard_filters(_mart(s, d), _F6).select(*_F6_COLS))

_PROFILE = ["customer_id", "segment", "age", "income", "account_balance", "tenure_months", "region",
            "churn_probability", "predicted_revenue_annual", "clv", "net_profit_per_client", "revenue_at_risk",
            "engagement_index", "risk_level", "financial_value", "recommended_action", "priority_score",
            "inactivity_streak", "days_since_last_transaction", "action_rationale"]
register("search_customer", O.q("enr", f"""
SELECT {", ".join(_PROFILE)} FROM enr WHERE customer_id ILIKE '%12%' ORDER BY customer_id LIMIT 1"""))(
    lambda s, d: V.search_customer(_enr(s, d), "12").select(*_PROFILE))

_BROWSE = [c for c in V.BROWSE_COLUMNS if c != "value_tier"]
register("browse_top_n", O.q("enr", f"""
SELECT {", ".join(_BROWSE)} FROM enr WHERE risk_level = 'High'
ORDER BY revenue_at_risk DESC NULLS LAST, customer_id LIMIT 50"""))(
    lambda s, d: V.browse(_enr(s, d), risk="High", sort_col="revenue_at_risk", n=50).select(*_BROWSE))

_PL = ["customer_id", "segment", "churn_probability", "predicted_revenue_annual", "clv", "revenue_at_risk",
       "risk_level", "financial_value", "recommended_action", "priority_score", "engagement_index",
       "days_since_last_transaction"]
register("priority_list", O.q("enr", f"""
SELECT {", ".join(_PL)} FROM enr WHERE risk_level = 'High' ORDER BY priority_score DESC NULLS LAST, customer_id LIMIT 25"""))(
    lambda s, d: V.priority_list(_enr(s, d)).select(*_PL))

_T3 = ["customer_id", "revenue_at_risk", "value_tier", "segment_label", "churn_probability_pct", "clv_5yr",
       "net_profit_per_client", "recommended_action", "priority_score"]
register("top50_rar", O.q("mart", f"""
SELECT {", ".join(_T3)} FROM mart ORDER BY revenue_at_risk DESC NULLS LAST, customer_id LIMIT 50"""))(
    lambda s, d: V.top_rar(_mart(s, d)))

register("action_queue", O.q("mart", """
SELECT customer_id, segment_label, age_band, region, churn_probability_pct, clv_5yr, revenue_at_risk, engagement_index,
       recommended_action, action_urgency, priority_score FROM mart WHERE action_urgency IN ('CRITICAL', 'HIGH')"""))(
    lambda s, d: V.action_queue(_mart(s, d)))

register("view_v01_risk_distribution", O.q("enr", f"""
SELECT risk_level, count(*) AS "count", {O.rr('count(*) * 100', '(SELECT count(*) FROM enr)', 2)} AS pct
FROM enr GROUP BY risk_level"""))(lambda s, d: V.risk_distribution(_risk(s, d)))

register("view_v02_rar_by_segment_high", O.q("enr", f"""
SELECT segment, {O.dr(O.esum('revenue_at_risk', 2), 2)} AS revenue_at_risk FROM enr
WHERE risk_level = 'High' AND segment IS NOT NULL GROUP BY segment"""))(lambda s, d: V.rar_by_segment_high(_risk(s, d)))


def _box_sql(value: str, by: list[str], src: str, dp: int, where: str = "TRUE", grid: int | None = 4) -> str:
    g = ", ".join(by)
    if grid is None:
        q = {k: f"round_even(quantile_cont({value}, {p}), {dp})" for k, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    else:
        q = {k: f"CAST(round_even({qexact(value, p, grid)}, {dp}) AS DOUBLE)"
             for k, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    return (f"SELECT {g}, count({value}) AS n, round_even(CAST(min({value}) AS DOUBLE), {dp}) AS \"min\", "
            f"{q['q1']} AS q1, {q['median']} AS median, {q['q3']} AS q3, "
            f"round_even(CAST(max({value}) AS DOUBLE), {dp}) AS \"max\" "
            f"FROM (SELECT * FROM {src} WHERE {value} IS NOT NULL AND {where}) GROUP BY {g}")


register("view_v03_churn_box_by_segment", O.q("enr", _box_sql("churn_probability", ["segment"], "enr", 4)))(
    lambda s, d: V.box_stats(_risk(s, d), "churn_probability", ["segment"], grid=4))
register("view_v04_engagement_box", O.q("enr", _box_sql("engagement_index", ["segment", "risk_level"], "enr", 4)))(
    lambda s, d: V.box_stats(_enr(s, d), "engagement_index", ["segment", "risk_level"], grid=4))


def _hist_sql(value: str, bins: int, by: list[str], src: str, dp: int = 6) -> str:
    g = ", ".join(by)
    b = (f"CAST(CASE WHEN r.hi - r.lo = 0 THEN 0 ELSE least(floor((CAST(x.{value} AS DOUBLE) - r.lo) / (r.hi - r.lo) "
         f"* {float(bins)}::DOUBLE), {bins - 1}) END AS INTEGER)")
    return (f"SELECT {g}, bin, round_even(lo + bin * ((hi - lo) / {float(bins)}::DOUBLE), {dp}) AS bin_start, "
            f"round_even(lo + (bin + 1) * ((hi - lo) / {float(bins)}::DOUBLE), {dp}) AS bin_end, \"count\" FROM "
            f"(SELECT {', '.join('x.' + c for c in by)}, {b} AS bin, count(*) AS \"count\", min(r.lo) AS lo, min(r.hi) AS hi "
            f"FROM {src} x CROSS JOIN (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {src}) r "
            f"WHERE x.{value} IS NOT NULL GROUP BY ALL)")


register("view_v07_rar_histogram", O.q("enr", _hist_sql("revenue_at_risk", 60, ["segment"], "enr")))(
    lambda s, d: V.histogram_by(_enr(s, d), "revenue_at_risk", 60))
register("view_v08_net_profit_box", O.q("enr", _box_sql("net_profit_per_client", ["segment"], "enr", 2, grid=2)))(
    lambda s, d: V.box_stats(_enr(s, d), "net_profit_per_client", ["segment"], grid=2, dp=2))

register("view_v09_segment_summary", O.q("enr", f"""
SELECT segment, count(customer_id) AS customers, {O.ravg(O.esum('churn_probability', 4), 'count(churn_probability)', 4, 4)} AS avg_churn,
       {_HR} AS high_risk, {O.dr(O.esum('predicted_revenue_annual', 2), 2)} AS total_revenue,
       {O.ravg(O.esum('clv', 2), 'count(clv)', 2, 2)} AS avg_clv, {O.dr(O.esum('clv', 2), 2)} AS total_clv,
       {O.dr(O.esum('revenue_at_risk', 2), 2)} AS revenue_at_risk, {O.dr(O.esum('net_profit_per_client', 2), 2)} AS net_profit,
       {O.rr(_HR + ' * 100', 'count(customer_id)', 1)} AS churn_rate_pct,
       {O.rpct(O.esum('revenue_at_risk', 2), O.esum('predicted_revenue_annual', 2), 2, 1)} AS rar_pct
FROM enr WHERE segment IS NOT NULL GROUP BY segment"""))(lambda s, d: V.segment_summary(_risk(s, d)))

register("view_v11_streak_analysis", O.q("enr", f"""
SELECT inactivity_streak, count(customer_id) AS n_customers,
       {O.ravg(O.esum('churn_probability', 4), 'count(churn_probability)', 4, 4)} AS avg_churn
FROM enr GROUP BY inactivity_streak HAVING inactivity_streak <= 12"""))(lambda s, d: V.streak_analysis(_enr(s, d)))

register("view_v12_slope_by_cluster", O.q("enr", _box_sql("spending_trend_slope", ["risk_cluster"], "enr", 4, grid=None)))(
    lambda s, d: V.box_stats(_enr(s, d), "spending_trend_slope", ["risk_cluster"], grid=None))
register("view_v13_rav_histogram", O.q("enr", _hist_sql("risk_adjusted_value_score", 50, ["segment"], "enr")))(
    lambda s, d: V.histogram_by(_enr(s, d), "risk_adjusted_value_score", 50))
register("view_v14_value_cluster_segment", O.q("enr", """
SELECT value_cluster, segment, count(customer_id) AS "count" FROM enr
WHERE value_cluster IS NOT NULL AND segment IS NOT NULL GROUP BY ALL"""))(
    lambda s, d: V.counts_by(_enr(s, d), ["value_cluster", "segment"]))
register("view_v15_action_segment", O.q("enr", """
SELECT segment, recommended_action, count(customer_id) AS "count" FROM enr
WHERE segment IS NOT NULL AND recommended_action IS NOT NULL GROUP BY ALL"""))(
    lambda s, d: V.counts_by(_risk(s, d), ["segment", "recommended_action"]))
register("view_v16_priority_heatmap", O.q("enr", f"""
SELECT g.risk_level, g.financial_value, {O.ravg('e.s', 'e.n', 4, 4)} AS avg_priority
FROM (SELECT * FROM (VALUES ('High'), ('Medium'), ('Low')) a(risk_level),
                    (VALUES ('High'), ('Medium'), ('Low')) b(financial_value)) g
LEFT JOIN (SELECT risk_level, financial_value, {O.esum('priority_score', 4)} AS s, count(priority_score) AS n
           FROM enr GROUP BY ALL) e USING (risk_level, financial_value)"""))(
    lambda s, d: V.priority_heatmap(_risk(s, d)))
register("view_v17_churn_histogram", O.q("enr", _hist_sql("churn_probability", 50, ["segment"], "enr")))(
    lambda s, d: V.histogram_by(_enr(s, d), "churn_probability", 50))

register("view_v20_executive_cards", O.q("enr", f"""
SELECT {O.dr(O.esum('predicted_revenue_annual', 2), 2)} AS total_revenue, {O.dr(O.esum('revenue_at_risk', 2), 2)} AS revenue_at_risk,
       coalesce({O.rpct(O.esum('revenue_at_risk', 2), O.esum('predicted_revenue_annual', 2), 2, 1)}, 0.0::DOUBLE) AS rar_pct,
       {O.rr(_HR + ' * 100', 'count(*)', 1)} AS churn_rate_pct, {O.dr(O.esum('clv', 2), 2)} AS total_clv,
       count(*) FILTER (WHERE {_CRIT}) AS critical_accounts, {O.dr(O.esum('net_profit_per_client', 2), 2)} AS net_profit
FROM enr WHERE segment IN ('retail', 'premium') AND risk_level IN ('High', 'Medium')
  AND income BETWEEN 40000.0 AND 200000.0 AND recommended_action IN ({", ".join(O._q(a) for a in _F3['actions'])})
  AND region IN ('AMERICA', 'ASIA', 'EUROPE')"""))(
    lambda s, d: V.executive_cards(V.filter_portfolio(_risk(s, d), **_F3)))

_RATES, _COSTS = (25.0, 50.0, 75.0), (250.0, 500.0, 1000.0)
register("roi_scenarios", O.q("enr", f"""
SELECT success_rate_pct, cost_per_customer, revenue_saved, programme_cost,
       round_even(revenue_saved - programme_cost, 2) AS net_roi,
       CASE WHEN programme_cost > 0 THEN round_even(revenue_saved / programme_cost, 4) ELSE 0.0 END AS roi_ratio
FROM (SELECT g.success_rate_pct, g.cost_per_customer,
             CAST(round_even(t.rar * CAST(g.success_rate_pct / 100 AS DECIMAL(12,6)), 2) AS DOUBLE) AS revenue_saved,
             CAST(round_even(CAST(t.hr AS DECIMAL(20,0)) * CAST(g.cost_per_customer AS DECIMAL(14,2)), 2) AS DOUBLE) AS programme_cost
      FROM (SELECT * FROM (VALUES {", ".join(f"({r}::DOUBLE)" for r in _RATES)}) a(success_rate_pct),
                          (VALUES {", ".join(f"({c}::DOUBLE)" for c in _COSTS)}) b(cost_per_customer)) g
      CROSS JOIN (SELECT {O.esum('revenue_at_risk', 2)} AS rar, {_HR} AS hr FROM enr) t)"""))(
    lambda s, d: V.roi_scenarios(_risk(s, d), _RATES, _COSTS))

register("view_v25_churn_histogram_5pt", O.q("mart", """
SELECT segment, CAST(floor(churn_probability_pct / 5.0) * 5 AS INTEGER) AS bin_start_pct, count(customer_id) AS "count"
FROM mart GROUP BY ALL"""))(lambda s, d: V.churn_histogram_5pt(_mart(s, d)))

_BUCKET = ("CASE WHEN inactivity_streak = 0 THEN '0' WHEN inactivity_streak <= 3 THEN '1-3' WHEN inactivity_streak <= 6 "
           "THEN '4-6' WHEN inactivity_streak <= 12 THEN '7-12' ELSE '12+' END")
register("view_v26_churn_by_streak_bucket", O.q("mart", _box_sql(
    "churn_probability_pct", ["streak_bucket", "segment"], f"(SELECT *, {_BUCKET} AS streak_bucket FROM mart)", 2,
    grid=1)))(
    lambda s, d: V.churn_by_streak_bucket(_mart(s, d)))
register("view_v27_quadrant", O.q("mart", """
SELECT CASE WHEN churn_probability_pct >= 65 AND clv_5yr >= q.c75 THEN 'CRITICAL'
            WHEN churn_probability_pct < 65 AND clv_5yr >= q.c75 THEN 'NURTURE'
            WHEN churn_probability_pct >= 65 AND clv_5yr < q.c75 THEN 'MONITOR' ELSE 'STABLE' END AS quadrant,
       count(customer_id) AS "count"
FROM mart CROSS JOIN (SELECT quantile_cont(clv_5yr, 0.75) AS c75 FROM mart) q GROUP BY 1"""))(
    lambda s, d: V.risk_value_quadrant(_mart(s, d)))
register("view_v28_loss_waterfall", O.q("fa", """
SELECT segment, total_revenue, total_revenue_at_risk, round_even(total_revenue - total_revenue_at_risk, 2) AS protected_revenue
FROM fa WHERE aggregation_level = 'by_segment'"""))(lambda s, d: V.loss_waterfall(_fa(s, d)))
register("view_v29_rar_segment_risk", O.q("fa", """
SELECT segment, risk_level, total_revenue_at_risk FROM fa WHERE aggregation_level = 'by_segment_risk'"""))(
    lambda s, d: V.rar_by_segment_risk(_fa(s, d)))
register("view_v30_region_risk_map", O.q("fa", """
SELECT region, avg_churn_probability, n_customers FROM fa WHERE aggregation_level = 'by_region'"""))(
    lambda s, d: V.region_risk_map(_fa(s, d)))
register("view_v06_profitability_heatmap", O.q("fa", """
SELECT g.segment, g.region, round_even(coalesce(f.profitability_ratio, 0.0), 1) AS profitability_ratio
FROM (SELECT * FROM (SELECT DISTINCT segment FROM fa WHERE aggregation_level = 'by_segment_region'),
                    (SELECT DISTINCT region FROM fa WHERE aggregation_level = 'by_segment_region')) g
LEFT JOIN (SELECT segment, region, profitability_ratio FROM fa WHERE aggregation_level = 'by_segment_region') f
  USING (segment, region)"""))(lambda s, d: V.profitability_heatmap(_fa(s, d)))
register("view_v39_profitability_table", O.q("fa", """
SELECT segment, region, total_net_profit, profitability_ratio FROM fa WHERE aggregation_level = 'by_segment_region'"""))(
    lambda s, d: V.profitability_table(_fa(s, d)))
register("view_v31_priority_by_action", O.q("enr", _box_sql("priority_score", ["recommended_action"], "enr", 4)))(
    lambda s, d: V.box_stats(_enr(s, d), "priority_score", ["recommended_action"], grid=4))
register("view_v37_churn_bullet", O.q("fa", """
SELECT segment, total_revenue, churn_rate_pct, round_even(churn_rate_pct - 12.0, 2) AS gap_to_target_pct
FROM fa WHERE aggregation_level = 'by_segment'"""))(lambda s, d: V.churn_bullet(_fa(s, d)))
register("view_v38_action_donut", O.q("mart", """
SELECT recommended_action, action_urgency, count(customer_id) AS "count" FROM mart GROUP BY ALL"""))(
    lambda s, d: V.action_donut(_mart(s, d)))
register("view_v33_margin_by_segment_month", O.q(["ts", "fa"], """
SELECT t.calendar_ym, t.calendar_date, f.segment, f.profitability_ratio
FROM ts t CROSS JOIN (SELECT segment, profitability_ratio FROM fa WHERE aggregation_level = 'by_segment') f"""))(
    lambda s, d: V.margin_by_segment_month(_ts(s, d), _fa(s, d)))
register("view_v35_revenue_series", O.q("ts", """
SELECT calendar_ym, estimated_monthly_revenue, revenue_3m_rolling_avg, monthly_revenue_at_risk, revenue_mom_growth_pct,
       CAST(transaction_volume AS BIGINT) AS transaction_volume, tx_volume_3m_rolling_avg, avg_churn_probability,
       churn_prob_3m_rolling_avg FROM ts"""))(
    lambda s, d: _ts(s, d).select("calendar_ym", "estimated_monthly_revenue", "revenue_3m_rolling_avg",
                                  "monthly_revenue_at_risk", "revenue_mom_growth_pct", "transaction_volume",
                                  "tx_volume_3m_rolling_avg", "avg_churn_probability", "churn_prob_3m_rolling_avg"))
register("view_v35_mom_growth", O.q("ts", """
SELECT calendar_ym, revenue_mom_growth_pct FROM ts WHERE revenue_mom_growth_pct IS NOT NULL"""))(
    lambda s, d: _ts(s, d).dropna(subset=["revenue_mom_growth_pct"]).select("calendar_ym", "revenue_mom_growth_pct"))
register("kpi_cards", O.q("fa", """
SELECT label, "value",
       CASE WHEN label = 'Portfolio Churn Rate'
            THEN format('{:,.1f}', CAST(round_even(CAST("value" AS DECIMAL(18,2)), 1) AS DOUBLE)) || '%'
            WHEN label = 'Critical Accounts' THEN format('{:,.0f}', "value")
            ELSE '$' || format('{:,.0f}', round_even("value", 0)) END AS value_formatted,
       color,
       CASE WHEN label = 'Revenue at Risk'
            THEN '(' || format('{:,.1f}', CAST(round_even(CAST(rar_pct AS DECIMAL(18,2)), 1) AS DOUBLE)) || '% of total revenue)'
            WHEN label = 'Critical Accounts' THEN 'High-value + High-risk' END AS sub_label
FROM (SELECT 'Total Annual Revenue' AS label, total_revenue AS "value", 'blue' AS color FROM fa WHERE aggregation_level = 'total'
      UNION ALL SELECT 'Revenue at Risk', total_revenue_at_risk,
        CASE WHEN revenue_at_risk_pct > 5 THEN 'red' WHEN revenue_at_risk_pct >= 3 THEN 'amber' ELSE 'green' END
        FROM fa WHERE aggregation_level = 'total'
      UNION ALL SELECT 'Portfolio Churn Rate', churn_rate_pct,
        CASE WHEN churn_rate_pct > 25 THEN 'red' WHEN churn_rate_pct >= 15 THEN 'amber' ELSE 'green' END
        FROM fa WHERE aggregation_level = 'total'
      UNION ALL SELECT '5-Year Customer CLV', total_clv, 'green' FROM fa WHERE aggregation_level = 'total'
      UNION ALL SELECT 'Net Portfolio Profit', total_net_profit, CASE WHEN total_net_profit < 0 THEN 'red' ELSE 'green' END
        FROM fa WHERE aggregation_level = 'total'
      UNION ALL SELECT 'Critical Accounts', CAST(critical_count AS DOUBLE), 'red' FROM fa WHERE aggregation_level = 'total')
CROSS JOIN (SELECT revenue_at_risk_pct AS rar_pct FROM fa WHERE aggregation_level = 'total')"""))(
    lambda s, d: V.kpi_cards(_fa(s, d)))
register("view_v41_engagement_cards", O.q("enr", f"""
SELECT {O.ravg(O.esum('engagement_index', 4), 'count(engagement_index)', 4, 4)} AS avg_engagement,
       count(*) FILTER (WHERE engagement_index < {PAR.low_engagement}) AS low_engagement_count,
       {O.rr(f'count(*) FILTER (WHERE engagement_index < {PAR.low_engagement}) * 100', 'count(*)', 2)} AS low_engagement_pct,
       (SELECT CASE WHEN {_VX} > 0 AND {_VY} > 0 THEN round_even({_CXY} / sqrt({_VX} * {_VY}), 4) END
        FROM (SELECT {_CORR_PARTS} FROM enr)) AS corr_with_churn_prob
FROM enr"""))(lambda s, d: V.low_engagement_cards(_enr(s, d)))

# -- samples (the size is the feature), models, reports, jobs ---------------------------------


def _sampled(name: str, source: str, make, n: int, seed: int, cols: list[str]) -> None:
    register(name, O.q(source, f"SELECT {', '.join(cols)} FROM {source} ORDER BY md5(customer_id || ':{seed}'), customer_id LIMIT {n}"))(
        lambda s, d: V.samples(make(s, d), n, seed, cols))


_POINTS = ["customer_id", "churn_probability_pct", "clv_5yr", "risk_level", "segment", "revenue_at_risk"]
_sampled("stable_sample", "mart", _mart, 8000, PAR.seed, [*_POINTS, "recommended_action", "priority_score"])
_sampled("stable_sample_700", "mart", _mart, 700, PAR.seed, _POINTS)  # fewer than the rows of the smallest tables but one
_sampled("view_v18_clv_churn_points", "enr", _enr, 5000, PAR.seed, ["customer_id", "churn_probability", "clv", "segment"])
_sampled("view_v19_engagement_churn_points", "enr", _enr, 6000, 1, ["customer_id", "engagement_index", "churn_probability", "segment"])
_V32 = ["customer_id", "engagement_index", "priority_score", "recommended_action", "revenue_at_risk"]
register("view_v32_engagement_priority_points", O.q("mart", f"SELECT {', '.join(_V32)} FROM mart"))(
    lambda s, d: _mart(s, d).select(*_V32))
register("kpi_report")(lambda s, d: K.kpi_report(_enr(s, d), _ts(s, d)))

# The report's figures as rows: each block's number columns by name.
_BLOCKS = {
    "kpi_rar": ["revenue_at_risk", "pct_of_revenue"],
    "kpi_churn": ["n_customers", "churn_rate_pct", "expected_annual_loss_count", "avg_churn_probability"],
    "kpi_clv": ["total_clv", "avg_clv", "median_clv", "p90_clv", "clv_at_risk", "discount_factor"],
    "kpi_hvar": ["count", "revenue_at_stake", "clv_at_stake", "avg_churn_probability", "pct_of_total_customers", "pct_of_total_revenue"],
    "kpi_net_profit": ["total_net_profit", "avg_net_profit", "total_margin", "total_cost", "n_customers", "overall_profit_margin_pct"],
    "kpi_engagement": ["avg_engagement", "low_engagement_count", "low_engagement_pct", "corr_with_churn_prob"],
    "kpi_concentration": ["top_10pct_revenue_share", "top_10pct_revenue_amount", "top_20pct_revenue_share", "top_10pct_customer_count"],
    "kpi_time_series": ["latest_monthly_revenue", "revenue_trend_6m_slope", "peak_monthly_revenue", "avg_monthly_revenue", "avg_monthly_tx_volume"],
}


#: The report's keys of these blocks.
_SECTIONS = dict(zip(_BLOCKS, (k for k, *_ in K.KPI_CATALOGUE), strict=True))
_SUMMARY = ["total_revenue", "total_revenue_at_risk", "rar_pct", "churn_rate_pct", "total_clv", "total_net_profit", "critical_customers"]
_METADATA = ["n_customers", "margin_rate", "clv_discount_rate", "clv_horizon_years"]


def _report_rows(spark, d):
    """A32 as (section, dimension, key, measure, value): the written report,
    read back and flattened, metadata and summary included."""
    from functools import reduce
    from ..sources import readers, sinks
    report = K.kpi_report(_enr(spark, d), _ts(spark, d))
    written = sinks.write_report(report, _scratch(spark, "kpi-report-rows") + ".json")
    # the schema is the report's own: a figure that is null in every row is not in the JSON
    r = readers.read_report(spark, written, report.schema)
    blank = [F.lit("").alias(c) for c in ("dimension", "key")]

    def measures(names, of):
        return F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), of(m).cast("double").alias("value")) for m in names]))

    out = [r.select(F.lit(part).alias("section"), *blank, measures(names, lambda m, p=part: F.col(f"{p}.{m}")))
           for part, names in (("metadata", _METADATA), ("summary", _SUMMARY))]
    for name, names in _BLOCKS.items():
        rows = r.select(F.inline(_SECTIONS[name]))
        at = [F.col(c) if c in rows.columns else F.lit("").alias(c) for c in ("dimension", "key")]
        out.append(rows.select(F.lit(name).alias("section"), *at, measures(names, F.col)))
    return reduce(DataFrame.unionByName, out)


def _report_rows_sql() -> str:
    fixed = {"margin_rate": PAR.margin_rate, "clv_discount_rate": PAR.discount_rate, "clv_horizon_years": PAR.clv_years}
    out = ["SELECT 'metadata' AS section, '' AS dimension, '' AS \"key\", 'n_customers' AS measure, CAST(count(*) AS DOUBLE) AS value FROM customer"]
    out += [f"SELECT 'metadata', '', '', '{m}', {float(v)!r}::DOUBLE" for m, v in fixed.items()]
    out += [f"SELECT 'summary', '', '', '{m}', CAST(\"{m}\" AS DOUBLE) FROM ({SQL['view_v40_report_summary']})" for m in _SUMMARY]
    for name, measures in _BLOCKS.items():
        at = "'' AS dimension, '' AS \"key\"" if name in ("kpi_concentration", "kpi_time_series") else 'dimension, "key"'
        out += [f"SELECT '{name}' AS section, {at}, '{m}' AS measure, CAST(\"{m}\" AS DOUBLE) AS value FROM ({SQL[name]})" for m in measures]
    return "\nUNION ALL\n".join(out)


register("roi_waterfall", O.q("enr", f"""
SELECT step, label, amount FROM (
  SELECT r.*, x.* FROM
    (SELECT rar, CAST(round_even(rar * CAST(0.5 AS DECIMAL(12,6)), 2) AS DOUBLE) AS saved,
            CAST(round_even(CAST(hr AS DECIMAL(20,0)) * CAST(500.0 AS DECIMAL(14,2)), 2) AS DOUBLE) AS cost
     FROM (SELECT {O.esum('revenue_at_risk', 2)} AS rar, {_HR} AS hr FROM enr)) r,
    LATERAL (SELECT 1 AS step, 'Revenue at Risk' AS label, CAST(r.rar AS DOUBLE) AS amount
             UNION ALL SELECT 2, 'Revenue Saved', r.saved
             UNION ALL SELECT 3, 'Programme Cost', -r.cost
             UNION ALL SELECT 4, 'Net ROI', round_even(r.saved - r.cost, 2)) x)
"""))(lambda s, d: V.roi_waterfall(_risk(s, d)))


def _revenue_matrix(spark, d):
    return fixture_stages(spark, d).revenue_matrix


def _split_test(spark, d, label):
    from ..operators import models as MD
    cust = FX.customers(spark, d).select("customer_id", F.coalesce(
        (F.col("churn_risk_score") > PAR.churn_label_cut).cast("int"), F.lit(0)).alias("churn_label"))
    return MD.split(cust.select("customer_id", *([label] if label else [])), label, seed=PAR.seed)[1]


def _model(spark, d, kind):
    """A model at its full size, its matrix and its held-out rows; trained once for all queries, without the other model."""
    from ..operators import models as MD
    st = fixture_stages(spark, d)
    matrix = st.churn_matrix if kind == "churn" else st.revenue_matrix
    test = MD.split(matrix, "churn_label" if kind == "churn" else None, seed=PAR.seed)[1]
    return st.model(kind), matrix, test


def _model_scores(kind: str):
    """Every customer's score, with the model's hold-out figures."""
    def run(spark, d):
        from ..operators import models as MD
        model, matrix, test = _model(spark, d, kind)
        if kind == "churn":
            return MD.score_churn(model, matrix).withColumn("holdout_auc", F.lit(MD.churn_quality(model, test).first()["auc"]).cast("double"))
        q = MD.revenue_quality(model, test).first()
        return MD.score_revenue(model, matrix).withColumns({f"holdout_{k}": F.lit(q[k]).cast("double") for k in ("r2", "mae")})
    return run


def _churn_facts(spark, d):
    """Sizes of the hold-out, its AUC, the scores' range, and that
    a model saved and loaded again scores alike."""
    from ..operators import models as MD
    model, matrix, test = _model(spark, d, "churn")
    again = MD.load_model(MD.save_model(model, _scratch(spark, "churn-model")))
    q = MD.churn_quality(model, test).first()
    both = MD.score_churn(model, matrix).join(MD.score_churn(again, matrix).withColumnRenamed("churn_probability", "_again"), "customer_id")
    p = F.col("churn_probability")
    return both.agg(F.count("*").alias("n_rows"), F.lit(len(model.trees)).alias("n_trees"), F.lit(q["n"]).alias("n_held_out"),
                    F.lit(q["n_positive"]).alias("n_positive"), F.lit(q["auc"] >= 0.95).alias("auc_from_095"),
                    ((F.min(p) >= 0.0) & (F.max(p) <= 1.0)).alias("in_range"), F.min(p == F.col("_again")).alias("reload_same"))


def _revenue_facts(spark, d):
    """As above, with R2, and the mean error against that of the mean."""
    from ..operators import models as MD
    model, matrix, test = _model(spark, d, "revenue")
    again = MD.load_model(MD.save_model(model, _scratch(spark, "revenue-model")))
    q = MD.revenue_quality(model, test).first()
    both = MD.score_revenue(model, matrix).join(MD.score_revenue(again, matrix).withColumnRenamed("predicted_revenue_annual", "_again"), "customer_id")
    p = F.col("predicted_revenue_annual")
    return both.agg(F.count("*").alias("n_rows"), F.lit(len(model.trees)).alias("n_trees"), F.lit(q["n"]).alias("n_held_out"),
                    F.lit(q["r2"] >= 0.9).alias("r2_from_09"), (F.min(p) >= 0.0).alias("in_range"), F.min(p == F.col("_again")).alias("reload_same"))


def _cluster_facts(spark, d):
    """Every customer once, three names, means in their order, and
    the cost that the clusters have when it is added up from the assignment."""
    from ..operators import models as MD
    from ..sources.stages import materialize
    enr = _enr(spark, d)
    found, cost = MD.risk_clusters(enr)
    cols = ["churn_probability", "net_profit_per_client", "engagement_index"]
    j = materialize(found, "clusters").join(E.minmax_scaled(enr, cols, keep=["churn_probability"]), "customer_id")
    x = [F.col(f"{c}_scaled") for c in cols]
    # sum of squares less the squared sum by count, of each cluster
    each = j.groupBy("risk_cluster").agg(sum((F.sum(c * c) - F.sum(c) * F.sum(c) / F.count("*") for c in x[1:]),
                                             F.sum(x[0] * x[0]) - F.sum(x[0]) * F.sum(x[0]) / F.count("*")).alias("cost"))
    mean = [F.avg(F.when(F.col("risk_cluster") == c, F.col("churn_probability"))) for c in C.CLUSTER_NAMES]
    return j.agg(F.count("*").alias("n_rows"), (F.countDistinct("customer_id") == F.count("*")).alias("each_once"),
                 (F.countDistinct("risk_cluster") == 3).alias("three_names"),
                 ((mean[0] <= mean[1]) & (mean[1] <= mean[2])).alias("ordered")).withColumn(
        "cost_adds_up", F.abs(each.agg(F.sum("cost")).scalar() - F.lit(cost)) <= F.lit(1e-3 * max(cost, 1e-9)))


def _scoring_job_models(spark, d):
    """G1 with both models of full size: facts about its recommendations."""
    from .jobs import run_scoring_job
    out = _scratch(spark, "scoring-job-models")
    run_scoring_job(spark, FX.customers(spark, d), _tx(spark, d), out, use_models=True, model_dir=fixture_stages(spark, d).model_dir)
    r = spark.read.parquet(f"{out}/recommendations.parquet")
    return r.agg(F.count("*").alias("n_rows"), (F.countDistinct("customer_id") == F.count("*")).alias("each_once"),
                 ((F.min("churn_probability") >= 0) & (F.max("churn_probability") <= 1) & (F.min("predicted_revenue_annual") >= 0)).alias("in_range"),
                 F.min(F.col("recommended_action").isin(*C.ACTIONS)).alias("actions_known"))


def _risk_cluster(spark, d):
    from ..operators import models as MD
    return MD.risk_cluster_assignments(_enr(spark, d))


register("churn_model")(_model_scores("churn"))
register("revenue_model")(_model_scores("revenue"))
register("risk_cluster")(_risk_cluster)

_REV = "c.age, c.income, c.account_balance, c.tenure_months"
register("revenue_matrix", O.q(["customers", "tx_cstat"], f"""
SELECT c.customer_id, {_REV}, coalesce(t.n_tx, 0) AS tx_count,
       coalesce(CASE WHEN t.n_amt > 0 THEN CAST(t.amt_total AS DOUBLE) / CAST(t.n_amt AS DOUBLE) END, 0.0::DOUBLE) AS tx_avg_amount,
       coalesce(CAST(t.amt_total AS DOUBLE), 0.0::DOUBLE) AS tx_total_volume,
       CASE WHEN t.customer_id IS NULL THEN 0.0::DOUBLE WHEN t.n_chan > 0 THEN CAST(t.n_online AS DOUBLE)
            / CAST({_KNOWN.replace('n_', 't.n_')} AS DOUBLE) ELSE 0.5::DOUBLE END AS online_ratio,
       CAST(coalesce(c.segment = 'retail', FALSE) AS INTEGER) AS segment_retail,
       CAST(coalesce(c.segment = 'premium', FALSE) AS INTEGER) AS segment_premium,
       CAST(coalesce(c.segment = 'high_net_worth', FALSE) AS INTEGER) AS segment_hnw,
       coalesce({O.dr(O.d4('t.amt_total') + " * CAST('" + O.FACTOR + "' AS DECIMAL(10,8))", 2)}, 0.0::DOUBLE) AS revenue_target
FROM customers c LEFT JOIN tx_cstat t USING (customer_id)"""))(_revenue_matrix)

_HASHED = f"row_number() OVER (PARTITION BY {{by}} ORDER BY md5(customer_id || ':{PAR.seed}')) AS r, count(*) OVER (PARTITION BY {{by}}) AS n"
_LABEL = f"CAST(coalesce(churn_risk_score > {PAR.churn_label_cut}, FALSE) AS INTEGER)"
register("churn_split", O.q("customers", f"""
SELECT customer_id, churn_label FROM (SELECT *, {_HASHED.format(by='churn_label')} FROM (
  SELECT customer_id, {_LABEL} AS churn_label FROM customers)) WHERE r <= ceil(n * 0.2)"""))(
    lambda s, d: _split_test(s, d, "churn_label"))
register("revenue_split", O.q("customers", f"""
SELECT customer_id FROM (SELECT customer_id, {_HASHED.format(by="''")} FROM customers) WHERE r <= ceil(n * 0.2)"""))(
    lambda s, d: _split_test(s, d, None))

_TRUE = lambda *names: "SELECT count(*) AS n_rows, " + ", ".join(f"TRUE AS {n}" for n in names) + " FROM customer"
register("churn_model_facts", O.q("customers", f"""
SELECT count(*) AS n_rows, 300 AS n_trees, CAST(sum(held) AS BIGINT) AS n_held_out, CAST(sum(held * churn_label) AS BIGINT) AS n_positive,
       TRUE AS auc_from_095, TRUE AS in_range, TRUE AS reload_same
FROM (SELECT churn_label, CAST(r <= ceil(n * 0.2) AS INTEGER) AS held FROM (SELECT *, {_HASHED.format(by='churn_label')} FROM (
  SELECT customer_id, {_LABEL} AS churn_label FROM customers)))"""))(_churn_facts)
register("revenue_model_facts", """
SELECT count(*) AS n_rows, 300 AS n_trees, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n_held_out, TRUE AS r2_from_09, TRUE AS in_range, TRUE AS reload_same
FROM customer""")(_revenue_facts)
register("risk_cluster_facts", _TRUE("each_once", "three_names", "ordered", "cost_adds_up"))(_cluster_facts)
register("scoring_job_models", _TRUE("each_once", "in_range", "actions_known"))(lambda s, d: _scoring_job_models(s, d))

# -- sinks (write, read back) and jobs ----------------------------------------------------


def _scratch(spark, what: str) -> str:
    import uuid
    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/bankscope-{what}-{uuid.uuid4().hex}"


def _sink_parquet(spark, d):
    from ..sources import readers, schema, sinks
    path = sinks.write_parquet(FX.customers(spark, d), _scratch(spark, "customers") + ".parquet")
    return readers.read_table(spark, path, schema.CUSTOMER_SCHEMA)


def _sink_partitioned(spark, d):
    from ..sources import readers, schema, sinks
    path = sinks.write_partitioned(FX.transactions_with_segment(spark, d), _scratch(spark, "transactions"))
    return readers.read_shards(spark, path, schema.TX_SCHEMA)


def _sink_csv(spark, d):
    from ..sources import sinks
    fa = _fa(spark, d)
    path = sinks.write_csv(fa, _scratch(spark, "financial_aggregates") + ".csv")
    return spark.read.option("header", True).schema(fa.schema).csv(path)


register("sink_parquet", O.q("customers", "SELECT * FROM customers"))(_sink_parquet)
register("sink_partitioned", O.q(["tx", "customers"], """
SELECT t.*, c.segment FROM tx t LEFT JOIN (SELECT customer_id, segment FROM customers) c USING (customer_id)"""))(
    _sink_partitioned)
register("sink_csv", O.q("fa", "SELECT * FROM fa"))(_sink_csv)


def _scoring_job(spark, d):
    from .jobs import run_scoring_job
    out = _scratch(spark, "scoring-job")
    run_scoring_job(spark, FX.customers(spark, d), _tx(spark, d), out)
    return spark.read.parquet(f"{out}/recommendations.parquet")


def _mart_job(spark, d):
    from .jobs import run_mart_job
    out = _scratch(spark, "mart-job")
    run_mart_job(spark, _rec(spark, d), FX.transactions_with_segment(spark, d), out)
    return spark.read.parquet(f"{out}/marts/financial_aggregates.parquet")


register("scoring_job", O.q("rec", "SELECT * FROM rec"))(_scoring_job)
register("mart_job", O.q("fa", "SELECT * FROM fa"))(_mart_job)


# -- remaining readers, reports and thresholds -------------------------------------------

register("view_v10_trend_cards", O.q("ts", f"""
SELECT (SELECT {O.dr(O.esum('estimated_monthly_revenue', 2), 2)} FROM ts) AS total_revenue_24m,
       (SELECT {O.ravg(O.esum('estimated_monthly_revenue', 2), 'count(estimated_monthly_revenue)', 2, 2)} FROM ts)
         AS avg_monthly_revenue,
       (SELECT min(calendar_ym) FROM ts WHERE estimated_monthly_revenue = (SELECT max(estimated_monthly_revenue) FROM ts))
         AS peak_revenue_month,
       (SELECT max(estimated_monthly_revenue) FROM ts) AS peak_monthly_revenue,
       slope AS revenue_trend_6m_slope, CASE WHEN slope > 0 THEN 'GROWING' ELSE 'DECLINING' END AS revenue_trend_direction
FROM (SELECT {O.rr('sum((2 * x - (k - 1)) * yc)', 'max(k) * (max(k) * max(k) - 1) // 6 * 100', 2)} AS slope
      FROM (SELECT k - rd AS x, k, {O.si('estimated_monthly_revenue', 2)} AS yc
            FROM (SELECT *, row_number() OVER (ORDER BY calendar_ym DESC) AS rd,
                         least(6, count(*) OVER ()) AS k FROM ts) WHERE rd <= 6))
WHERE (SELECT count(*) FROM ts) >= 2"""))(lambda s, d: V.trend_cards(_ts(s, d)))


def _report_summary(spark, d):
    """V40 (S10 + S11): KPI summary written as a JSON report, read back."""
    from ..sources import readers, sinks
    path = sinks.write_report(K.kpi_summary(_risk(spark, d)).select(F.struct("*").alias("summary")),
                              _scratch(spark, "kpi-report") + ".json")
    r = readers.read_report(spark, path)
    return r.select("summary.*").select(*[F.col(c).cast("bigint" if c == "critical_customers" else "double").alias(c)
                                          for c in ["total_revenue", "total_revenue_at_risk", "rar_pct",
                                                    "churn_rate_pct", "total_clv", "total_net_profit",
                                                    "critical_customers"]])


register("view_v40_report_summary", O.q("enr", f"""
SELECT {O.dr(O.esum('predicted_revenue_annual', 2), 2)} AS total_revenue,
       {O.dr(O.esum('revenue_at_risk', 2), 2)} AS total_revenue_at_risk,
       {O.rpct(O.esum('revenue_at_risk', 2), O.esum('predicted_revenue_annual', 2), 2, 2)} AS rar_pct,
       {O.rr(_HR + ' * 100', 'count(*)', 2)} AS churn_rate_pct,
       {O.dr(O.esum('clv', 2), 2)} AS total_clv, {O.dr(O.esum('net_profit_per_client', 2), 2)} AS total_net_profit,
       count(*) FILTER (WHERE {_CRIT}) AS critical_customers
FROM enr"""))(_report_summary)


register("kpi_report_rows", _report_rows_sql())(_report_rows)


def _first_available(spark, d):
    """S3 + S4 + S5: the customer mart if it exists, else recommendations;
    mart names normalised to pipeline names; timestamps coerced."""
    from ..sources import readers, sinks
    mart_path = sinks.write_parquet(_mart(spark, d), _scratch(spark, "customer-table") + ".parquet")
    df = readers.read_first_available(spark, [_scratch(spark, "missing") + ".parquet", mart_path])
    tx = readers.coerce_timestamps(_tx(spark, d).withColumn("timestamp", F.col("timestamp").cast("string")))
    last = tx.groupBy("customer_id").agg(F.max("timestamp").alias("last_tx_date"))
    return readers.normalize_columns(df).select("customer_id", "predicted_revenue_annual", "clv").join(
        last, "customer_id", "left")


register("read_first_available", O.q(["enr", "tx"], """
SELECT e.customer_id, e.predicted_revenue_annual, e.clv, t.last_tx_date
FROM enr e LEFT JOIN (SELECT customer_id, max("timestamp") AS last_tx_date FROM tx GROUP BY customer_id) t
  USING (customer_id)"""))(_first_available)


def _thresholds(spark, d):
    st = fixture_stages(spark, d)
    t = D.thresholds(st.scoring)
    return t.select(*[F.bround(c, 6).alias(c) for c in t.columns])


register("bucket_thresholds", O.q("scoring", f"""
SELECT round_even(quantile_cont(churn_probability, {PAR.risk_p_high}), 6) AS churn_high,
       round_even(quantile_cont(churn_probability, {PAR.risk_p_low}), 6) AS churn_low,
       round_even(quantile_cont(financial_value_score, {PAR.value_p_high}), 6) AS value_high,
       round_even(quantile_cont(financial_value_score, {PAR.value_p_low}), 6) AS value_low
FROM scoring"""))(_thresholds)
