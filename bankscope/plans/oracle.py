"""Independent SQL statements of every checked query (DuckDB dialect).

Each statement recomputes its result from the raw fixture tables
(``customer nation region orders``) with plain SQL: its own CTE chain for
customers, transactions, transaction features, scoring, recommendations
and the enriched table.  Numeric rules mirror the Spark side exactly:
exact DECIMAL sums, half-even rounding in DECIMAL for exact products, and an
integer half-even rounding of ratios (``_rr``), so both engines produce the
same bits.
"""

from __future__ import annotations

import datetime as _dt

from .. import config as C
from ..config import DEFAULT_CALENDAR as CAL
from ..config import DEFAULT_PARAMS as PAR
from ..sources.fixtures import CHURN_DAYS, MKT_SEGMENT, ORDER_STATUS_CHANNEL, PRIORITY_TYPE


def _ts(d: _dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(col: str, mapping: dict, default: str | None = None) -> str:
    parts = " ".join(f"WHEN {_q(k)} THEN {_q(v) if isinstance(v, str) else repr(float(v)) + '::DOUBLE'}"
                     for k, v in mapping.items())
    d = "NULL" if default is None else (_q(default) if isinstance(default, str) else repr(float(default)) + "::DOUBLE")
    return f"(CASE {col} {parts} ELSE {d} END)"


def si(x: str, s: int) -> str:
    """exact value * 10^s as HUGEINT (x has at most s decimals)."""
    return f"CAST(CAST({x} AS DECIMAL({38 - s},{s})) * {10 ** s} AS HUGEINT)"


def rr(n: str, d: str, dp: int) -> str:
    """half-even round(n / d, dp) for integer-valued n, d (null if d = 0)."""
    a = f"abs(CAST(({n}) AS HUGEINT) * {10 ** dp})"
    b = f"abs(CAST(({d}) AS HUGEINT))"
    rem = f"({a} % {b})"
    base = f"(({a} - {rem}) // {b})"
    r = f"(CASE WHEN 2 * {rem} > {b} THEN {base} + 1 WHEN 2 * {rem} = {b} THEN {base} + ({base} % 2) ELSE {base} END)"
    sgn = f"(CASE WHEN (({n}) < 0) <> (({d}) < 0) THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END)"
    return f"(CASE WHEN ({d}) = 0 THEN NULL ELSE {sgn} * CAST({r} AS DOUBLE) / {float(10 ** dp)}::DOUBLE END)"


def ravg(sum_: str, n: str, s: int, dp: int) -> str:
    return rr(si(sum_, s), f"CAST({n} AS HUGEINT) * {10 ** s}", dp)


def rpct(part: str, whole: str, s: int, dp: int) -> str:
    return rr(f"{si(part, s)} * 100", si(whole, s), dp)


def dr(x: str, dp: int) -> str:
    return f"CAST(round_even({x}, {dp}) AS DOUBLE)"


def d2(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def d4(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def p8(x: str) -> str:
    return f"CAST({x} AS DECIMAL(12,8))"


def esum(x: str, s: int) -> str:
    return f"sum(CAST({x} AS DECIMAL(18,{s})))"


START, END = CAL.start, CAL.end
NM = CAL.n_months
DAYS = CAL.obs_days
DF = repr(PAR.discount_factor)
#: 12 / months * margin, exact.
FACTOR = f"{12 * PAR.margin_rate / NM:.8f}"
RISK_W = "CAST(CASE {c} WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END AS DECIMAL(1,0))"
IN_RANGE = f"month >= 0 AND month < {NM}"


def _action_sql() -> str:
    parts = " ".join(f"WHEN risk_level = {_q(r)} AND financial_value = {_q(v)} THEN {_q(a)}"
                     for (r, v), a in C.DECISION_MATRIX.items())
    return (f"(CASE WHEN segment = 'high_net_worth' AND risk_level = 'High' THEN {_q(C.RETAIN_PREMIUM)} "
            f"{parts} END)")


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("tx", [], f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_orderdate AS TIMESTAMP) AS "timestamp", o_totalprice / 100.0 AS amount,
       {_case('substr(o_orderpriority, 1, 1)', PRIORITY_TYPE)} AS "type",
       {_case('o_orderstatus', ORDER_STATUS_CHANNEL)} AS channel,
       CAST((year(o_orderdate) - {START.year}) * 12 + month(o_orderdate) - {START.month} AS INTEGER) AS month
FROM orders""")

cte("last_order", [], f"SELECT o_custkey, max(o_orderdate) AS last_ts FROM orders GROUP BY o_custkey")

cte("customers", ["last_order"], f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
       CAST(18 + c.c_custkey % 57 AS INTEGER) AS age,
       CAST(20000 + (c.c_custkey * 7919) % 230000 AS DOUBLE) AS income,
       greatest(c.c_acctbal, 0.0::DOUBLE) AS account_balance,
       {_case('c.c_mktsegment', MKT_SEGMENT)} AS segment,
       round_even(least(1.0::DOUBLE, greatest(0.0::DOUBLE,
           CAST(coalesce(CAST(floor((epoch({_ts(END)}) - epoch(l.last_ts)) / 86400) AS BIGINT), {CHURN_DAYS}) AS DOUBLE)
           / {float(CHURN_DAYS)}::DOUBLE)), 4) AS churn_risk_score,
       CAST(1 + c.c_custkey % 179 AS INTEGER) AS tenure_months,
       r.r_name AS region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN last_order l ON l.o_custkey = c.c_custkey""")

cte("tx_cstat", ["tx"], f"""
SELECT customer_id, count(transaction_id) AS n_tx, count(amount) AS n_amt,
       {esum('amount', 4)} AS amt_total,
       sum({d4('amount')} * {d4('amount')}) AS amt_sq,
       count(transaction_id) FILTER (WHERE "timestamp" >= {_ts(CAL.cut_30)}) AS n30,
       count(transaction_id) FILTER (WHERE "timestamp" >= {_ts(CAL.cut_90)}) AS n90,
       max("timestamp") AS last_ts,
       count(DISTINCT CAST("timestamp" AS DATE)) AS n_days,
       count(*) FILTER (WHERE channel = 'online') AS n_online,
       count(*) FILTER (WHERE channel = 'ATM') AS n_atm,
       count(*) FILTER (WHERE channel = 'branch') AS n_branch,
       count(channel) AS n_chan
FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id""")

cte("tx_month", ["tx"], f"""
SELECT customer_id, month, {d4(esum('amount', 4))} AS a
FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id, month""")

cte("tx_mstat", ["tx_month"], f"""
SELECT customer_id,
       sum(a) FILTER (WHERE {IN_RANGE}) AS m_sum,
       sum(a * a) FILTER (WHERE {IN_RANGE}) AS m_sq,
       sum(a * (CAST(month AS DECIMAL(6,0)) - CAST('{CAL.centre}' AS DECIMAL(6,1)))) FILTER (WHERE {IN_RANGE}) AS m_xy,
       max(month) FILTER (WHERE {IN_RANGE} AND a > 0) AS m_last
FROM tx_month GROUP BY customer_id""")


def _var_num(n: str, s: str, q: str) -> str:
    return (f"CAST(CAST({n} AS DECIMAL(10,0)) * CAST({q} AS DECIMAL(26,8)) "
            f"- CAST({s} AS DECIMAL(18,4)) * CAST({s} AS DECIMAL(18,4)) AS DOUBLE)")


cte("txf", ["tx_cstat", "tx_mstat"], f"""
SELECT c.customer_id,
       c.n30 AS transaction_count_30d, c.n90 AS transaction_count_90d,
       CAST(floor((epoch({_ts(END)}) - epoch(c.last_ts)) / 86400) AS BIGINT) AS days_since_last_transaction,
       least(greatest(CAST(c.n_days AS DOUBLE) / {float(DAYS)}::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS active_days_ratio,
       CASE WHEN c.n_amt = 0 THEN 0.0::DOUBLE ELSE CAST(c.amt_total AS DOUBLE) / CAST(c.n_amt AS DOUBLE) END AS avg_transaction_amount,
       coalesce(CAST(m.m_xy AS DOUBLE) / {CAL.sxx}::DOUBLE, 0.0::DOUBLE) AS spending_trend_slope,
       sqrt(greatest({_var_num(NM, 'coalesce(m.m_sum, 0)', 'coalesce(m.m_sq, 0)')} / {float(NM * (NM - 1))}::DOUBLE,
                     0.0::DOUBLE)) AS spending_volatility,
       CAST(coalesce({NM - 1} - m.m_last, {NM}) AS INTEGER) AS inactivity_streak,
       coalesce(CAST(c.n_online AS DOUBLE) / nullif(CAST(c.n_chan AS DOUBLE), 0.0), 0.0::DOUBLE) AS online_channel_ratio
FROM tx_cstat c LEFT JOIN tx_mstat m USING (customer_id)""")

cte("scoring1", ["customers", "tx_cstat"], f"""
SELECT *, round_even(predicted_revenue_annual * {PAR.margin_rate}::DOUBLE * (1.0::DOUBLE - churn_probability)
                     * {DF}::DOUBLE, 2) AS clv
FROM (SELECT cu.customer_id, cu.segment, cu.age, cu.income, cu.account_balance, cu.tenure_months, cu.region,
             cu.churn_risk_score, cu.churn_risk_score AS churn_probability,
             coalesce({dr(d4('t.amt_total') + " * CAST('" + FACTOR + "' AS DECIMAL(10,8))", 2)}, 0.0::DOUBLE)
               AS predicted_revenue_annual
      FROM customers cu LEFT JOIN tx_cstat t USING (customer_id))""")

cte("clv_rng", ["scoring1"], "SELECT min(clv) AS lo, max(clv) AS hi FROM scoring1")

cte("scoring", ["scoring1", "clv_rng"], f"""
SELECT s.customer_id, s.segment, s.age, s.income, s.account_balance, s.tenure_months, s.region, s.churn_risk_score,
       s.churn_probability, s.predicted_revenue_annual, s.clv,
       CASE WHEN r.hi > r.lo THEN {rr(si(d2('s.clv') + ' - ' + d2('r.lo'), 2), si(d2('r.hi') + ' - ' + d2('r.lo'), 2), 4)}
            ELSE 0.5 END AS financial_value_score
FROM scoring1 s CROSS JOIN clv_rng r""")

cte("thr", ["scoring"], f"""
SELECT quantile_cont(churn_probability, {PAR.risk_p_high}) AS p_hi, quantile_cont(churn_probability, {PAR.risk_p_low}) AS p_lo,
       quantile_cont(financial_value_score, {PAR.value_p_high}) AS v_hi,
       quantile_cont(financial_value_score, {PAR.value_p_low}) AS v_lo
FROM scoring""")

cte("rec0", ["scoring", "thr"], """
SELECT s.*,
       CASE WHEN s.churn_probability >= t.p_hi THEN 'High' WHEN s.churn_probability >= t.p_lo THEN 'Medium' ELSE 'Low' END
         AS risk_level,
       CASE WHEN s.financial_value_score >= t.v_hi THEN 'High' WHEN s.financial_value_score >= t.v_lo THEN 'Medium'
            ELSE 'Low' END AS financial_value
FROM scoring s CROSS JOIN thr t""")

cte("rec", ["rec0"], f"""
SELECT *, 'risk ' || risk_level || ', value ' || financial_value
         || CASE WHEN segment = 'high_net_worth' AND risk_level = 'High' THEN ', high net worth' ELSE '' END
         || ' -> ' || recommended_action AS action_rationale,
       CAST(round_even({p8('churn_probability')} * {RISK_W.format(c='risk_level')} * CAST(0.5 AS DECIMAL(2,1))
                      + {p8('financial_value_score')} * {RISK_W.format(c='financial_value')} * CAST(0.5 AS DECIMAL(2,1)), 4)
            AS DOUBLE) AS priority_score
FROM (SELECT *, {_action_sql()} AS recommended_action FROM rec0)""")

cte("enr0", ["rec", "txf"], """
SELECT r.*,
       coalesce(f.transaction_count_30d, 0) AS transaction_count_30d,
       coalesce(f.transaction_count_90d, 0) AS transaction_count_90d,
       coalesce(f.days_since_last_transaction, 0) AS days_since_last_transaction,
       coalesce(f.active_days_ratio, 0.0) AS active_days_ratio,
       coalesce(f.avg_transaction_amount, 0.0) AS avg_transaction_amount,
       coalesce(f.spending_trend_slope, 0.0) AS spending_trend_slope,
       coalesce(f.spending_volatility, 0.0) AS spending_volatility,
       coalesce(f.inactivity_streak, 0) AS inactivity_streak,
       coalesce(f.online_channel_ratio, 0.0) AS online_channel_ratio
FROM rec r LEFT JOIN txf f USING (customer_id)""")

cte("enr1", ["enr0"], f"""
SELECT *, {dr(d2('estimated_margin_per_client') + ' - ' + d2('cost_to_serve'), 2)} AS net_profit_per_client,
       {dr(d2('predicted_revenue_annual') + ' * ' + p8('churn_probability'), 2)} AS revenue_at_risk,
       {dr(p8('churn_probability') + f" * CAST('{PAR.balance_decay}' AS DECIMAL(4,2))", 4)} AS balance_decay_rate,
       round_even(CAST(tenure_months AS DOUBLE) / 12.0::DOUBLE, 2) AS customer_tenure_years,
       {dr(p8('financial_value_score'), 4)} AS customer_value_score
FROM (SELECT *, {_case('segment', PAR.cost_to_serve, PAR.default_cost)} AS cost_to_serve,
             {dr(d2('predicted_revenue_annual'), 2)} AS total_revenue_generated,
             {dr(d2('predicted_revenue_annual') + f" * CAST('{PAR.margin_rate}' AS DECIMAL(10,8))", 2)}
               AS estimated_margin_per_client
      FROM enr0)""")

cte("enr_stats", ["enr1"], f"""
SELECT greatest(max(CAST(days_since_last_transaction AS DOUBLE)), 1.0::DOUBLE) AS mr,
       greatest(max(CAST(transaction_count_90d AS DOUBLE)), 1.0::DOUBLE) AS mt,
       quantile_cont(churn_probability, {PAR.tercile_ps[0]}) AS p33, quantile_cont(churn_probability, {PAR.tercile_ps[1]}) AS p66,
       quantile_cont(clv, {PAR.tercile_ps[0]}) AS c33, quantile_cont(clv, {PAR.tercile_ps[1]}) AS c66
FROM enr1""")


def _clip01(x: str) -> str:
    return f"least(greatest({x}, 0.0::DOUBLE), 1.0::DOUBLE)"


cte("enr", ["enr1", "enr_stats"], f"""
SELECT e.*,
       {_clip01(f"round_even(0.3::DOUBLE * e.active_days_ratio + 0.3::DOUBLE * {_clip01('CAST(e.transaction_count_90d AS DOUBLE) / q.mt')} + 0.2::DOUBLE * e.online_channel_ratio + 0.2::DOUBLE * (1.0::DOUBLE - {_clip01('CAST(e.days_since_last_transaction AS DOUBLE) / q.mr')}), 4)")}
         AS engagement_index,
       {dr(p8('e.financial_value_score') + ' * (CAST(1 AS DECIMAL(1,0)) - ' + p8('e.churn_probability') + ')', 4)}
         AS risk_adjusted_value_score,
       {dr(p8('e.churn_probability') + ' * CAST(100 AS DECIMAL(3,0))', 1)} AS churn_probability_pct,
       CASE WHEN e.churn_probability IS NULL THEN NULL WHEN e.churn_probability <= q.p33 THEN 'low'
            WHEN e.churn_probability <= q.p66 THEN 'medium' ELSE 'high' END AS risk_cluster,
       CASE WHEN e.clv IS NULL THEN NULL WHEN e.clv <= q.c33 THEN 'low' WHEN e.clv <= q.c66 THEN 'medium'
            ELSE 'high' END AS value_cluster
FROM enr1 e CROSS JOIN enr_stats q""")

cte("mart_q", ["enr"], f"""
SELECT quantile_cont(clv, {PAR.tier_ps[0]}) AS t40, quantile_cont(clv, {PAR.tier_ps[1]}) AS t70,
       quantile_cont(clv, {PAR.tier_ps[2]}) AS t90, quantile_cont(clv, 0.75) AS c75
FROM enr""")

cte("mart", ["enr", "mart_q"], f"""
SELECT e.customer_id, e.segment, e.region, e.age, e.income, e.account_balance, e.customer_tenure_years,
       e.transaction_count_30d, e.transaction_count_90d, e.active_days_ratio, e.spending_trend_slope,
       e.spending_volatility, e.avg_transaction_amount, e.engagement_index, e.days_since_last_transaction,
       e.inactivity_streak, e.balance_decay_rate, e.total_revenue_generated, e.estimated_margin_per_client,
       e.cost_to_serve, e.net_profit_per_client, e.clv AS clv_5yr, e.churn_probability, e.churn_probability_pct,
       e.revenue_at_risk, e.risk_level, e.risk_cluster, e.value_cluster, e.financial_value,
       e.financial_value_score, e.customer_value_score, e.risk_adjusted_value_score, e.recommended_action,
       e.priority_score,
       coalesce({_case('e.segment', C.SEGMENT_LABEL)}, e.segment) AS segment_label,
       {_case('e.recommended_action', C.ACTION_URGENCY, C.DEFAULT_URGENCY)} AS action_urgency,
       {_case('e.recommended_action', C.ACTION_CODE, C.DEFAULT_ACTION_CODE)} AS action_code,
       CASE WHEN e.clv IS NULL THEN NULL WHEN e.clv <= q.t40 THEN 'Standard' WHEN e.clv <= q.t70 THEN 'Preferred'
            WHEN e.clv <= q.t90 THEN 'Premium' ELSE 'Elite' END AS value_tier,
       CASE WHEN e.age IS NULL OR e.age <= 17 OR e.age > 75 THEN NULL WHEN e.age <= 29 THEN '18-29'
            WHEN e.age <= 39 THEN '30-39' WHEN e.age <= 49 THEN '40-49' WHEN e.age <= 59 THEN '50-59' ELSE '60+' END
         AS age_band,
       CAST(e.risk_level = 'High' AS INTEGER) AS is_high_risk,
       CAST(e.financial_value = 'High' AS INTEGER) AS is_high_value,
       CAST(e.risk_level = 'High' AS INTEGER) * CAST(e.financial_value = 'High' AS INTEGER) AS is_critical
FROM enr e CROSS JOIN mart_q q""")

_LEVELS = [("total", []), ("by_segment", ["segment"]), ("by_region", ["region"]),
           ("by_risk_level", ["risk_level"]), ("by_action", ["recommended_action"]),
           ("by_segment_risk", ["segment", "risk_level"]), ("by_segment_region", ["segment", "region"]),
           ("by_risk_action", ["risk_level", "recommended_action"])]


def _fa_level(name: str, cols: list[str]) -> str:
    dims = ["segment", "region", "risk_level", "recommended_action"]
    sel_dims = ", ".join(f"{d}" if d in cols else f"CAST(NULL AS VARCHAR) AS {d}" for d in dims)
    key = "'ALL'" if not cols else " || ' | ' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    where = " AND ".join(f"{c} IS NOT NULL" for c in cols) or "TRUE"
    grp = f"GROUP BY {', '.join(cols)}" if cols else ""
    tot = not cols

    def avg2(col: str) -> str:
        if tot:
            return f"CAST(round_even(CAST({ravg(esum(col, 4), f'count({col})', 4, 4)} AS DECIMAL(18,4)), 2) AS DOUBLE)"
        return ravg(esum(col, 4), f"count({col})", 4, 2)

    return f"""
SELECT {key} AS dimension_key, '{name}' AS aggregation_level, count(customer_id) AS n_customers,
       {dr(esum('predicted_revenue_annual', 2), 2)} AS total_revenue,
       {ravg(esum('predicted_revenue_annual', 2), 'count(predicted_revenue_annual)', 2, 2)} AS avg_revenue_per_customer,
       {dr(esum('revenue_at_risk', 2), 2)} AS total_revenue_at_risk,
       {dr(esum('net_profit_per_client', 2), 2)} AS total_net_profit,
       {ravg(esum('net_profit_per_client', 2), 'count(net_profit_per_client)', 2, 2)} AS avg_net_profit,
       {dr(esum('clv', 2), 2)} AS total_clv,
       {ravg(esum('clv', 2), 'count(clv)', 2, 2)} AS avg_clv,
       {avg2('churn_probability')} AS avg_churn_probability,
       count(*) FILTER (WHERE risk_level = 'High') AS high_risk_count,
       count(*) FILTER (WHERE financial_value = 'High') AS high_value_count,
       count(*) FILTER (WHERE risk_level = 'High' AND financial_value = 'High') AS critical_count,
       {avg2('engagement_index')} AS avg_engagement,
       {avg2('priority_score')} AS avg_priority_score,
       {dr(esum('cost_to_serve', 2), 2)} AS total_cost_to_serve,
       {rr("count(*) FILTER (WHERE risk_level = 'High') * 100", 'count(customer_id)', 2)} AS churn_rate_pct,
       {rpct(esum('revenue_at_risk', 2), esum('predicted_revenue_annual', 2), 2, 2)} AS revenue_at_risk_pct,
       {rpct(esum('net_profit_per_client', 2), esum('predicted_revenue_annual', 2), 2, 2)} AS profitability_ratio,
       {sel_dims}
FROM (SELECT * FROM enr WHERE {where}) {grp}"""


cte("fa", ["enr"], "\nUNION ALL\n".join(_fa_level(n, c) for n, c in _LEVELS))

# -- time series ----------------------------------------------------------------

_SEGS = sorted(C.SEGMENTS)
_OTHER = "coalesce(segment NOT IN (" + ", ".join(_q(s) for s in _SEGS) + "), TRUE)"
_IS = {**{s: f"segment = {_q(s)}" for s in _SEGS}, "other": _OTHER}

cte("txs", ["tx", "customers"], "SELECT t.*, c.segment FROM tx t LEFT JOIN customers c USING (customer_id)")

cte("cm", ["txs"], f"""
SELECT customer_id, month, count(*) AS n_rows, count(transaction_id) AS n_tx, count(amount) AS n_amt,
       {esum('amount', 4)} AS amt,
       {", ".join(f"sum({d4('amount')}) FILTER (WHERE {w}) AS amt_{s}" for s, w in _IS.items())}
FROM txs WHERE month IS NOT NULL GROUP BY customer_id, month""")


def _ym(m: str) -> str:
    return f"strftime(DATE '{START.isoformat()}' + to_months(CAST({m} AS INTEGER)), '%Y-%m')"


_PER = format((__import__('decimal').Decimal(str(PAR.margin_rate)) / CAL.n_months).quantize(
    __import__('decimal').Decimal('1e-10')), 'f')

cte("mtx", ["cm"], f"""
SELECT {_ym('month')} AS calendar_ym, sum(n_tx) AS transaction_volume,
       {dr('sum(amt)', 4)} AS total_transaction_amount,
       {ravg('sum(amt)', 'sum(n_amt)', 4, 4)} AS avg_transaction_amount,
       count(customer_id) AS unique_active_customers,
       {dr(f"CAST(sum(amt) AS DECIMAL(20,4)) * CAST('{_PER}' AS DECIMAL(12,10))", 2)} AS estimated_monthly_revenue
FROM cm GROUP BY month""")

cte("mrisk", ["cm", "enr"], f"""
SELECT {_ym('c.month')} AS calendar_ym,
       {ravg('sum(CAST(e.churn_probability AS DECIMAL(10,4)) * CAST(c.n_rows AS DECIMAL(20,0)))',
             'sum(c.n_rows) FILTER (WHERE e.churn_probability IS NOT NULL)', 4, 4)} AS avg_churn_probability,
       CAST(sum(CAST(e.churn_probability AS DECIMAL(10,4)) * CAST(c.n_rows AS DECIMAL(20,0))) AS DOUBLE) AS _pn,
       sum(c.n_rows) FILTER (WHERE e.churn_probability IS NOT NULL) AS _pcount,
       coalesce(sum(c.n_rows) FILTER (WHERE e.risk_level = 'High'), 0) AS high_risk_active_count,
       {rr(si('coalesce(sum(CAST(e.revenue_at_risk AS DECIMAL(18,2)) * CAST(c.n_rows AS DECIMAL(20,0))), 0)', 2),
           str(CAL.n_months * 100), 4)} AS monthly_revenue_at_risk,
       {", ".join(f"coalesce({dr(f'sum(c.amt_{s})', 4)}, 0.0::DOUBLE) AS tx_amount_{s}" for s in _IS)}
FROM cm c LEFT JOIN enr e USING (customer_id) GROUP BY c.month""")

cte("ts0", ["mtx", "mrisk"], "SELECT * FROM mtx LEFT JOIN mrisk USING (calendar_ym)")

_REVC = si("estimated_monthly_revenue", 2)
cte("ts", ["ts0"], f"""
SELECT calendar_ym, transaction_volume, total_transaction_amount, avg_transaction_amount, unique_active_customers,
       estimated_monthly_revenue, avg_churn_probability, high_risk_active_count, monthly_revenue_at_risk,
       {", ".join(f"tx_amount_{s}" for s in _IS)},
       strptime(calendar_ym || '-01', '%Y-%m-%d') AS calendar_date,
       month_index,
       {rr('rsum', 'least(month_index, 3) * 100', 2)} AS revenue_3m_rolling_avg,
       round_even(csum / nullif(CAST(cn AS DOUBLE), 0.0), 4) AS churn_prob_3m_rolling_avg,
       {rr('vsum', 'least(month_index, 3)', 0)} AS tx_volume_3m_rolling_avg,
       {rr('(revc - lag1) * 100', 'lag1', 2)} AS revenue_mom_growth_pct
FROM (SELECT *,
        revc + coalesce(lag1, 0) + coalesce(lag2, 0) AS rsum,
        coalesce(c2, 0.0::DOUBLE) + coalesce(c1, 0.0::DOUBLE) + coalesce(raw, 0.0::DOUBLE) AS csum,
        CAST(c2 IS NOT NULL AS INTEGER) + CAST(c1 IS NOT NULL AS INTEGER) + CAST(raw IS NOT NULL AS INTEGER) AS cn,
        transaction_volume + coalesce(v1, 0) + coalesce(v2, 0) AS vsum
      FROM (SELECT *, row_number() OVER w AS month_index,
              lag(revc, 1) OVER w AS lag1, lag(revc, 2) OVER w AS lag2,
              lag(raw, 1) OVER w AS c1, lag(raw, 2) OVER w AS c2,
              lag(transaction_volume, 1) OVER w AS v1, lag(transaction_volume, 2) OVER w AS v2
            FROM (SELECT *, {_REVC} AS revc, _pn / CAST(_pcount AS DOUBLE) AS raw FROM ts0)
            WINDOW w AS (ORDER BY calendar_ym)))""")


def with_(*names: str) -> str:
    """WITH clause holding the named CTEs and their dependencies in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order) + "\n"


def q(names, select: str) -> str:
    if isinstance(names, str):
        names = [names]
    return with_(*names) + select
