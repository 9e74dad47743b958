"""Risk/value bucketing, recommended action and priority.

Bucket thresholds are whole-table quantiles computed as scalar subqueries
(one value each) - never an unpartitioned window over customers.  Churn
probability and value score are 4-dp values in [0, 1], a grid of at most
10,001 distinct values, so Spark's exact ``percentile`` buffer is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import config as C
from ..config import DEFAULT_PARAMS, Params
from ..functions import exprs as X
from ..functions import stats as S

P8 = DecimalType(12, 8)

# Names and order of the output columns.
REC_COLUMNS = [
    "customer_id", "segment", "age", "income", "account_balance", "tenure_months", "region",
    "churn_risk_score", "churn_probability", "predicted_revenue_annual", "clv", "financial_value_score",
    "risk_level", "financial_value", "recommended_action", "action_rationale", "priority_score",
]


def thresholds(scoring: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The four bucket thresholds as one row (exact linear quantiles)."""
    churn = S.quantiles(scoring, "churn_probability",
                        {"churn_high": params.risk_p_high, "churn_low": params.risk_p_low}, bounded=True)
    value = S.quantiles(scoring, "financial_value_score",
                        {"value_high": params.value_p_high, "value_low": params.value_p_low}, bounded=True)
    return S.one_row(scoring.sparkSession, {**S.scalars(churn), **S.scalars(value)})


def decision_expr(risk: Column, value: Column) -> Column:
    """The 3 x 3 risk/value matrix as a CASE expression."""
    e = None
    for (r, v), action in C.DECISION_MATRIX.items():
        cond = (risk == r) & (value == v)
        e = F.when(cond, action) if e is None else e.when(cond, action)
    return e


def priority_expr(risk: Column, value: Column, p: Column, score: Column) -> Column:
    """0.5 p w_risk + 0.5 score w_value, half-even 4 dp (exact)."""
    half = X.dlit("0.5", 2, 1)
    wr = X.level_weight(risk).cast(DecimalType(1, 0))
    wv = X.level_weight(value).cast(DecimalType(1, 0))
    return X.dround(p.cast(P8) * wr * half + score.cast(P8) * wv * half, 4)


def rationale_expr() -> Column:
    """What led to the action: the two levels, and the override if it applied."""
    return F.concat(F.lit("risk "), F.col("risk_level"), F.lit(", value "), F.col("financial_value"),
                    F.when((F.col("segment") == "high_net_worth") & (F.col("risk_level") == "High"),
                           F.lit(", high net worth")).otherwise(F.lit("")),
                    F.lit(" -> "), F.col("recommended_action"))


def apply_recommendations(scoring: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Risk level, value level, action, rationale, priority, HNW override."""
    c = S.scalars(S.quantiles(scoring, "churn_probability", {"hi": params.risk_p_high, "lo": params.risk_p_low}, bounded=True))
    v = S.scalars(S.quantiles(scoring, "financial_value_score", {"hi": params.value_p_high, "lo": params.value_p_low}, bounded=True))
    p65, p35, v_hi, v_lo = c["hi"], c["lo"], v["hi"], v["lo"]
    risk = X.level_at_least("churn_probability", p65, p35)
    value = X.level_at_least("financial_value_score", v_hi, v_lo)
    df = scoring.withColumns({"risk_level": risk, "financial_value": value})
    action = decision_expr(F.col("risk_level"), F.col("financial_value"))
    override = (F.col("segment") == "high_net_worth") & (F.col("risk_level") == "High")
    action = F.when(override, F.lit(C.RETAIN_PREMIUM)).otherwise(action)
    df = df.withColumn("recommended_action", action)
    return df.select(
        *scoring.columns, "risk_level", "financial_value", "recommended_action",
        rationale_expr().alias("action_rationale"),
        priority_expr(F.col("risk_level"), F.col("financial_value"), F.col("churn_probability"),
                      F.col("financial_value_score")).alias("priority_score"),
    )
