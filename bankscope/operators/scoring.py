"""Revenue target, lifetime value and the scoring table.

The scoring table takes any ``(customer_id, churn_probability)`` and
``(customer_id, predicted_revenue_annual)`` tables - MLlib model scores
(``operators.models``) or the exact deterministic scorer below, which uses
the churn score of the customer table and the revenue target itself.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..config import DEFAULT_CALENDAR, DEFAULT_PARAMS, Calendar, Params
from ..functions import exprs as X
from ..functions import stats as S
from . import txfeatures as TXF

# Names and order of the output columns.
SCORING_COLUMNS = [
    "customer_id", "segment", "age", "income", "account_balance", "tenure_months", "region",
    "churn_risk_score", "churn_probability", "predicted_revenue_annual", "clv", "financial_value_score",
]


def revenue_factor(params: Params, cal: Calendar) -> str:
    """Volume of all observed months -> annual revenue, as a decimal text."""
    return format((Decimal(12) / Decimal(cal.n_months) * Decimal(str(params.margin_rate))).quantize(Decimal("1e-8")), "f")


def revenue_target_expr(volume_exact: Column, params: Params = DEFAULT_PARAMS, cal: Calendar = DEFAULT_CALENDAR) -> Column:
    """M7: volume * 12 / months of the calendar * margin, half-even 2 dp (exact)."""
    return X.dround(volume_exact.cast(DecimalType(18, 4)) * X.dlit(revenue_factor(params, cal), 10, 8), 2)


def revenue_target(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """M7: per customer with transactions: volume, annual volume, target."""
    act = TXF.customer_activity(tx, cal)
    vol = F.col("amt_total")
    return act.select(
        "customer_id",
        vol.cast("double").alias("tx_total_volume"),
        (vol.cast("double") * F.lit(12.0 / cal.n_months)).alias("annual_tx_volume"),
        revenue_target_expr(vol, params, cal).alias("predicted_revenue_actual"),
    )


def exact_predictions(customers: DataFrame, tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR,
                      params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Deterministic scorer: churn = churn_risk_score, revenue = exact target.

    One row per customer (no transactions -> revenue 0).  Returns
    customer_id, churn_probability, predicted_revenue_annual.
    """
    vol = TXF.customer_activity(tx, cal).select("customer_id", "amt_total")
    return customers.select("customer_id", "churn_risk_score").join(vol, "customer_id", "left").select(
        "customer_id",
        F.col("churn_risk_score").alias("churn_probability"),
        F.coalesce(revenue_target_expr(F.col("amt_total"), params, cal), F.lit(0.0)).alias("predicted_revenue_annual"),
    )


def clv_expr(revenue: Column, churn: Column, params: Params = DEFAULT_PARAMS) -> Column:
    """Revenue * margin * (1 - p) * sum_t (1+r)^-t, half-even 2 dp."""
    return F.bround(revenue * F.lit(params.margin_rate) * (F.lit(1.0) - churn) * F.lit(params.discount_factor), 2)


def value_score_expr(clv: Column, lo: Column, hi: Column) -> Column:
    """Min-max scaled CLV, 4 dp; 0.5 when all CLVs are equal.

    CLVs are 2-dp amounts, so the ratio is rounded exactly (half-even on
    the true quotient of the two cent differences)."""
    num = X.scaled_int(X.dec(clv, 2) - X.dec(lo, 2), 2)
    den = X.scaled_int(X.dec(hi, 2) - X.dec(lo, 2), 2)
    return F.when(hi > lo, X.round_ratio(num, den, 4)).otherwise(F.lit(0.5))


def compute_clv(churn_preds: DataFrame, revenue_preds: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """C1 + C2 + J2: inner join of the two predictions, CLV and value score.

    The CLV range comes from two scalar subqueries (one value each); no row
    is shipped to the driver.
    """
    j = churn_preds.join(revenue_preds, "customer_id", "inner")
    with_clv = j.select("customer_id", clv_expr(F.col("predicted_revenue_annual"), F.col("churn_probability"),
                                                  params).alias("clv"))
    rng = S.scalars(with_clv.agg(F.min("clv").alias("lo"), F.max("clv").alias("hi")))
    lo, hi = rng["lo"], rng["hi"]
    return with_clv.select("customer_id", "clv", value_score_expr(F.col("clv"), lo, hi).alias("financial_value_score"))


def scoring_table(customers: DataFrame, churn_preds: DataFrame, revenue_preds: DataFrame,
                  params: Params = DEFAULT_PARAMS) -> DataFrame:
    """C3 + J3: customers left-joined with both predictions and CLV.

    Written as two left joins on ``customer_id`` (the CLV of C1 is a row
    expression of the two predictions, so it needs no third join); the
    value-score range is taken over customers that have both predictions,
    as in C1.  Missing predictions: churn 0.5, revenue 0, CLV 0, score 0.
    """
    base = customers.select("customer_id", "segment", "age", "income", "account_balance",
                            "tenure_months", "region", "churn_risk_score")
    j = (base.join(churn_preds.select("customer_id", F.col("churn_probability").alias("_p")), "customer_id", "left")
             .join(revenue_preds.select("customer_id", F.col("predicted_revenue_annual").alias("_r")),
                   "customer_id", "left"))
    both = F.col("_p").isNotNull() & F.col("_r").isNotNull()
    clv = F.when(both, clv_expr(F.col("_r"), F.col("_p"), params))
    j = j.withColumn("_clv", clv)
    rng = S.scalars(j.agg(F.min("_clv").alias("lo"), F.max("_clv").alias("hi")))
    lo, hi = rng["lo"], rng["hi"]
    return j.select(
        "customer_id", "segment", "age", "income", "account_balance", "tenure_months", "region",
        "churn_risk_score",
        F.coalesce(F.col("_p"), F.lit(0.5)).alias("churn_probability"),
        F.coalesce(F.col("_r"), F.lit(0.0)).alias("predicted_revenue_annual"),
        F.coalesce(F.col("_clv"), F.lit(0.0)).alias("clv"),
        F.coalesce(F.when(both, value_score_expr(F.col("_clv"), lo, hi)), F.lit(0.0)).alias("financial_value_score"),
    )


def exact_scoring_base(customers: DataFrame, tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR,
                       params: Params = DEFAULT_PARAMS, keep_features: bool = False,
                       churn_score_from_last=None, cells: DataFrame | None = None) -> DataFrame:
    """Customers LEFT JOIN the per-customer transaction roll-up, with the
    deterministic predictions and CLV (everything but the value score).

    Both predictions are columns of the same customer row, so the general
    three-table join collapses to one join.  With ``keep_features`` the
    nine E7 features ride along on the same join (the enrichment then needs
    no second join).
    """
    act = TXF.customer_activity(tx, cal, cells=cells)
    feats = TXF.feature_columns(cal) if keep_features else []
    vol = act.select("customer_id", "amt_total", "last_ts", *feats)
    j = customers.join(vol, "customer_id", "left")
    if churn_score_from_last is not None:
        # the churn score is derived from the same roll-up (one scan of the transactions)
        j = j.withColumn("churn_risk_score", churn_score_from_last(F.col("last_ts")))
    j = j.select(
        "customer_id", "segment", "age", "income", "account_balance", "tenure_months", "region",
        "churn_risk_score",
        F.coalesce(F.col("churn_risk_score"), F.lit(0.5)).alias("churn_probability"),
        F.coalesce(revenue_target_expr(F.col("amt_total"), params, cal), F.lit(0.0)).alias("predicted_revenue_annual"),
        *[F.col(c) for c in (TXF.TX_FEATURE_COLUMNS if keep_features else [])],
    )
    # no churn score: probability 0.5 and no value, as where a prediction is missing
    return j.withColumn("clv", F.when(F.col("churn_risk_score").isNotNull(),
                                      clv_expr(F.col("predicted_revenue_annual"), F.col("churn_probability"), params)))


def add_value_score(base: DataFrame) -> DataFrame:
    """C2 over a table with ``clv``: the CLV range is one scalar subquery.

    Run it on a materialised base so the subquery is a scan, not a second
    evaluation of the joins behind the base."""
    rng = S.scalars(base.agg(F.min("clv").alias("lo"), F.max("clv").alias("hi")))
    lo, hi = rng["lo"], rng["hi"]
    extra = [c for c in TXF.TX_FEATURE_COLUMNS if c in base.columns]
    score = F.when(F.col("clv").isNotNull(), value_score_expr(F.col("clv"), lo, hi)).otherwise(F.lit(0.0))
    return base.withColumns({"financial_value_score": score, "clv": F.coalesce("clv", F.lit(0.0))}).select(
        *SCORING_COLUMNS, *extra)


def exact_scoring_table(customers: DataFrame, tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR,
                        params: Params = DEFAULT_PARAMS, keep_features: bool = False) -> DataFrame:
    """Scoring table (C3) from the deterministic scorer."""
    return add_value_score(exact_scoring_base(customers, tx, cal, params, keep_features))
