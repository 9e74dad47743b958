"""Financial and composite features, the enriched customer table (E1-E8,
M13, M16, P4, P18).

Whole-table statistics (maxima, quantiles) are scalar subqueries: each is
one value computed by a distributed aggregation and then used as a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import config as C
from ..config import DEFAULT_CALENDAR, DEFAULT_PARAMS, Calendar, Params
from ..functions import exprs as X
from ..functions import stats as S
from . import txfeatures as TXF

P8 = DecimalType(12, 8)
FEATURE_FILL = {
    "transaction_count_30d": 0, "transaction_count_90d": 0, "days_since_last_transaction": 0,
    "active_days_ratio": 0.0, "avg_transaction_amount": 0.0, "spending_trend_slope": 0.0,
    "spending_volatility": 0.0, "inactivity_streak": 0, "online_channel_ratio": 0.0,
}
# Names and order of the output columns.
FINANCIAL_COLUMNS = [
    "cost_to_serve", "total_revenue_generated", "estimated_margin_per_client", "net_profit_per_client",
    "revenue_at_risk", "balance_decay_rate", "customer_tenure_years", "customer_value_score",
]
COMPOSITE_COLUMNS = [
    "engagement_index", "risk_adjusted_value_score", "churn_probability_pct", "risk_cluster", "value_cluster",
]


def _p(c: str = "churn_probability") -> Column:
    return F.col(c).cast(P8)


def financial_features(df: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """E1-E3 (P4): cost, revenue, margin, profit, revenue at risk, decay,
    tenure in years, value score alias.  Money products are exact DECIMALs
    rounded half-even."""
    rev = X.dec("predicted_revenue_annual", 2)
    margin = X.dround(rev * X.dlit(params.margin_rate, 10, 8), 2)
    cost = X.map_values("segment", params.cost_to_serve, params.default_cost)
    out = df.withColumns({
        "cost_to_serve": cost,
        "total_revenue_generated": X.dround(rev, 2),
        "estimated_margin_per_client": margin,
    })
    return out.withColumns({
        "net_profit_per_client": X.dround(X.dec("estimated_margin_per_client", 2) - X.dec("cost_to_serve", 2), 2),
        "revenue_at_risk": X.dround(rev * _p(), 2),
        "balance_decay_rate": X.dround(_p() * X.dlit(params.balance_decay, 4, 2), 4),
        "customer_tenure_years": F.bround(F.col("tenure_months").cast("double") / F.lit(12.0), 2),
        "customer_value_score": X.dround(_p("financial_value_score"), 4),
    })


def engagement_expr(max_recency: Column, max_tx90: Column) -> Column:
    """0.3 active ratio + 0.3 tx90/max + 0.2 online + 0.2 recency score."""
    recency = F.lit(1.0) - X.clip(F.col("days_since_last_transaction").cast("double") / max_recency, 0.0, 1.0)
    freq = X.clip(F.col("transaction_count_90d").cast("double") / max_tx90, 0.0, 1.0)
    e = (F.lit(0.30) * F.col("active_days_ratio") + F.lit(0.30) * freq
         + F.lit(0.20) * F.col("online_channel_ratio") + F.lit(0.20) * recency)
    return X.clip(F.bround(e, 4), 0.0, 1.0)


def risk_tercile(df: DataFrame, params: Params = DEFAULT_PARAMS) -> Column:
    """Churn probability p33/p66 bands, right-closed (bounded grid)."""
    q = S.scalars(S.quantiles(df, "churn_probability", {"p33": params.tercile_ps[0], "p66": params.tercile_ps[1]}, bounded=True))
    return X.cut_right("churn_probability", [q["p33"], q["p66"]], list(C.CLUSTER_NAMES))


def value_cluster(df: DataFrame, params: Params = DEFAULT_PARAMS) -> Column:
    """CLV p33/p66 bands, right-closed (CLV is unbounded: distributed
    order statistics instead of one percentile buffer)."""
    q = S.scalars(S.quantile_row(df, "clv", {"p33": params.tercile_ps[0], "p66": params.tercile_ps[1]}))
    return X.cut_right("clv", [q["p33"], q["p66"]], list(C.CLUSTER_NAMES))


def composite_features(df: DataFrame, params: Params = DEFAULT_PARAMS, risk_cluster: Column | None = None) -> DataFrame:
    """E4-E6 + M16: engagement, risk-adjusted value, churn %, clusters.

    ``risk_cluster`` defaults to the tercile bands (M16); the KMeans clusters
    (M14) come from the table so built: see ``with_risk_cluster``.  All
    whole-table statistics are taken from the input frame, so no subquery
    nests another one.
    """
    mx = S.scalars(df.agg(F.greatest(F.max(F.col("days_since_last_transaction").cast("double")), F.lit(1.0)).alias("r"),
                          F.greatest(F.max(F.col("transaction_count_90d").cast("double")), F.lit(1.0)).alias("t")))
    rc = risk_cluster if risk_cluster is not None else risk_tercile(df, params)
    vc = value_cluster(df, params)
    return df.withColumns({
        "engagement_index": engagement_expr(mx["r"], mx["t"]),
        "risk_adjusted_value_score": X.dround(_p("financial_value_score") * (X.dlit(1, 1, 0) - _p()), 4),
        "churn_probability_pct": X.dround(_p() * X.dlit(100, 3, 0), 1),
        "risk_cluster": rc,
        "value_cluster": vc,
    })


def minmax_scaled(df: DataFrame, cols=("churn_probability", "net_profit_per_client", "engagement_index"), keep=()) -> DataFrame:
    """Min-max scaling of the clustering inputs (nulls -> 0 first);
    a constant column scales to 0."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.coalesce(F.col(c), F.lit(0.0))).alias(f"{c}__lo"),
                 F.max(F.coalesce(F.col(c), F.lit(0.0))).alias(f"{c}__hi")]
    mm = S.scalars(df.agg(*aggs))
    out = []
    for c in cols:
        lo, hi = mm[f"{c}__lo"], mm[f"{c}__hi"]
        x = F.coalesce(F.col(c), F.lit(0.0)).cast("double")
        out.append(F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0)).alias(f"{c}_scaled"))
    return df.select("customer_id", *keep, *out)


def fill_features(df: DataFrame) -> DataFrame:
    """Customers without transactions get zero features."""
    return df.fillna(FEATURE_FILL)


def enrich_from(rec_with_features: DataFrame, params: Params = DEFAULT_PARAMS,
                risk_cluster: Column | None = None) -> DataFrame:
    """E8 on recommendations that already carry the nine E7 columns."""
    return composite_features(financial_features(fill_features(rec_with_features), params), params, risk_cluster)


def enrich(recommendations: DataFrame, tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR,
           params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Recommendations LEFT JOIN transaction features, fill 0, E1-E6, with
    the tercile bands as risk cluster (``with_risk_cluster`` puts a table of
    clusters in their place)."""
    feats = TXF.transaction_features(tx, cal)
    j = recommendations.join(feats, "customer_id", "left")
    return enrich_from(j, params)


def with_risk_cluster(enriched: DataFrame, clusters: DataFrame) -> DataFrame:
    """The enriched table with the risk clusters of a (customer_id,
    risk_cluster) table; a customer that it lacks keeps the band."""
    c = clusters.select(F.col("customer_id").alias("_id"), F.col("risk_cluster").alias("_cluster"))
    j = enriched.join(c, F.col("customer_id") == F.col("_id"), "left")
    return j.select(*[F.coalesce("_cluster", "risk_cluster").alias(n) if n == "risk_cluster" else F.col(n) for n in enriched.columns])
