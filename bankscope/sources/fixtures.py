"""Adapter from the TPC-H-style test tables to ``customers`` / ``transactions``.

customers    <- customer JOIN nation JOIN region (+ a recency-based churn score)
transactions <- all orders

All mapping rules are plain column expressions so the identical rules can be
written in SQL for the oracle.  Joins run on the numeric keys before the ids
are turned into strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_CALENDAR, Calendar
from ..functions import exprs as X

# Fixed mapping values of the fixture (FIXTURES.md).
MKT_SEGMENT = {
    "FURNITURE": "retail",
    "HOUSEHOLD": "retail",
    "AUTOMOBILE": "premium",
    "BUILDING": "premium",
    "MACHINERY": "high_net_worth",
}
ORDER_STATUS_CHANNEL = {"F": "online", "O": "ATM", "P": "branch"}
# Days without an order after which the churn score is 1.
CHURN_DAYS = 723
PRIORITY_TYPE = {"1": "payment", "2": "payment", "3": "transfer", "4": "withdrawal", "5": "withdrawal"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """All orders as transactions (no segment: see ``transactions_with_segment``)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        (F.col("o_totalprice") / F.lit(100.0)).alias("amount"),
        X.map_values(F.substring("o_orderpriority", 1, 1), PRIORITY_TYPE).alias("type"),
        X.map_values("o_orderstatus", ORDER_STATUS_CHANNEL).alias("channel"),
        X.month_index("o_orderdate", cal.start).alias("month"),
    )


def churn_score_expr(last_ts: Column, cal: Calendar = DEFAULT_CALENDAR) -> Column:
    """churn_risk_score = half-even 4 dp of clip(floor days from the last
    order to the calendar end / CHURN_DAYS, 0, 1); no order -> 1."""
    days = X.floor_days(X.ts_lit(cal.end), last_ts)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                                           F.coalesce(days, F.lit(CHURN_DAYS)).cast("double") / F.lit(float(CHURN_DAYS))))
    return F.bround(score, 4)


def customers(spark: SparkSession, sf_dir: str, cal: Calendar = DEFAULT_CALENDAR,
              with_score: bool = True) -> DataFrame:
    """Customers with region and (optionally) the recency-based churn score.

    Without ``with_score`` no transaction is read; the pipeline then takes
    the last order from its own transaction roll-up (one scan of orders).
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    score = []
    if with_score:
        last = (table(spark, sf_dir, "orders").groupBy("o_custkey")
                .agg(F.max("o_orderdate").alias("_last")))
        j = j.join(last, k == F.col("o_custkey"), "left")
        score = [churn_score_expr(F.col("_last"), cal).alias("churn_risk_score")]
    return j.select(
        k.cast("string").alias("customer_id"),
        (F.lit(18) + k % 57).cast("int").alias("age"),
        (F.lit(20000) + (k * 7919) % 230000).cast("double").alias("income"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("account_balance"),
        X.map_values("c_mktsegment", MKT_SEGMENT).alias("segment"),
        *score,
        (F.lit(1) + k % 179).cast("int").alias("tenure_months"),
        F.col("r_name").alias("region"),
    )


def transactions_with_segment(spark: SparkSession, sf_dir: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """All columns of TX_SCHEMA: transactions carry the customer's segment."""
    tx = transactions(spark, sf_dir, cal)
    seg = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        X.map_values("c_mktsegment", MKT_SEGMENT).alias("segment"))
    return tx.join(seg, "customer_id", "left")
