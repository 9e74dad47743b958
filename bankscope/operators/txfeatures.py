"""Per-customer transaction features.

All features come from one roll-up of the transaction table:

  transactions --(customer, month, span of 64 days)--> span cells
               --(customer, month)-------------------> month cells
               --(customer)--------------------------> one activity row per customer

Every step is an aggregation with map-side partial aggregation, so a
customer that owns a third of all transactions is reduced to a few rows a
month and map task before the first exchange, and each later exchange
moves far fewer rows than the one before.  No pivot, no per-row Python: the
24-month statistics use closed forms on the sparse month cells (months
without spend contribute zeros implicitly):

  slope      = sum a_m (m - c) / Sxx                 c = (n-1)/2, Sxx = n(n^2-1)/12
  volatility = sqrt((n * sum a_m^2 - (sum a_m)^2) / (n (n-1)))
  streak     = (n - 1) - max{m : a_m > 0}            n if no such month

Sums are exact DECIMALs (results do not depend on partitioning).  Distinct
active days are bits of a number for each span of 64 days, joined by OR from
step to step and counted at the end: exact also where one day's transactions
have different months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import config as C
from ..config import DEFAULT_CALENDAR, Calendar
from ..functions import exprs as X
from ..sources.stages import materialize

D4 = DecimalType(18, 4)


def exact_centered_ss(n: Column, s: Column, q: Column, scale: int = 4) -> Column:
    """n * sum(x^2) - (sum x)^2 as an exact DECIMAL (8 dp for 4-dp inputs).

    Casts keep every intermediate inside 38 digits without scale loss:
    n < 1e10, sum x < 1e14, sum x^2 < 1e18.
    """
    nq = n.cast(DecimalType(10, 0)) * q.cast(DecimalType(26, 2 * scale))
    ss = s.cast(DecimalType(18, scale)) * s.cast(DecimalType(18, scale))
    return nq - ss


def sample_std(n: Column, s: Column, q: Column, scale: int = 4) -> Column:
    """Sample standard deviation from exact sums (null for n < 2)."""
    num = exact_centered_ss(n, s, q, scale).cast("double")
    den = (n.cast("double") * (n - 1).cast("double"))
    return F.when(n >= 2, F.sqrt(F.greatest(num / den, F.lit(0.0))))


def day_bits(t: Column) -> tuple[Column, Column]:
    """The span of 64 days that a time lies in, and its day as a bit there."""
    day = F.unix_date(F.to_date(t))
    return F.floor(day / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64)))


def count_days(days: Column) -> Column:
    """Distinct days of an array of (span, bits), in which spans may repeat."""
    done = lambda a: a["n"] + F.bit_count(a["bits"])
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("int").alias("span"), F.lit(0).cast("bigint").alias("bits"))

    def add(a: Column, x: Column) -> Column:
        same = a["span"].eqNullSafe(x["span"])
        return F.struct(F.when(same, a["n"]).otherwise(done(a)).alias("n"), x["span"].alias("span"),
                        F.when(same, a["bits"].bitwiseOR(x["bits"])).otherwise(x["bits"]).alias("bits"))

    return F.aggregate(F.array_sort(days), start, add, done)


def segment_amounts(columns: list[str]) -> list[Column]:
    """Exact amounts by the transaction's segment; ``other``: those without
    one or with an unknown one, all of them where there is no such column."""
    segment = F.col("segment") if "segment" in columns else F.lit(None).cast("string")
    named = {s: segment == s for s in sorted(C.SEGMENTS)}
    named["other"] = ~F.coalesce(segment.isin(*C.SEGMENTS), F.lit(False))
    return [F.sum(F.when(is_, X.dec("amount", 4))).alias(f"amt_{s}") for s, is_ in named.items()]


def month_cells(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """(customer, month) cells with the exact sums that both the customers'
    features and the monthly series are built from; transactions without a
    customer or month have cells of their own."""
    t = F.col("timestamp")
    has_id = F.col("transaction_id").isNotNull()
    x = X.dec("amount", 4)
    by_segment = segment_amounts(tx.columns)
    names = [f"amt_{s}" for s in [*sorted(C.SEGMENTS), "other"]]
    span, bit = day_bits(t)
    days = (tx.groupBy("customer_id", "month", span.alias("span"))
              .agg(
                  F.bit_or(bit).alias("bits"),
                  F.count(F.lit(1)).alias("n_rows"),
                  F.count("transaction_id").alias("n"),
                  F.count("amount").alias("n_amt"),
                  F.sum(x).cast(D4).alias("amt"),
                  F.sum(x * x).alias("amt_sq"),
                  X.count_if(has_id & (t >= X.ts_lit(cal.cut_30))).alias("n30"),
                  X.count_if(has_id & (t >= X.ts_lit(cal.cut_90))).alias("n90"),
                  F.max(t).alias("last_ts"),
                  X.count_if(F.col("channel") == "online").alias("n_online"),
                  X.count_if(F.col("channel") == "ATM").alias("n_atm"),
                  X.count_if(F.col("channel") == "branch").alias("n_branch"),
                  F.count("channel").alias("n_chan"),
                  *by_segment,
              ))
    # dealt by customer alone: the cells of one customer are together already
    # where they are written in buckets or rolled up further
    return (days.repartition("customer_id").groupBy("customer_id", "month")
                  .agg(F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.sum("n_amt").alias("n_amt"),
                       F.sum("amt").cast(D4).alias("a"), F.sum("amt_sq").alias("amt_sq"),
                       F.sum("n30").alias("n30"), F.sum("n90").alias("n90"),
                       F.max("last_ts").alias("last_ts"), F.collect_list(F.when(F.col("span").isNotNull(), F.struct("span", "bits"))).alias("days"),
                       F.sum("n_online").alias("n_online"), F.sum("n_atm").alias("n_atm"),
                       F.sum("n_branch").alias("n_branch"), F.sum("n_chan").alias("n_chan"),
                       *[F.sum(c).alias(c) for c in names]))


def customer_activity(tx: DataFrame | None, cal: Calendar = DEFAULT_CALENDAR, unknown: bool = False,
                      cells: DataFrame | None = None) -> DataFrame:
    """One row per customer with the exact sums every feature is built from;
    with ``unknown`` one more for the transactions without a customer.
    ``cells``: the table of ``month_cells``, if there is one already."""
    months = cells if cells is not None else month_cells(tx if unknown else tx.where(F.col("customer_id").isNotNull()), cal)
    if not unknown:
        months = months.where(F.col("customer_id").isNotNull())
    m = F.col("month")
    a = F.col("a")
    in_range = m.isNotNull() & (m >= 0) & (m < cal.n_months)
    centred = (m.cast(DecimalType(6, 0)) - X.dlit(cal.centre, 6, 1))
    return (months.groupBy("customer_id")
                  .agg(F.sum("n").alias("n_tx"), F.sum("n_amt").alias("n_amt"),
                       F.sum("a").alias("amt_total"), F.sum("amt_sq").alias("amt_sq"),
                       F.sum("n30").alias("n30"), F.sum("n90").alias("n90"),
                       F.max("last_ts").alias("last_ts"), count_days(F.flatten(F.collect_list("days"))).alias("n_days"),
                       F.sum("n_online").alias("n_online"), F.sum("n_atm").alias("n_atm"),
                       F.sum("n_branch").alias("n_branch"), F.sum("n_chan").alias("n_chan"),
                       F.sum(F.when(in_range, a)).alias("m_sum"),
                       F.sum(F.when(in_range, a * a)).alias("m_sq"),
                       F.sum(F.when(in_range, a * centred)).alias("m_xy"),
                       F.max(F.when(in_range & (a > 0), m)).alias("m_last_active")))


def customer_totals(tx: DataFrame) -> DataFrame:
    """One row per customer, and one for the transactions without a customer,
    with those sums of ``customer_activity`` that need neither months nor
    days: one aggregation, combined before the exchange."""
    x = X.dec("amount", 4)
    return tx.groupBy("customer_id").agg(
        F.count("transaction_id").alias("n_tx"), F.count("amount").alias("n_amt"),
        F.sum(x).alias("amt_total"), F.sum(x * x).alias("amt_sq"), F.max("timestamp").alias("last_ts"),
        X.count_if(F.col("channel") == "online").alias("n_online"), X.count_if(F.col("channel") == "ATM").alias("n_atm"),
        X.count_if(F.col("channel") == "branch").alias("n_branch"), F.count("channel").alias("n_chan"))


def repeated(totals: DataFrame, copies: str) -> DataFrame:
    """``customer_totals`` with every transaction of a customer counted
    ``copies`` times (null: once)."""
    n = F.coalesce(copies, F.lit(1))
    exact = lambda c, scale: (F.col(c).cast(DecimalType(28, scale)) * n.cast(DecimalType(9, 0)))
    counts = ["n_tx", "n_amt", "n_online", "n_atm", "n_branch", "n_chan"]
    return totals.withColumns({**{c: F.col(c) * n for c in counts}, "amt_total": exact("amt_total", 4).cast(DecimalType(28, 4)),
                               "amt_sq": exact("amt_sq", 8)}).drop(copies)


# -- E7: the nine behavioural features -------------------------------------

# Names and order of the output columns.
TX_FEATURE_COLUMNS = [
    "transaction_count_30d", "transaction_count_90d", "days_since_last_transaction",
    "active_days_ratio", "avg_transaction_amount", "spending_trend_slope",
    "spending_volatility", "inactivity_streak", "online_channel_ratio",
]


def feature_columns(cal: Calendar = DEFAULT_CALENDAR) -> list[Column]:
    n = cal.n_months
    # cast before coalescing: a wider-typed zero would widen (and cut) the scale
    s = F.coalesce(F.col("m_sum").cast(DecimalType(18, 4)), F.lit(0).cast(DecimalType(18, 4)))
    q = F.coalesce(F.col("m_sq").cast(DecimalType(26, 8)), F.lit(0).cast(DecimalType(26, 8)))
    var_num = exact_centered_ss(F.lit(n), s, q).cast("double")
    return [
        F.col("n30").alias("transaction_count_30d"),
        F.col("n90").alias("transaction_count_90d"),
        X.floor_days(X.ts_lit(cal.end), F.col("last_ts")).alias("days_since_last_transaction"),
        X.clip(F.col("n_days").cast("double") / F.lit(float(cal.obs_days)), 0.0, 1.0).alias("active_days_ratio"),
        X.safe_ratio(F.col("amt_total"), F.col("n_amt"), 0.0).alias("avg_transaction_amount"),
        F.coalesce(F.col("m_xy").cast("double") / F.lit(cal.sxx), F.lit(0.0)).alias("spending_trend_slope"),
        F.sqrt(F.greatest(var_num / F.lit(float(n * (n - 1))), F.lit(0.0))).alias("spending_volatility"),
        F.coalesce(F.lit(n - 1) - F.col("m_last_active"), F.lit(n)).cast("int").alias("inactivity_streak"),
        X.safe_ratio(F.col("n_online"), F.col("n_chan"), 0.0).alias("online_channel_ratio"),
    ]


def transaction_features(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """customer_id + the nine features, for customers with transactions."""
    return customer_activity(tx, cal).select("customer_id", *feature_columns(cal))


def tx_window_counts(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """A4 + A5: 30/90-day counts and recency."""
    return transaction_features(tx, cal).select(
        "customer_id", "transaction_count_30d", "transaction_count_90d", "days_since_last_transaction")


def active_days(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """A6 (+U2): distinct active days and their ratio to the window length."""
    act = customer_activity(tx, cal)
    return act.select("customer_id", F.col("n_days").alias("active_days"),
                      X.clip(F.col("n_days").cast("double") / F.lit(float(cal.obs_days)), 0.0, 1.0)
                      .alias("active_days_ratio"))


def monthly_spend(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Sparse (customer, month) spend for months 0..n-1 (missing = 0)."""
    m = F.col("month")
    return (tx.where(F.col("customer_id").isNotNull() & (m >= 0) & (m < cal.n_months))
              .groupBy("customer_id", "month")
              .agg(X.exact_sum("amount", 4).cast("double").alias("spend")))


def spend_trend(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Volatility, slope and inactivity streak over the month grid."""
    return transaction_features(tx, cal).select(
        "customer_id", "spending_volatility", "spending_trend_slope", "inactivity_streak")


def _known_channel_ratios() -> tuple[Column, Column]:
    known = F.col("n_online") + F.col("n_atm") + F.col("n_branch")
    den = F.when(known == 0, F.lit(1)).otherwise(known).cast("double")
    has = F.col("n_chan") > 0
    online = F.when(has, F.col("n_online").cast("double") / den)
    atm = F.when(has, F.col("n_atm").cast("double") / den)
    return online, atm


def churn_tx_features(tx: DataFrame | None, cal: Calendar = DEFAULT_CALENDAR, activity: DataFrame | None = None) -> DataFrame:
    """A1 + A2: count, mean, sample std, recency against the latest
    transaction of the whole table, online/ATM share of the known channels.

    The transactions are read once: their latest time comes from the
    roll-up, which is written as a stage (``activity``: such a stage, with
    the row for unknown customers, if there is one already)."""
    act = activity if activity is not None else materialize(customer_activity(tx, cal, unknown=True), "activity")
    ref = act.agg(F.max("last_ts")).scalar()
    online, atm = _known_channel_ratios()
    return act.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.col("n_tx").alias("tx_count"),
        X.safe_ratio(F.col("amt_total"), F.col("n_amt")).alias("tx_avg_amount"),
        F.coalesce(sample_std(F.col("n_amt"), F.col("amt_total"), F.col("amt_sq")), F.lit(0.0)).alias("tx_std_amount"),
        F.col("last_ts").alias("last_tx_date"),
        X.floor_days(ref, F.col("last_ts")).alias("tx_recency_days"),
        online.alias("online_ratio"),
        atm.alias("atm_ratio"),
    )


def channel_ratios(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """A2: online and ATM shares of the three known channels."""
    act = customer_activity(tx, cal)
    online, atm = _known_channel_ratios()
    return act.select("customer_id", F.col("n_online").alias("online_cnt"), F.col("n_atm").alias("atm_cnt"),
                      F.col("n_branch").alias("branch_cnt"), online.alias("online_ratio"), atm.alias("atm_ratio"))


def revenue_tx_features(tx: DataFrame, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """A3: count, mean, total volume and online share (missing share 0.5)."""
    act = customer_activity(tx, cal)
    online, _ = _known_channel_ratios()
    return act.select(
        "customer_id",
        F.col("n_tx").alias("tx_count"),
        X.safe_ratio(F.col("amt_total"), F.col("n_amt")).alias("tx_avg_amount"),
        F.col("amt_total").cast("double").alias("tx_total_volume"),
        F.coalesce(online, F.lit(0.5)).alias("online_ratio"),
    )
