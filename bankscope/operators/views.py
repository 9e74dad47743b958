"""Filters, top-k lists and the datasets behind the dashboard charts
(F1-F9, T1-T7, V1-V41).  Drawing is not built; each function returns the
rows a chart would plot.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_PARAMS, Params
from ..functions import exprs as X
from ..functions import stats as S

def _high() -> Column:
    return F.col("risk_level") == "High"




# -- filters ---------------------------------------------------------------

def filter_portfolio(df: DataFrame, segments: Sequence[str] | None = None, risks: Sequence[str] | None = None,
                     regions: Sequence[str] | None = None, income_range: tuple[float, float] | None = None,
                     actions: Sequence[str] | None = None) -> DataFrame:
    """conjunction of the sidebar filters (inclusive income range;
    region only when the table has the column)."""
    cond = F.lit(True)
    if segments is not None:
        cond = cond & F.col("segment").isin(list(segments))
    if risks is not None:
        cond = cond & F.col("risk_level").isin(list(risks))
    if income_range is not None:
        cond = cond & F.col("income").between(float(income_range[0]), float(income_range[1]))
    if actions is not None:
        cond = cond & F.col("recommended_action").isin(list(actions))
    if regions is not None and "region" in df.columns:
        cond = cond & F.col("region").isin(list(regions))
    return df.where(cond)


def dashboard_filters(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    """predicate builder over a dict: ``col: [values]`` (IN),
    ``col: (lo, hi)`` (inclusive range, None = open), ``col__min: v``."""
    cond = F.lit(True)
    for k, v in spec.items():
        if k.endswith("__min"):
            cond = cond & (F.col(k[:-5]) >= v)
        elif k.endswith("__max"):
            cond = cond & (F.col(k[:-5]) <= v)
        elif isinstance(v, tuple):
            lo, hi = v
            if lo is not None:
                cond = cond & (F.col(k) >= lo)
            if hi is not None:
                cond = cond & (F.col(k) <= hi)
        else:
            cond = cond & F.col(k).isin(list(v))
    return df.where(cond)


def search_customer(df: DataFrame, text: str, regex: bool = True) -> DataFrame:
    """F4 + V24: case-insensitive search on the id (a regular expression, as
    in the original dashboard; ``regex=False`` for a literal substring);
    the first hit by id.  The limit is the feature (one profile)."""
    t = text.strip()
    body = t if regex else "".join("\\" + ch if not ch.isalnum() else ch for ch in t)
    return df.where(F.col("customer_id").rlike("(?i)" + body)).orderBy("customer_id").limit(1)


#: Characters of an id's pieces at most, and folders of an index of them.
PIECE, PIECE_FOLDERS = 3, 64


def _pieces(text: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text."""
    n = F.length(text) - (size - 1)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))
    return F.array_distinct(F.filter(each, lambda p: F.length(p) == size))


def _folder(piece: Column) -> Column:
    return F.pmod(F.crc32(piece.cast("binary")), F.lit(PIECE_FOLDERS)).cast("int")


def id_index(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Inverted table (folder, piece, id) of the pieces of one to PIECE
    characters of every id, in lower case; write it with ``write_index``."""
    every = F.concat(*[_pieces(F.lower("id"), n) for n in range(1, PIECE + 1)])
    return (df.where(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
              .select(F.explode(every).alias("piece"), "id").withColumn("folder", _folder(F.col("piece"))))


def write_index(index: DataFrame, path: str) -> str:
    """An index by folder, its rows sorted by piece and id."""
    (index.repartition("folder", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("folder", "piece", "id")
          .write.mode("overwrite").partitionBy("folder").parquet(path))
    return path


def literal_runs(pattern: str) -> list[str]:
    """Runs of letters and digits that every hit of a pattern must hold; none
    where the pattern has more than such runs, '.', '^', '$' and '-'."""
    if not re.fullmatch(r"[A-Za-z0-9.^$\-]*", pattern):
        return []
    return [r.lower() for r in re.findall(r"[A-Za-z0-9]+", pattern)]


def search_ids(index: DataFrame, text: str, regex: bool = True) -> DataFrame | None:
    """The ids (id) that may match a search: those that hold all its literal
    pieces.  Only the folders of these pieces are read.  None where the
    search has no literal piece: then nothing but a scan finds its hits."""
    t = text.strip()
    runs = literal_runs(t) if regex else ([t.lower()] if t else [])
    size = min((PIECE, max(map(len, runs), default=0)))
    wanted = sorted({r[i:i + n] for r in runs for n in [min(size, len(r))] for i in range(len(r) - n + 1)})
    if not wanted:
        return None
    folders = sorted({zlib.crc32(p.encode()) % PIECE_FOLDERS for p in wanted})
    return (index.where(F.col("folder").isin(folders) & F.col("piece").isin(wanted))
                 .groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select("id"))


def search_indexed(df: DataFrame, index: DataFrame, text: str, regex: bool = True) -> DataFrame:
    """``search_customer`` by way of an index: the same hit, found among the
    ids that hold the search's pieces.  The pattern decides on the few ids;
    the table is then asked for one id."""
    ids = search_ids(index, text, regex)
    if ids is None:
        return search_customer(df, text, regex)
    hit = search_customer(ids.select(F.col("id").alias("customer_id")), text, regex).agg(F.min("customer_id")).scalar()
    return df.where(F.col("customer_id") == hit)


def top_n(df: DataFrame, col: str, n: int, key: str = "customer_id") -> DataFrame:
    """N largest by ``col`` (ties by id).  The limit is the feature: a
    TakeOrderedAndProject keeps n rows per task, never the whole table."""
    return df.orderBy(F.desc_nulls_last(col), F.asc(key)).limit(n)


BROWSE_COLUMNS = ["customer_id", "segment", "age", "income", "churn_probability", "predicted_revenue_annual",
                  "clv", "risk_level", "financial_value", "recommended_action", "priority_score",
                  "revenue_at_risk", "engagement_index", "net_profit_per_client", "value_tier"]


def browse(df: DataFrame, risk: str | None = None, urgency: str | None = None, sort_col: str = "priority_score",
           n: int = 50) -> DataFrame:
    """optional risk / urgency filter, then the top n by a measure."""
    v = df
    if risk:
        v = v.where(F.col("risk_level") == risk)
    if urgency and "action_urgency" in v.columns:
        v = v.where(F.col("action_urgency") == urgency)
    cols = [c for c in BROWSE_COLUMNS if c in v.columns]
    return top_n(v, sort_col, n).select(*cols)


def priority_list(df: DataFrame, n: int = 25) -> DataFrame:
    """High-risk customers by priority score."""
    cols = ["customer_id", "segment", "churn_probability", "predicted_revenue_annual", "clv", "revenue_at_risk",
            "risk_level", "financial_value", "recommended_action", "priority_score", "engagement_index",
            "days_since_last_transaction", "action_urgency"]
    return top_n(df.where(_high()), "priority_score", n).select(*[c for c in cols if c in df.columns])


def top_rar(mart: DataFrame, n: int = 50) -> DataFrame:
    """Top customers by revenue at risk."""
    cols = ["customer_id", "revenue_at_risk", "value_tier", "segment_label", "churn_probability_pct", "clv_5yr",
            "net_profit_per_client", "recommended_action", "priority_score"]
    return top_n(mart, "revenue_at_risk", n).select(*cols)


def action_queue(mart: DataFrame, urgencies: Sequence[str] = ("CRITICAL", "HIGH")) -> DataFrame:
    """T4: the call list: urgent actions, 11 columns, priority descending."""
    cols = ["customer_id", "segment_label", "age_band", "region", "churn_probability_pct", "clv_5yr",
            "revenue_at_risk", "engagement_index", "recommended_action", "action_urgency", "priority_score"]
    return mart.where(F.col("action_urgency").isin(list(urgencies))).select(*cols).orderBy(
        F.desc("priority_score"), "customer_id")


def at_level(agg: DataFrame, level: str) -> DataFrame:
    """one aggregation level of the financial aggregates."""
    return agg.where(F.col("aggregation_level") == level)


# -- customer-level views -----------------------------------------------------

def risk_distribution(df: DataFrame) -> DataFrame:
    """V1: customers per risk level and share (2 dp)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    g = df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
    return g.select("risk_level", "count", X.round_ratio(F.col("count") * F.lit(100), total, 2).alias("pct"))


def rar_by_segment_high(df: DataFrame) -> DataFrame:
    """V2: revenue at risk of High-risk customers per segment, ascending."""
    g = df.where(_high() & F.col("segment").isNotNull()).groupBy("segment").agg(
        X.exact_sum("revenue_at_risk", 2).alias("_r"))
    return g.select("segment", X.dround(F.col("_r"), 2).alias("revenue_at_risk")).orderBy("revenue_at_risk", "segment")


def box_stats(df: DataFrame, value: str, by: Sequence[str], grid: int | None, dp: int = 4) -> DataFrame:
    """Min, q1, median, q3, max per group (rounded).

    ``grid`` is the number of decimals of a fixed-precision column (exact
    DECIMAL interpolation); None for a free double column."""
    f = S.five_numbers(df.where(F.col(value).isNotNull()), value, by, False, scale=grid)
    return f.select(*by, "n", *[F.bround(F.col(c), dp).cast("double").alias(c)
                                for c in ["min", "q1", "median", "q3", "max"]])


def histogram_by(df: DataFrame, value: str, bins: int, by: Sequence[str] = ("segment",), dp: int = 6) -> DataFrame:
    """Equal-width histogram over the whole range, per group."""
    h = S.histogram(df, value, bins, by)
    return h.select(*by, "bin", F.bround("bin_start", dp).alias("bin_start"), F.bround("bin_end", dp).alias("bin_end"),
                    "count")


def segment_summary(df: DataFrame) -> DataFrame:
    """V9: eight measures per segment, churn % and RAR % (1 dp)."""
    g = df.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        X.exact_sum("churn_probability", 4).alias("_p"), F.count("churn_probability").alias("_np"),
        X.count_if(_high()).alias("high_risk"),
        X.exact_sum("predicted_revenue_annual", 2).alias("_rev"),
        X.exact_sum("clv", 2).alias("_clv"), F.count("clv").alias("_nclv"),
        X.exact_sum("revenue_at_risk", 2).alias("_rar"),
        X.exact_sum("net_profit_per_client", 2).alias("_np2"))
    return g.select(
        "segment", "customers", X.round_avg(F.col("_p"), F.col("_np"), 4, 4).alias("avg_churn"), "high_risk",
        X.dround(F.col("_rev"), 2).alias("total_revenue"), X.round_avg(F.col("_clv"), F.col("_nclv"), 2, 2).alias("avg_clv"),
        X.dround(F.col("_clv"), 2).alias("total_clv"), X.dround(F.col("_rar"), 2).alias("revenue_at_risk"),
        X.dround(F.col("_np2"), 2).alias("net_profit"),
        X.round_ratio(F.col("high_risk") * F.lit(100), F.col("customers"), 1).alias("churn_rate_pct"),
        X.round_pct(F.col("_rar"), F.col("_rev"), 2, 1).alias("rar_pct"))


def streak_analysis(df: DataFrame, max_streak: int = 12) -> DataFrame:
    """V11 (F8): customers and mean churn by inactivity streak <= 12."""
    g = df.groupBy("inactivity_streak").agg(F.count("customer_id").alias("n_customers"),
                                            X.exact_sum("churn_probability", 4).alias("_p"),
                                            F.count("churn_probability").alias("_n"))
    return g.where(F.col("inactivity_streak") <= max_streak).select(
        "inactivity_streak", "n_customers", X.round_avg(F.col("_p"), F.col("_n"), 4, 4).alias("avg_churn"))


def counts_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Customer counts per combination."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond).groupBy(*cols).agg(F.count("customer_id").alias("count"))


def priority_heatmap(df: DataFrame) -> DataFrame:
    """Mean priority for all nine risk x value cells (null if empty).

    The nine cells are a fixed 9-row literal table; the means are joined to
    it, so empty cells stay null."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(r, v) for r in C.LEVELS for v in C.LEVELS], "risk_level string, financial_value string")
    g = df.groupBy("risk_level", "financial_value").agg(X.exact_sum("priority_score", 4).alias("_s"),
                                                         F.count("priority_score").alias("_n"))
    return grid.join(g, ["risk_level", "financial_value"], "left").select(
        "risk_level", "financial_value", X.round_avg(F.col("_s"), F.col("_n"), 4, 4).alias("avg_priority"))


def executive_cards(df: DataFrame) -> DataFrame:
    """The seven cards on a (filtered) customer view."""
    g = df.agg(X.exact_sum("predicted_revenue_annual", 2).alias("_rev"), X.exact_sum("revenue_at_risk", 2).alias("_rar"),
               F.count(F.lit(1)).alias("_n"), X.count_if(_high()).alias("_hr"), X.exact_sum("clv", 2).alias("_clv"),
               X.count_if(_high() & (F.col("financial_value") == "High")).alias("critical_accounts"),
               X.exact_sum("net_profit_per_client", 2).alias("_np"))
    return g.select(
        X.dround(F.col("_rev"), 2).alias("total_revenue"), X.dround(F.col("_rar"), 2).alias("revenue_at_risk"),
        F.coalesce(X.round_pct(F.col("_rar"), F.col("_rev"), 2, 1), F.lit(0.0)).alias("rar_pct"),
        X.round_ratio(F.col("_hr") * F.lit(100), F.col("_n"), 1).alias("churn_rate_pct"),
        X.dround(F.col("_clv"), 2).alias("total_clv"), "critical_accounts",
        X.dround(F.col("_np"), 2).alias("net_profit"))


def roi_scenarios(df: DataFrame, rates: Sequence[float] = (50.0,), costs: Sequence[float] = (500.0,)) -> DataFrame:
    """Retention ROI for a grid of success rates (%) and unit costs.

    saved = RAR * rate / 100, cost = High count * unit cost, net, ratio
    (0 when cost is 0).  The portfolio totals are one row; the scenario grid
    is a small literal table."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(float(r), float(c)) for r in rates for c in costs],
                                 "success_rate_pct double, cost_per_customer double")
    tot = df.agg(X.exact_sum("revenue_at_risk", 2).alias("_rar"), X.count_if(_high()).alias("_hr"))
    sc = S.scalars(tot)
    rar, hr = sc["_rar"], sc["_hr"]
    saved = X.dround(rar * F.col("success_rate_pct").cast("decimal(10,4)") / F.lit(100), 2)
    cost = X.dround(hr.cast("decimal(20,0)") * F.col("cost_per_customer").cast("decimal(14,2)"), 2)
    out = grid.select("success_rate_pct", "cost_per_customer", saved.alias("revenue_saved"),
                      cost.alias("programme_cost"))
    return out.select("*", F.bround(F.col("revenue_saved") - F.col("programme_cost"), 2).alias("net_roi"),
                      F.when(F.col("programme_cost") > 0, F.bround(F.col("revenue_saved") / F.col("programme_cost"), 4))
                      .otherwise(F.lit(0.0)).alias("roi_ratio"))


def roi_waterfall(df: DataFrame, rate: float = 50.0, cost: float = 500.0) -> DataFrame:
    """Four ordered steps: RAR, saved, -cost, net."""
    r = roi_scenarios(df, [rate], [cost])
    rar = df.agg(X.exact_sum("revenue_at_risk", 2)).scalar()
    j = r.withColumn("_rar", rar)
    return j.select(F.expr("""stack(4,
        1, 'Revenue at Risk', cast(_rar as double),
        2, 'Revenue Saved', revenue_saved,
        3, 'Programme Cost', -programme_cost,
        4, 'Net ROI', net_roi) as (step, label, amount)"""))


def churn_histogram_5pt(mart: DataFrame) -> DataFrame:
    """Churn % in 5-point bins by segment."""
    b = (F.floor(F.col("churn_probability_pct") / F.lit(5.0)) * 5).cast("int")
    return mart.groupBy("segment", b.alias("bin_start_pct")).agg(F.count("customer_id").alias("count"))


def streak_bucket_expr() -> Column:
    s = F.col("inactivity_streak")
    return (F.when(s == 0, "0").when(s <= 3, "1-3").when(s <= 6, "4-6").when(s <= 12, "7-12").otherwise("12+"))


def churn_by_streak_bucket(mart: DataFrame) -> DataFrame:
    """Churn % five-number summary per streak bucket and segment."""
    df = mart.withColumn("streak_bucket", streak_bucket_expr())
    return box_stats(df, "churn_probability_pct", ["streak_bucket", "segment"], grid=1, dp=2)


def quadrant_expr(clv_p75: Column, churn_line: float = 65.0) -> Column:
    hi_r = F.col("churn_probability_pct") >= churn_line
    hi_v = F.col("clv_5yr") >= clv_p75
    return (F.when(hi_r & hi_v, "CRITICAL").when(~hi_r & hi_v, "NURTURE").when(hi_r & ~hi_v, "MONITOR")
            .otherwise("STABLE"))


def risk_value_quadrant(mart: DataFrame) -> DataFrame:
    """Fixed 65 % churn line x CLV p75 -> four quadrant counts."""
    p75 = S.scalars(S.quantile_row(mart, "clv_5yr", {"p75": 0.75}))["p75"]
    return mart.withColumn("quadrant", quadrant_expr(p75)).groupBy("quadrant").agg(
        F.count("customer_id").alias("count"))


def loss_waterfall(agg: DataFrame) -> DataFrame:
    """Per segment: total revenue, revenue at risk, protected revenue."""
    s = at_level(agg, "by_segment")
    return s.select("segment", "total_revenue", "total_revenue_at_risk",
                    F.bround(F.col("total_revenue") - F.col("total_revenue_at_risk"), 2).alias("protected_revenue"))


def rar_by_segment_risk(agg: DataFrame) -> DataFrame:
    """V29."""
    return at_level(agg, "by_segment_risk").select("segment", "risk_level", "total_revenue_at_risk")


def region_risk_map(agg: DataFrame) -> DataFrame:
    """V30."""
    return at_level(agg, "by_region").select("region", "avg_churn_probability", "n_customers")


def profitability_heatmap(agg: DataFrame) -> DataFrame:
    """V6: segment x region profitability ratio (1 dp), missing cells 0.

    Every segment gets every region of that level (the heat-map grid): the
    regions are one sorted array value (a scalar subquery, bounded by the
    number of regions) exploded on each segment row, then the ratios are
    left-joined; empty cells are 0."""
    sr = at_level(agg, "by_segment_region").select("segment", "region", "profitability_ratio")
    regions = sr.agg(F.array_sort(F.collect_set("region"))).scalar()
    grid = sr.select("segment").distinct().select("segment", F.explode(regions).alias("region"))
    j = grid.join(sr, ["segment", "region"], "left")
    return j.select("segment", "region",
                    F.bround(F.coalesce(F.col("profitability_ratio"), F.lit(0.0)), 1).alias("profitability_ratio"))


def profitability_table(agg: DataFrame) -> DataFrame:
    """Total profit and ratio per segment x region."""
    return at_level(agg, "by_segment_region").select("segment", "region", "total_net_profit", "profitability_ratio")


def churn_bullet(agg: DataFrame, target_pct: float = 12.0) -> DataFrame:
    """Segment revenue and churn rate against a 12 % target."""
    return at_level(agg, "by_segment").select(
        "segment", "total_revenue", "churn_rate_pct",
        F.bround(F.col("churn_rate_pct") - F.lit(target_pct), 2).alias("gap_to_target_pct"))


def action_donut(mart: DataFrame) -> DataFrame:
    """Customers per action with its urgency."""
    return mart.groupBy("recommended_action", "action_urgency").agg(F.count("customer_id").alias("count"))


def margin_by_segment_month(ts: DataFrame, agg: DataFrame) -> DataFrame:
    """V33 (J9): every month x every segment with the segment's
    profitability ratio.  The segment level (one row per segment) is one
    array value (scalar subquery) exploded on each month row - no join."""
    seg = at_level(agg, "by_segment")
    arr = seg.agg(F.collect_list(F.struct("segment", "profitability_ratio"))).scalar()
    return ts.select("calendar_ym", "calendar_date", F.explode(arr).alias("_s")).select(
        "calendar_ym", "calendar_date", "_s.segment", "_s.profitability_ratio")


def cumulative_rar(ts: DataFrame) -> DataFrame:
    """W5 (D3-C5): running sum of monthly revenue at risk (one row per month)."""
    from pyspark.sql import Window
    w = Window.orderBy("calendar_ym").rowsBetween(Window.unboundedPreceding, 0)
    return ts.select("calendar_ym", "monthly_revenue_at_risk",
                     F.bround(F.sum(X.dec("monthly_revenue_at_risk", 4)).over(w).cast("double"), 4)
                     .alias("cumulative_revenue_at_risk"))


def kpi_cards(agg: DataFrame) -> DataFrame:
    """V34 (P16, P17): six executive cards with value, text and colour."""
    t = at_level(agg, "total")
    rar_pct = F.col("revenue_at_risk_pct")
    churn = F.col("churn_rate_pct")
    cards = F.array(*[F.struct(F.lit(label).alias("label"), F.col(measure).cast("double").alias("value"), F.lit(rule).alias("rule"))
                      for label, measure, rule in C.KPI_CARDS])
    return t.select(F.inline(cards),
                    rar_pct.alias("_rar_pct"), churn.alias("_churn")).select(
        "label", "value",
        F.when(F.col("label").isin("Portfolio Churn Rate"), X.format_pct(X.dround(X.dec("value", 2), 1), 1))
         .when(F.col("label") == "Critical Accounts", F.format_number(F.col("value"), 0))
         .otherwise(X.format_money("value")).alias("value_formatted"),
        F.when(F.col("rule") == "rar", F.when(F.col("_rar_pct") > 5, "red").when(F.col("_rar_pct") >= 3, "amber")
               .otherwise("green"))
         .when(F.col("rule") == "churn", F.when(F.col("_churn") > 25, "red").when(F.col("_churn") >= 15, "amber")
               .otherwise("green"))
         .when(F.col("rule") == "profit", F.when(F.col("value") < 0, "red").otherwise("green"))
         .when(F.col("rule") == "static blue", "blue").when(F.col("rule") == "static green", "green")
         .otherwise("red").alias("color"),
        F.when(F.col("rule") == "rar", F.concat(F.lit("("), X.format_pct(X.dround(X.dec("_rar_pct", 2), 1), 1),
                                                 F.lit(" of total revenue)")))
         .when(F.col("label") == "Critical Accounts", F.lit("High-value + High-risk")).alias("sub_label"))


def samples(df: DataFrame, n: int, seed: int, cols: Sequence[str]) -> DataFrame:
    """V5/V18/V19/V32 (T7): deterministic point samples for scatter plots."""
    return S.stable_sample(df.select(*cols), n, seed)


def low_engagement_cards(enr: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Average engagement, low-engagement count / %, correlation."""
    from .kpis import kpi_engagement
    return kpi_engagement(enr, params).where(F.col("dimension") == "total").drop("dimension", "key")


def trend_cards(ts: DataFrame) -> DataFrame:
    """24-month revenue total, monthly mean, peak month and 6-month slope."""
    from .kpis import kpi_time_series
    tot = ts.agg(X.exact_sum("estimated_monthly_revenue", 2).alias("_t"))
    k = kpi_time_series(ts).select("avg_monthly_revenue", "peak_revenue_month", "peak_monthly_revenue",
                                   "revenue_trend_6m_slope", "revenue_trend_direction")
    return k.select(X.dround(tot.select("_t").scalar(), 2).alias("total_revenue_24m"), "*")
