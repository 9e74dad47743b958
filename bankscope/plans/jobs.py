"""The two batch jobs (G1 scoring, G2 marts) as Spark plans with sinks.

Each job reads its inputs, builds the stages (materialised in the shared
checkpoint folder), writes its outputs and returns ``{name: path}``.  No
result passes through the driver: reports are one-row DataFrames written
as JSON by Spark.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_CALENDAR, DEFAULT_PARAMS, Calendar, Params
from ..operators import decision as D
from ..operators import enrich as E
from ..operators import kpis as K
from ..operators import marts as M
from ..operators import models as MD
from ..operators import scoring as SC
from ..operators import txfeatures as TXF
from ..operators import views as V
from ..sources import sinks
from ..sources.stages import materialize


def _report(parts: dict[str, DataFrame]) -> DataFrame:
    """One row: each part as an array of structs (one scalar subquery per part)."""
    from ..functions.stats import one_row
    spark = next(iter(parts.values())).sparkSession
    return one_row(spark, {name: df.agg(F.collect_list(F.struct(*df.columns))).scalar()
                           for name, df in parts.items()})


def train_model(spark: SparkSession, kind: str, matrix: DataFrame, model_dir: str, params: Params = DEFAULT_PARAMS,
                max_iter: int = MD.N_TREES, retrain: bool = False) -> MD.Model:
    """The churn or revenue model of its feature matrix, loaded from
    ``model_dir`` or trained and saved there."""
    path = f"{model_dir.rstrip('/')}/{kind}"

    def train() -> MD.Model:
        rows = MD.split(matrix, "churn_label" if kind == "churn" else None, seed=params.seed)[0]
        return (MD.fit_churn if kind == "churn" else MD.fit_revenue)(rows, params, max_iter)

    if not retrain:
        return MD.load_or_train(path, train, spark=spark)
    m = train()
    MD.save_model(m, path, spark)
    return m


def train_models(spark: SparkSession, churn: DataFrame, revenue: DataFrame, model_dir: str, params: Params = DEFAULT_PARAMS,
                 max_iter: int = MD.N_TREES, retrain: bool = False) -> tuple[MD.Model, MD.Model]:
    """Both models of the feature matrices, loaded from ``model_dir`` or
    trained and saved there.  They are trained at the same time: their passes
    are short, so one alone leaves a cluster mostly idle."""
    fits = [("churn", churn), ("revenue", revenue)]
    with ThreadPoolExecutor(len(fits)) as pool:
        return tuple(pool.map(inheritable_thread_target(lambda f: train_model(spark, *f, model_dir, params, max_iter, retrain)), fits))


def run_scoring_job(spark: SparkSession, customers: DataFrame, transactions: DataFrame, out_dir: str,
                    use_models: bool = False, model_dir: str | None = None, retrain: bool = False,
                    cal: Calendar = DEFAULT_CALENDAR, params: Params = DEFAULT_PARAMS,
                    max_iter: int = MD.N_TREES) -> dict[str, str]:
    """G1: features -> churn and revenue predictions -> scoring table ->
    recommendations -> portfolio metrics.

    ``use_models`` scores with boosted trees (loaded from ``model_dir`` or
    trained and saved there; ``retrain`` forces training); otherwise the
    deterministic scorer is used.
    """
    base = out_dir.rstrip("/")
    if use_models:
        activity = materialize(TXF.customer_totals(transactions), "totals")
        cf = materialize(MD.churn_features(customers, None, cal, params, activity), "churn-matrix")
        rf = materialize(MD.revenue_features(customers, None, cal, params, activity), "revenue-matrix")
        cm, rm = train_models(spark, cf, rf, model_dir or f"{base}/models", params, max_iter, retrain)
        scoring = SC.scoring_table(customers, MD.score_churn(cm, cf), MD.score_revenue(rm, rf), params)
    else:
        scoring = SC.add_value_score(materialize(SC.exact_scoring_base(customers, transactions, cal, params), "scoring"))

    def write(name: str, df: DataFrame) -> DataFrame:
        """Write an output once; what follows reads the file."""
        paths[name] = sinks.write_parquet(df, f"{base}/{name}.parquet")
        return spark.read.schema(df.schema).parquet(paths[name])

    paths: dict[str, str] = {}
    rec = write("recommendations", D.apply_recommendations(write("scoring_table", scoring), params))
    segments = write("segment_breakdown", K.segment_breakdown(rec))
    report = _report({"portfolio": K.portfolio_metrics(rec), "segment_breakdown": segments,
                      "action_distribution": K.action_distribution(rec)})
    paths["business_metrics"] = sinks.write_report(report, f"{base}/business_metrics.json")
    return paths


def run_mart_job(spark: SparkSession, recommendations: DataFrame, transactions: DataFrame, out_dir: str,
                 cal: Calendar = DEFAULT_CALENDAR, params: Params = DEFAULT_PARAMS, clusters: str = "kmeans") -> dict[str, str]:
    """Enrichment -> risk clusters -> customer mart, financial aggregates,
    time series -> KPI report -> export as Parquet + CSV -> dashboard cards.

    ``clusters``: "kmeans" (M14) or "tercile" (M16), the bands to fall back on
    where clustering is not wanted.  Every table is written once; the exports
    and reports read the written files."""
    base = out_dir.rstrip("/")
    if clusters not in ("kmeans", "tercile"):
        raise ValueError("clusters: kmeans or tercile")
    enriched = E.enrich(recommendations, transactions, cal, params)
    if clusters == "kmeans":
        bands = materialize(enriched, "enriched")
        enriched = E.with_risk_cluster(bands, MD.risk_cluster_assignments(bands, seed=params.seed))
    paths = {"enriched": sinks.write_parquet(enriched, f"{base}/enriched_customers.parquet")}
    enriched = spark.read.schema(enriched.schema).parquet(paths["enriched"])
    marts = {"customer_table": M.customer_mart(enriched, params), "financial_aggregates": M.financial_aggregates(enriched),
             "time_series": M.time_series(transactions, enriched, cal, params)}
    paths.update(sinks.export_marts(marts, f"{base}/marts"))
    fa, ts = (spark.read.schema(marts[n].schema).parquet(paths[f"{n}_parquet"]) for n in ("financial_aggregates", "time_series"))
    paths["kpi_report"] = sinks.write_report(K.kpi_report(enriched, ts, params), f"{base}/kpis/kpi_report.json")
    paths["dashboard_cards"] = sinks.write_report(_report({"kpi_cards": V.kpi_cards(fa)}),
                                                  f"{base}/specs/dashboard_cards.json")
    return paths
