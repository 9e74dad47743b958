"""Churn and revenue models, risk clusters (M1-M16, S13) with MLlib.

Splits take, of each class, the fifth of the customers whose seeded hash
ranks lowest: the same ones on any partitioning, and of every class.  The
feature matrix is written once; split, fit, evaluation and scoring read it.
Trees draw their rows and columns per tree (``operators.boosting``); MLlib's,
which draw columns per node, can be asked for.  All starts of the clusters
advance together (``operators.clusters``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_CALENDAR, DEFAULT_PARAMS, Calendar, Params
from ..functions import exprs as X
from ..functions import stats as S
from ..sources.stages import exists, materialize
from . import boosting as B
from . import clusters as K
from . import enrich as E
from . import txfeatures as TXF

# Fixed values that must equal the original's: feature names and order, segment
# flags, and the trees' parameters.
CHURN_FEATURES = ["age", "income", "account_balance", "tenure_months", "tx_count", "tx_avg_amount",
                  "tx_std_amount", "tx_recency_days", "online_ratio", "atm_ratio",
                  "segment_retail", "segment_premium", "segment_hnw"]
REVENUE_FEATURES = ["age", "income", "account_balance", "tenure_months", "tx_count", "tx_avg_amount",
                    "tx_total_volume", "online_ratio", "segment_retail", "segment_premium", "segment_hnw"]
SEGMENT_FLAGS = [("retail", "segment_retail"), ("premium", "segment_premium"), ("high_net_worth", "segment_hnw")]
N_TREES = 300
TREES = {"depth": 6, "rate": 0.05, "row_share": 0.8, "column_share": 0.8}
_MLLIB = {"maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
TEST_SHARE = 0.2


#: Missing personal data counts as 0, as every other missing feature.
PERSON_FILL = {"age": 0, "income": 0.0, "account_balance": 0.0, "tenure_months": 0}


def _flags() -> list[Column]:
    return X.one_hot("segment", [v for v, _ in SEGMENT_FLAGS], [n for _, n in SEGMENT_FLAGS])


def churn_features(customers: DataFrame, tx: DataFrame | None, cal: Calendar = DEFAULT_CALENDAR,
                   params: Params = DEFAULT_PARAMS, activity: DataFrame | None = None) -> DataFrame:
    """M1 + M2 (J1, P1, P3): 13 features, label = churn score > 0.65."""
    agg = TXF.churn_tx_features(tx, cal, activity).drop("last_tx_date")
    j = customers.join(agg, "customer_id", "left")
    fills = {"tx_count": 0, "tx_avg_amount": 0.0, "tx_std_amount": 0.0, "tx_recency_days": 365,
             "online_ratio": 0.5, "atm_ratio": 0.3}
    return j.fillna({**fills, **PERSON_FILL}).select(
        "customer_id", "age", "income", "account_balance", "tenure_months", "tx_count", "tx_avg_amount",
        "tx_std_amount", "tx_recency_days", "online_ratio", "atm_ratio", *_flags(),
        F.coalesce((F.col("churn_risk_score") > params.churn_label_cut).cast("int"), F.lit(0)).alias("churn_label"))


def revenue_features(customers: DataFrame, tx: DataFrame | None, cal: Calendar = DEFAULT_CALENDAR,
                     params: Params = DEFAULT_PARAMS, activity: DataFrame | None = None) -> DataFrame:
    """M7 + M8: 11 features and the revenue target (0 without transactions).
    ``activity``: as for ``churn_features``."""
    from .scoring import revenue_target_expr
    act = activity.where(F.col("customer_id").isNotNull()) if activity is not None else TXF.customer_totals(tx.where(F.col("customer_id").isNotNull()))
    online = F.when(F.col("n_chan") > 0, F.col("n_online").cast("double") / F.when(
        (F.col("n_online") + F.col("n_atm") + F.col("n_branch")) == 0, F.lit(1)).otherwise(
        F.col("n_online") + F.col("n_atm") + F.col("n_branch")).cast("double"))
    a = act.select("customer_id", F.col("n_tx").alias("tx_count"),
                   X.safe_ratio(F.col("amt_total"), F.col("n_amt")).alias("tx_avg_amount"),
                   F.col("amt_total").cast("double").alias("tx_total_volume"),
                   F.coalesce(online, F.lit(0.5)).alias("online_ratio"),
                   revenue_target_expr(F.col("amt_total"), params, cal).alias("revenue_target"))
    j = customers.join(a, "customer_id", "left").fillna(
        {"tx_count": 0, "tx_avg_amount": 0.0, "tx_total_volume": 0.0, "online_ratio": 0.0, "revenue_target": 0.0, **PERSON_FILL})
    return j.select("customer_id", "age", "income", "account_balance", "tenure_months", "tx_count",
                    "tx_avg_amount", "tx_total_volume", "online_ratio", *_flags(), "revenue_target")


def split(df: DataFrame, label: str | None = None, share: float = TEST_SHARE, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M3 / M9: deterministic train and test rows.

    Of each class of ``label`` (of all rows without one) the ceil(share * n)
    customers whose MD5 of id and seed ranks lowest are for the test.  The
    rank's threshold is an exact order statistic of the hash: no class is
    sorted in one task.  A null label is a class."""
    h = F.conv(F.substring(F.md5(F.concat(F.col("customer_id").cast("string"), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double")
    d = df.withColumn("_u", h)
    by = [label] if label else []
    cut = S.lowest(d, "_u", share, by)
    if by:
        d = d.join(cut.withColumnRenamed(label, "_class"), F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")
    else:
        d = d.withColumn("_t", S.scalars(cut)["_t"])
    test = F.coalesce(F.col("_u") <= F.col("_t"), F.lit(False))
    return d.where(~test).drop("_u", "_t"), d.where(test).drop("_u", "_t")


def _assembled(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


Model = B.TreeModel | PipelineModel


def fit_churn(train: DataFrame, params: Params = DEFAULT_PARAMS, max_iter: int = N_TREES, per_tree: bool = True) -> Model:
    """M4: gradient-boosted trees (300 trees, depth 6, rate 0.05, row and
    column sampling 0.8 per tree; ``per_tree`` off: MLlib's)."""
    if per_tree:
        return B.fit(train, CHURN_FEATURES, "churn_label", B.Settings("logistic", max_iter, seed=params.seed, **TREES))
    gbt = GBTClassifier(labelCol="churn_label", featuresCol="features", maxIter=max_iter, seed=params.seed, **_MLLIB)
    return Pipeline(stages=[_assembled(CHURN_FEATURES), gbt]).fit(train)


def churn_probability(model: Model, features: DataFrame) -> DataFrame:
    """``features`` with the unrounded probability of class 1 as ``probability_1``."""
    if isinstance(model, B.TreeModel):
        return model.transform(features, "probability_1")
    return model.transform(features).select(*features.columns, vector_to_array("probability")[1].alias("probability_1"))


def score_churn(model: Model, features: DataFrame) -> DataFrame:
    """M6: P(class 1), 4 dp."""
    return churn_probability(model, features).select("customer_id", F.bround("probability_1", 4).alias("churn_probability"))


def churn_quality(model: Model, test: DataFrame) -> DataFrame:
    """M5: one row n, n_positive, auc (exact) of held-out rows."""
    return S.auc(churn_probability(model, test), "probability_1", "churn_label")


def churn_model_report(customers: DataFrame, tx: DataFrame, params: Params = DEFAULT_PARAMS,
                       max_iter: int = N_TREES, per_tree: bool = True) -> DataFrame:
    """M3-M6: split, fit, hold-out AUC, scores for every customer."""
    feats = materialize(churn_features(customers, tx, params=params), "churn-matrix")
    train, test = split(feats, "churn_label", seed=params.seed)
    model = fit_churn(train, params, max_iter, per_tree)
    return score_churn(model, feats).withColumn("holdout_auc", F.lit(churn_quality(model, test).first()["auc"]).cast("double"))


def fit_revenue(train: DataFrame, params: Params = DEFAULT_PARAMS, max_iter: int = N_TREES, per_tree: bool = True) -> Model:
    """Gradient-boosted regression trees, same hyper-parameters."""
    if per_tree:
        return B.fit(train, REVENUE_FEATURES, "revenue_target", B.Settings("squared", max_iter, seed=params.seed, **TREES))
    gbt = GBTRegressor(labelCol="revenue_target", featuresCol="features", maxIter=max_iter, seed=params.seed, **_MLLIB)
    return Pipeline(stages=[_assembled(REVENUE_FEATURES), gbt]).fit(train)


def _revenue(model: Model, features: DataFrame) -> DataFrame:
    return model.transform(features).withColumn(
        "predicted_revenue_annual", F.bround(F.greatest(F.col("prediction"), F.lit(0.0)), 2)).drop("prediction")


def score_revenue(model: Model, features: DataFrame) -> DataFrame:
    """Prediction clipped at 0, 2 dp."""
    return _revenue(model, features).select("customer_id", "predicted_revenue_annual")


def revenue_quality(model: Model, test: DataFrame) -> DataFrame:
    """One row n, r2, mae (from exact sums of cents) of held-out rows."""
    return S.fit_quality(_revenue(model, test), "predicted_revenue_annual", "revenue_target")


def revenue_model_report(customers: DataFrame, tx: DataFrame, params: Params = DEFAULT_PARAMS,
                         max_iter: int = N_TREES, per_tree: bool = True) -> DataFrame:
    """Split, fit, R2 and MAE on the hold-out, scores."""
    feats = materialize(revenue_features(customers, tx, params=params), "revenue-matrix")
    train, test = split(feats, seed=params.seed)
    model = fit_revenue(train, params, max_iter, per_tree)
    q = revenue_quality(model, test).first()
    return score_revenue(model, feats).withColumns({"holdout_r2": F.lit(q["r2"]).cast("double"), "holdout_mae": F.lit(q["mae"]).cast("double")})


def save_model(model: Model, path: str, spark: SparkSession | None = None) -> str:
    """Persist a fitted model (overwrite)."""
    if isinstance(model, B.TreeModel):
        return model.save(spark or SparkSession.getActiveSession(), path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str, spark: SparkSession | None = None) -> Model:
    spark = spark or SparkSession.getActiveSession()
    return PipelineModel.load(path) if exists(spark, f"{path}/stages") else B.TreeModel.load(spark, path)


def load_or_train(path: str, train_fn, *args, spark: SparkSession | None = None, **kwargs) -> Model:
    """Load a saved model, or train and save it where none is; one
    that is there but cannot be read is an error."""
    if exists(spark or SparkSession.getActiveSession(), path):
        return load_model(path, spark)
    model = train_fn(*args, **kwargs)
    save_model(model, path, spark)
    return model


def risk_cluster_assignments(enriched: DataFrame, k: int = 3, n_init: int = 10, seed: int = 42) -> DataFrame:
    """KMeans (k = 3, best of 10 seeded starts by cost) on min-max
    scaled churn, net profit and engagement; clusters named low / medium /
    high by ascending mean churn probability.  The scaled points are written
    once; all starts share each scan of them."""
    return risk_clusters(enriched, k, n_init, seed)[0]


def risk_clusters(enriched: DataFrame, k: int = 3, n_init: int = 10, seed: int = 42) -> tuple[DataFrame, float]:
    """``risk_cluster_assignments`` and their cost (squared distances)."""
    cols = ["churn_probability", "net_profit_per_client", "engagement_index"]
    scaled = E.minmax_scaled(enriched, cols, keep=["churn_probability"])
    data = materialize(scaled.select("customer_id", "churn_probability", *[f"{c}_scaled" for c in cols]), "clustering")
    pred, cost = K.kmeans(data, [f"{c}_scaled" for c in cols], k, n_init, seed)
    means = sorted((r.m if r.m is not None else 0.0, r.cluster) for r in  # k rows
                   pred.groupBy("cluster").agg(F.avg("churn_probability").alias("m")).collect())
    names = {c: C.CLUSTER_NAMES[i] for i, (_, c) in enumerate(means)}
    return pred.select("customer_id", X.map_values("cluster", names).alias("risk_cluster")), cost
