"""Stage plans of the two jobs, with lineage cut at stage boundaries.

The scoring job (G1) and the mart job (G2) are chains of stages; every
stage output that later stages read many times (scoring table,
recommendations, enriched table) is written once as Parquet in the cluster's
checkpoint folder (``spark.checkpoint.dir``) and read back.  This keeps
each stage's plan - and the scalar subqueries that carry whole-table
thresholds - small, survives executor loss (the checkpoint is on shared
storage, not on executors) and stops later stages from recomputing the
transaction roll-up.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_CALENDAR, DEFAULT_PARAMS, Calendar, Params
from ..operators import decision as D
from ..operators import enrich as E
from ..operators import marts as M
from ..operators import scoring as SC
from ..operators import txfeatures as TXF
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources.stages import delete, materialize, materialize_bucketed, release


class Stages:
    """The pipeline's stages for one fixture directory, built on first use.

    ``scoring`` (one customers LEFT JOIN transaction roll-up, carrying the
    churn score, both predictions and the nine behavioural features),
    ``recommendations`` and ``enriched`` are each written once to the
    checkpoint folder when first needed; a query that only needs the scoring
    table never builds the later stages.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cal: Calendar, params: Params):
        self.spark, self.sf_dir, self.cal, self.params = spark, sf_dir, cal, params
        self.customers = FX.customers(spark, sf_dir, cal)
        self.transactions = FX.transactions(spark, sf_dir, cal)
        self.transactions_with_segment = FX.transactions_with_segment(spark, sf_dir, cal)

    @cached_property
    def _base(self) -> DataFrame:
        cal, params = self.cal, self.params
        # the transactions are scanned once: the churn score (last order) comes
        # from the same roll-up as the predictions and features
        return materialize(SC.exact_scoring_base(
            FX.customers(self.spark, self.sf_dir, cal, with_score=False), None, cal, params, keep_features=True,
            churn_score_from_last=lambda last: FX.churn_score_expr(last, cal), cells=self.cells), "scoring")

    @cached_property
    def _rec(self) -> DataFrame:
        return materialize(D.apply_recommendations(SC.add_value_score(self._base), self.params), "recommendations")

    @property
    def scoring(self) -> DataFrame:
        return SC.add_value_score(self._base).select(*SC.SCORING_COLUMNS)

    @property
    def recommendations(self) -> DataFrame:
        return self._rec.select(*D.REC_COLUMNS)

    @cached_property
    def enriched(self) -> DataFrame:
        return materialize(E.enrich_from(self._rec, self.params), "enriched")

    @cached_property
    def time_series(self) -> DataFrame:
        """One row per month; the KPIs and views over it read this stage."""
        return materialize(M.time_series(None, E.financial_features(self.recommendations), self.cal, self.params,
                                         cells=M.cells_of(self.cells)), "time-series")

    @cached_property
    def totals(self) -> DataFrame:
        """The customers' sums of their transactions, those of a customer with
        several rows as often as it has rows, and the row for unknown customers."""
        copies = FX.table(self.spark, self.sf_dir, "customer").groupBy(F.col("c_custkey").cast("string").alias("customer_id")).agg(F.count("*").alias("_copies"))
        return materialize(TXF.repeated(TXF.customer_totals(self.transactions).join(copies, "customer_id", "left"), "_copies"), "totals")

    @cached_property
    def cells(self) -> DataFrame:
        """(customer, month) cells of the transactions: the only stage that
        reads them; features, scores and the monthly series build on it.
        Bucketed by customer: the roll-up per customer and the joins of cells
        to customers move no cell again."""
        return materialize_bucketed(TXF.month_cells(self.transactions_with_segment, self.cal), "cells", "customer_id")


    @cached_property
    def churn_matrix(self) -> DataFrame:
        """Feature matrix of the churn model."""
        from ..operators import models as MD
        last = self.totals.select("customer_id", F.col("last_ts").alias("_last"))
        cust = FX.customers(self.spark, self.sf_dir, self.cal, with_score=False).join(last, "customer_id", "left")
        churn = MD.churn_features(cust.withColumn("churn_risk_score", FX.churn_score_expr(F.col("_last"), self.cal)), None, self.cal, self.params, self.totals)
        return materialize(churn, "churn-matrix")

    @cached_property
    def revenue_matrix(self) -> DataFrame:
        """Feature matrix of the revenue model, from the transactions as they
        are: with segments, those of a customer with several rows would repeat."""
        from ..operators import models as MD
        revenue = MD.revenue_features(FX.customers(self.spark, self.sf_dir, self.cal, with_score=False), self.transactions, self.cal, self.params)
        return materialize(revenue, "revenue-matrix")

    @cached_property
    def _models(self) -> str:
        return f"{checkpoint_dir(self.spark).rstrip('/')}/bankscope-models-{uuid.uuid4().hex}"

    def model(self, kind: str):
        """The churn or the revenue model, trained once for all queries that use it."""
        from .jobs import train_model
        return train_model(self.spark, kind, self.churn_matrix if kind == "churn" else self.revenue_matrix, self._models, self.params)

    @cached_property
    def model_dir(self) -> str:
        """Folder of both models; those not trained yet are trained at the same time."""
        from .jobs import train_models
        train_models(self.spark, self.churn_matrix, self.revenue_matrix, self._models, self.params)
        return self._models


_CACHE: dict = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files: changed inputs give new stages."""
    out = []
    for t in ("customer", "orders", "nation", "region"):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        out += [(f.getPath().toString(), f.getLen(), f.getModificationTime())
                for f in (fs.listStatus(p) if fs.exists(p) else [])]
    return tuple(out)


def fixture_stages(spark: SparkSession, sf_dir: str, cal: Calendar = DEFAULT_CALENDAR,
                   params: Params = DEFAULT_PARAMS, reuse: bool = True) -> Stages:
    """Stages of the deterministic-scorer pipeline over a fixture directory
    (tercile risk clusters).  Within one session they are shared by every
    query on the same directory and parameters.
    """
    key = (sf_dir.rstrip("/"), _stamp(spark, sf_dir), repr(cal), repr(params))
    hit = _CACHE.get(key)
    if reuse and hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    st = Stages(spark, sf_dir, cal, params)
    if reuse:
        _CACHE[key] = (spark, st)
    return st


def clear_cache() -> None:
    """Forget the stages and delete their files (each call rebuilds from the
    raw tables)."""
    for spark, st in _CACHE.values():
        if spark.sparkContext._jsc is not None:
            for name in ("cells", "_base", "_rec", "enriched", "time_series", "totals", "churn_matrix", "revenue_matrix"):
                if name in st.__dict__:
                    release(st.__dict__[name])
            if "_models" in st.__dict__:
                delete(spark, st._models)
    _CACHE.clear()
