"""Jobs G1/G2 and sinks: outputs written once, readable, complete."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from bankscope.plans.jobs import run_mart_job, run_scoring_job
from bankscope.sources import fixtures as FX
from bankscope.sources import readers, schema, sinks

from .conftest import SF_SMALL


def test_scoring_and_mart_jobs(spark):
    out = tempfile.mkdtemp(prefix="bankscope-test-jobs-")
    cust, tx = FX.customers(spark, SF_SMALL), FX.transactions(spark, SF_SMALL)
    p1 = run_scoring_job(spark, cust, tx, out)
    rec = spark.read.parquet(p1["recommendations"])
    assert rec.count() == cust.count()
    report = spark.read.json(p1["business_metrics"])
    assert report.select(F.size("action_distribution")).first()[0] == rec.select("recommended_action").distinct().count()
    p2 = run_mart_job(spark, rec, tx, out)
    for k in ["customer_table_parquet", "customer_table_csv", "financial_aggregates_parquet", "time_series_csv",
              "kpi_report", "dashboard_cards"]:
        assert os.path.exists(p2[k])
    fa = spark.read.parquet(p2["financial_aggregates_parquet"])
    assert fa.where(F.col("aggregation_level") == "total").first()["n_customers"] == cust.count()
    csv = spark.read.option("header", True).csv(p2["customer_table_csv"])
    assert csv.count() == cust.count()
    kpi = json.loads(open([os.path.join(p2["kpi_report"], f) for f in os.listdir(p2["kpi_report"])
                           if f.endswith(".json")][0]).readline())
    assert kpi["summary"]["critical_customers"] == fa.where(F.col("aggregation_level") == "total").first()["critical_count"]


def test_partitioned_layout_prunes_partitions(spark):
    out = tempfile.mkdtemp(prefix="bankscope-test-shards-")
    sinks.write_partitioned(FX.transactions_with_segment(spark, SF_SMALL), out)
    df = readers.read_shards(spark, out, schema.TX_SCHEMA).where(
        (F.col("segment") == "retail") & (F.col("month") == 3))
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters" in plan and "segment" in plan
    assert df.count() == FX.transactions_with_segment(spark, SF_SMALL).where(
        (F.col("segment") == "retail") & (F.col("month") == 3)).count()


def test_first_available_reports_missing_inputs(spark):
    import pytest
    with pytest.raises(readers.InputMissing):
        readers.read_first_available(spark, ["/nonexistent/a.parquet", "/nonexistent/b.parquet"])
