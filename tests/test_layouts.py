"""Repeatable writes, tables laid out for filters, the id index."""

from pyspark.sql import functions as F

from bankscope.operators import views as V
from bankscope.sources import readers, sinks


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([("a", "s1", "2024-01", 1.0), ("b", "s2", "2024-01", 2.0), ("c", None, "2024-02", 3.0)], "customer_id string, segment string, month string, amount double")
    path = f"file://{tmp_path}/t"
    for _ in range(2):
        sinks.write_partitioned(df, path, batch="day-1")
    sinks.write_partitioned(df.where("amount > 2"), path, batch="day-2")
    assert sorted(r.amount for r in spark.read.parquet(path).collect()) == [1.0, 2.0, 3.0, 3.0]
    # fewer rows than before: folders that are not filled now go too
    sinks.write_partitioned(df.where("customer_id = 'a'"), path, batch="day-1")
    assert sorted((r.customer_id, r.amount) for r in spark.read.parquet(path).collect()) == [("a", 1.0), ("c", 3.0)]


def test_filtered_layout_opens_few_files(spark, tmp_path):
    df = spark.range(400).select(F.col("id").cast("string").alias("customer_id"), F.expr("elt(1 + id % 3, 'Low', 'Medium', 'High')").alias("risk_level"),
                                 F.expr("elt(1 + id % 2, 'retail', 'premium')").alias("segment"), F.col("id").cast("double").alias("income"))
    path = f"file://{tmp_path}/t"
    sinks.write_filtered(df, path)
    back = spark.read.parquet(path)
    some = back.where("risk_level = 'High' and segment = 'retail' and income > 100")
    assert back.count() == 400 and some.count() == df.where("risk_level = 'High' and segment = 'retail' and income > 100").count()
    plan = some._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(risk_level" in plan and "GreaterThan(income,100.0)" in plan


def test_index_finds_what_the_scan_finds(spark, tmp_path):
    ids = ["CUST000001", "CUST000012", "cust000123", "AB-7", "é1", "CUST0099.9", None]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "customer_id string, n int")
    path = V.write_index(V.id_index(df), f"file://{tmp_path}/index")
    index = spark.read.parquet(path)
    for text in ("CUST000012", "0123", "12", "7", "b-7", "cust", "ST00.012", "^AB", "9$", "nothing", "[0-9]12", "0.1", "é", " 99 ", ""):
        for regex in (True, False):
            scan = [tuple(r) for r in V.search_customer(df, text, regex).collect()]
            assert [tuple(r) for r in V.search_indexed(df, index, text, regex).collect()] == scan, (text, regex)
    assert V.search_ids(index, "[0-9]12") is None
    assert V.search_ids(index, "T0001") is not None and {r.id for r in V.search_ids(index, "T00012").collect()} == {"CUST000012", "cust000123"}
