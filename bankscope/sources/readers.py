"""Readers (S1-S5, S11): Parquet tables, shard directories, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schema import conform
from .stages import exists

# Mart names -> pipeline names (the customer mart renames two columns).
MART_TO_PIPELINE = {"total_revenue_generated": "predicted_revenue_annual", "clv_5yr": "clv"}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One Parquet table; with a schema the columns are selected and cast."""
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def read_shards(spark: SparkSession, directory: str, schema: StructType | None = None) -> DataFrame:
    """A directory of Parquet shards; partition columns are discovered.

    Filters on partition columns (segment, month) prune directories before
    any file is opened.  Shards written in batches are read together, without
    the batch's name.
    """
    df = spark.read.option("basePath", directory).parquet(directory).drop("_batch")
    return conform(df, schema) if schema is not None else df


class InputMissing(FileNotFoundError):
    pass


def read_first_available(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S3: the first path that exists (e.g. enriched mart, else recommendations)."""
    for p in paths:
        if exists(spark, p):  # a table that is there but unreadable is an error
            return spark.read.parquet(p)
    raise InputMissing("none of the inputs exist; run the scoring job first:\n  " + "\n  ".join(paths))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Customer-mart names back to pipeline names."""
    ren = {k: v for k, v in MART_TO_PIPELINE.items() if k in df.columns}
    return df.withColumnsRenamed(ren) if ren else df


def coerce_timestamps(tx: DataFrame, column: str = "timestamp") -> DataFrame:
    """Parse the timestamp column when it is not already a timestamp."""
    if dict(tx.dtypes).get(column) == "timestamp":
        return tx
    return tx.withColumn(column, F.to_timestamp(F.col(column)))


def read_report(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A JSON report (multi-line); empty frame when missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema or "value string")
    return spark.read.option("multiLine", True).json(path, schema=schema)
