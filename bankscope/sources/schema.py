"""Typed schemas of the two input tables (S12) and required-column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

CUSTOMER_SCHEMA = StructType([
    StructField("customer_id", StringType(), False),
    StructField("age", IntegerType(), True),
    StructField("income", DoubleType(), True),
    StructField("account_balance", DoubleType(), True),
    StructField("segment", StringType(), True),
    StructField("churn_risk_score", DoubleType(), True),
    StructField("tenure_months", IntegerType(), True),
    StructField("region", StringType(), True),
])

TX_SCHEMA = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("customer_id", StringType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("amount", DoubleType(), True),
    StructField("type", StringType(), True),
    StructField("channel", StringType(), True),
    StructField("month", IntegerType(), True),
    StructField("segment", StringType(), True),
])

CUSTOMER_COLUMNS = [f.name for f in CUSTOMER_SCHEMA.fields]
TX_COLUMNS = [f.name for f in TX_SCHEMA.fields]


class MissingColumns(ValueError):
    pass


def require(df: DataFrame, columns, what: str = "input") -> DataFrame:
    """Fail early (analysis time) when a required column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{what} lacks required columns {missing}; has {df.columns}")
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a schema's columns (fails on a missing column); a
    NaN is a missing value and comes as null."""
    require(df, [f.name for f in schema.fields])

    def column(f: StructField):
        c = df[f.name].cast(f.dataType)
        return F.when(~F.isnan(c), c) if isinstance(f.dataType, DoubleType) else c

    return df.select(*[column(f).alias(f.name) for f in schema.fields])
