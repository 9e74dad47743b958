"""Driver contract: entry() runs; queries and SQL agree on small data."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "aggregation_level" in df.columns


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["src_customers", "tx_features", "recommendations", "enriched",
                                  "financial_aggregates", "time_series", "kpi_clv", "kpi_concentration",
                                  "view_v26_churn_by_streak_bucket", "customer_mart"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sp = entry.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    cols = sorted(sp.columns)

    def canon(df):
        recs = [tuple(None if (v is None or v != v) else (repr(float(v)) if isinstance(v, float) else
                      str(pd.Timestamp(v)) if hasattr(v, "isoformat") else str(v))
                      for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
        return sorted(recs, key=lambda t: tuple("" if x is None else x for x in t))

    assert canon(sp) == canon(dk)


def test_every_checked_query_matches_sql_on_small_data(spark):
    """All SQL-checked queries at sf0.001: same columns, rows and exact values."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name, sql in sqls.items():
        sp = qs[name](spark, SF_SMALL).toPandas()
        dk = con.execute(sql).df()
        cols = sorted(sp.columns)
        if cols != sorted(dk.columns) or len(sp) != len(dk):
            bad.append(name)
            continue

        def canon(df):
            recs = [tuple(None if (v is None or v is pd.NA or v is pd.NaT or v != v) else
                          (repr(float(v)) if isinstance(v, float) else
                           str(pd.Timestamp(v)) if hasattr(v, "isoformat") else str(v))
                          for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
            return sorted(recs, key=lambda t: tuple("" if x is None else x for x in t))

        if canon(sp) != canon(dk):
            bad.append(name)
    assert not bad, bad
