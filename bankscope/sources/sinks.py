"""Sinks (S6-S10): Parquet, partitioned Parquet, CSV, mart export, reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> str:
    """Overwrite a Parquet table (one directory of part files)."""
    df.write.mode("overwrite").parquet(path)
    return path


#: Top folder of a batch of rows, where writes are to be repeatable.
BATCH = "_batch"


def write_partitioned(df: DataFrame, path: str, cols=("segment", "month"), mode: str = "append", batch: str | None = None) -> str:
    """Append, partitioned by segment and month.

    Rows are sorted on the partition columns inside each task (no shuffle),
    so a task opens one file per directory at a time; a hot (segment, month)
    is still written by every task that holds some of it, never by one
    task, and ``maxRecordsPerFile`` bounds file size.

    With ``batch`` (the name of what is written: a day, a job's run) the rows
    lie in a folder of that batch, and writing the batch again replaces it and
    nothing else: a job that is run twice, or again after it failed half way,
    leaves the same rows.  ``read_shards`` reads both kinds.  ``mode``
    "replace" replaces the folders of the given columns that the rows fall into.
    """
    cols = list(cols)
    w = df if batch is None else df.withColumn(BATCH, F.lit(batch))
    by = cols if batch is None else [BATCH, *cols]
    if batch is not None:
        # what the batch had before goes, also folders that it does not fill now
        from .stages import delete
        delete(df.sparkSession, f"{path.rstrip('/')}/{BATCH}={_escaped(batch)}")
    out = w.sortWithinPartitions(*[F.col(c) for c in by]).write.option("maxRecordsPerFile", 5_000_000)
    if mode == "replace":
        out = out.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        out = out.mode(mode)
    out.partitionBy(*by).parquet(path)
    return path


def _escaped(batch: str) -> str:
    """A batch's name as it stands in a folder's."""
    if not batch or not all(c.isalnum() or c in "-_." for c in batch):
        raise ValueError("a batch is named by letters, digits, '-', '_' and '.'")
    return batch


def write_filtered(df: DataFrame, path: str, folders=("risk_level", "segment"), sort=("income",)) -> str:
    """A table laid out for the dashboard's filters (F3, F6, V20): one folder
    per risk level and segment, rows sorted by income in each task.  A filter
    on the folders' columns opens only their files; one on income skips row
    groups by their least and largest values.  Nothing is shuffled: a hot
    folder is written by every task that has rows of it."""
    (df.sortWithinPartitions(*[F.col(c) for c in (*folders, *sort)]).write.mode("overwrite")
       .option("maxRecordsPerFile", 5_000_000).partitionBy(*folders).parquet(path))
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, UTF-8 with a byte-order mark: it is put before
    the first column's name, so every part file begins with it."""
    marked = df.withColumnRenamed(df.columns[0], f"\ufeff{df.columns[0]}")
    marked.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def export_marts(tables: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """Every table as Parquet and, from that file, CSV; returns
    ``{name_fmt: path}``.  A table is evaluated once."""
    out: dict[str, str] = {}
    base = directory.rstrip("/")
    for name, df in tables.items():
        out[f"{name}_parquet"] = write_parquet(df, f"{base}/{name}.parquet")
        written = df.sparkSession.read.schema(df.schema).parquet(out[f"{name}_parquet"])
        out[f"{name}_csv"] = write_csv(written, f"{base}/{name}.csv")
    return out


def write_report(df: DataFrame, path: str) -> str:
    """A (one-row, nested) report as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
