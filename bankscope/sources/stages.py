"""Stage tables: written once into the shared checkpoint folder, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing the stage once as Parquet in the shared
    checkpoint folder and reading it back (never ``localCheckpoint``).

    Unlike ``DataFrame.checkpoint()`` (which evaluates the plan twice unless
    it is cached) the stage is computed once; later reads get column pruning
    and filter push-down, and the files survive executor loss.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/bankscope-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known schema: no inference job
    out._stage_path = path
    return out


def materialize_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """A stage bucketed and sorted by ``key``, as many buckets as the session
    has shuffle partitions: aggregations by the key and joins of such stages
    on it need no exchange.  ``df`` is to be dealt by the key (``repartition``
    by it), so that each bucket is whole in one task and makes one file."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"bankscope_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/bankscope-{name}-{uuid.uuid4().hex}"
    df.write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._stage_path, out._stage_table = path, table
    return out


def release(df: DataFrame) -> None:
    """Delete a stage's files; nothing may read it afterwards."""
    if hasattr(df, "_stage_table"):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._stage_table}")
    delete(df.sparkSession, df._stage_path)


def delete(spark, path: str) -> None:
    """Delete a folder, if it is there, on whatever file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark, path: str) -> bool:
    """Whether a path is there, on whatever file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
