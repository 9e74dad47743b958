import pytest

from . import fixtures


@pytest.fixture(scope="session")
def given():
    return fixtures.rows()


@pytest.fixture(scope="session")
def docs(spark, given):
    """As a table of several files: operators may read it more than once."""
    import tempfile

    path = tempfile.mkdtemp(prefix="llm-docs-")
    spark.createDataFrame(given, fixtures.SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def texts(given):
    """Text by id, without the row that has none."""
    return {r[0]: r[1] for r in given if r[0] is not None}


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
