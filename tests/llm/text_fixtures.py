"""Documents the tests share (not a conftest: the engine's tests have that name)."""

import pytest
from brute import EDGE, EDGE_SCHEMA


@pytest.fixture(scope="session")
def edge(spark):
    """Awkward documents, with extra columns named like the operators' own."""
    from snaptally.llm import base as B
    B.prepare(spark)
    return spark.createDataFrame(EDGE, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    from snaptally.llm import base as B
    B.prepare(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
