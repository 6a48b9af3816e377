import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(helpers.odd_documents(), helpers.ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], helpers.ODD_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, base):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()]
