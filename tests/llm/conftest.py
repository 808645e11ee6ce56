import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import DOCS, odd_docs  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_docs(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clash(docs):
    """Extra columns whose names operators might use themselves."""
    out = docs
    for name in ("id", "fp", "key", "n", "keys", "kept", "length", "piece", "row", "rank", "score", "part", "label", "root"):
        out = out.withColumn(name, out.doc_id.cast(T.StringType()))
    return out
