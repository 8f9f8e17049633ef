import os

import pytest
from pyspark.sql import types as T

import brute


@pytest.fixture(scope="session")
def documents(spark):
    """A small table with what real ones hold: copies, near copies, nulls, empty and long texts."""
    return brute.documents(spark)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                                                   T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                                                   T.StructField("n_chars", T.LongType())]))


FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
