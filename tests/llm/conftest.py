from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")

# Columns that operators use inside, under names that also differ in case.
CLASHES = ("unit", "Row", "score", "KEY", "words", "bucket", "hilbert_key", "shard", "label")


@pytest.fixture
def docs(spark):
    """Builds a document table from (doc_id, text) pairs, with further columns of clashing names."""

    def build(pairs):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        df = spark.createDataFrame(list(pairs), schema).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string")})
        return df.withColumns({name: F.lit(1) for name in CLASHES})

    return build


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build
