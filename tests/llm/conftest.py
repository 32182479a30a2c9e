from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    def make(*texts, ids=None, source="src0", partitions=3):
        ids = ids or range(len(texts))
        rows = [(i, t, "en", source, len(t or "")) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(partitions)

    return make
