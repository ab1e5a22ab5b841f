import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests"), os.path.join(ROOT, "tests", "llm")]

from pyspark.sql import types as T  # noqa: E402

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # names that the operators use for their own columns
    T.StructField("slot", T.StringType()), T.StructField("ids", T.LongType()), T.StructField("n_chunks", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("component_id", T.StringType()),
])


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "src0", "x", 1, "y", "z", "w") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
