import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHING = ["_k1", "_row", "_text", "_id", "_lines", "id", "f", "component", "group", "line", "lang", "_h", "_p", "word", "n"]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs."""
    def of(rows, partitions=3):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)
    return of


@pytest.fixture(scope="session")
def clash():
    """The same documents with extra columns whose names an operator might use."""
    from pyspark.sql import functions as F

    def of(docs):
        for c in CLASHING:
            if c not in docs.columns:
                docs = docs.withColumn(c, F.lit("x"))
        return docs
    return of
