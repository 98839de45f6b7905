import pytest
from .llm_helpers import SF
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows."""
    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
