import pytest
from pyspark.sql import types as T

from admitlab.llm.common import ship_package

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture()
def make_docs(llm):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return llm.createDataFrame(full, DOCS)
    return make
