import pytest
from pyspark.sql import SparkSession, types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark: SparkSession):
    """Make a documents table from (doc_id, text) pairs."""

    def make(*rows):
        return spark.createDataFrame(
            [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCUMENTS)

    return make
