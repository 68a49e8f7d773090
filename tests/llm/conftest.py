import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs_of(spark: SparkSession):
    """Documents of (doc_id, text) pairs, with the other columns of the table."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows],
                                     "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return make
