import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) rows with columns whose names clash with what the operators add."""

    def make(rows):
        df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
        return df.withColumns({n: F.lit("mine") for n in ("n", "cls", "k", "a", "b", "part", "slot", "ids", "sketch", "pii")})

    return make
