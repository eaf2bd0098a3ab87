import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs with extra columns whose names operators use themselves."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F
            for c in ("ids", "matches", "kept", "score", "__k1", "__row", "uid", "n_words", "spans", "Decoded"):
                df = df.withColumn(c, F.lit("mine"))
        return df
    return make
