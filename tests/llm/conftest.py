import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
# Names that the operators use for columns of their own.
CLASHING = ["_doc", "_text", "_id", "rank", "n", "key", "label", "start", "name", "_row", "size"]


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {r["doc_id"]: r["text"] or "" for r in corpus.collect()}


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of (doc_id, text) rows with other columns, whose names clash with those inside the operators."""

    def make(rows):
        df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
        return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])

    return make
