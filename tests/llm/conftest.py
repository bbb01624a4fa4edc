import pytest

from estrato.llm.common import importable

DOCS = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    """A table of documents with columns of other names that operators might use themselves."""
    importable(spark)

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, DOCS).repartition(4)
        if extra:
            for name in ("row", "node", "chunk", "digest", "lines", "key", "spans", "score"):
                df = df.selectExpr("*", f"1 AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def given():
    """Path of a given folder by its scale."""
    return lambda scale: f"/root/testdata/sf{scale}"


@pytest.fixture
def texts(spark, given):
    importable(spark)
    return lambda scale: [(r.doc_id, r.text) for r in spark.read.parquet(f"{given(scale)}/documents.parquet").select("doc_id", "text").collect()]
