import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def docs(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 2}", None if t is None else len(t)) for i, t in rows], DOCS)
        if extra:
            for name in ("n_words", "key", "node", "text_2", "score", "ids", "h", "row", "bands"):
                df = df.selectExpr("*", f"cast(7 as int) AS {name}")
        return df

    return docs


@pytest.fixture(scope="session")
def sample(spark):
    """The whole small documents table, as a dict and as a frame."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
