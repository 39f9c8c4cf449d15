import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from texts or (doc_id, text, source) rows."""

    def make(rows, extra=False):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = r if isinstance(r, tuple) else (i, r, "a")
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCUMENTS).repartition(3)
        if extra:
            for name in ("key", "hash", "digest", "fp", "row", "size", "run", "suspect_id", "_id", "_mark", "salt", "pass", "shard", "ids", "score", "component_id"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make
