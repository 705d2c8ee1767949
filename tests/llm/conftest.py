import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) pairs or whole rows, with an extra column."""

    def build(rows, extra=None):
        full = []
        for row in rows:
            doc_id, text, *rest = row
            lang, source = rest or ("en", "s")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(7) for c in extra})
        return df

    return build
