import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) rows; with ``extra``, columns whose names clash with results."""

    def make(rows, extra=False):
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            df = df.selectExpr(
                "doc_id", "text", "'x' as n_words", "1 as score", "true as kept", "'s' as source", "2L as n_chars", "'t' as node"
            )
        return df

    return make


#: Rows that every operator must take: nulls, empty and blank texts, ties, repeated rows, long texts.
ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (None, "one two"),
    (None, None),
    (5, "word " * 30000),
    (6, "x" * 50000),
    (7, "éàü 日本語 😀   end"),
    (8, "Same text, the same text for both of them, every word."),
    (9, "Same text, the same text for both of them, every word."),
]
