"""Plain helpers of the operator tests."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """A table like `documents` out of texts; ids count from 0."""
    rows = [(i, t, None, sources[i] if sources else f"s{i % 3}", None if t is None else len(t))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)
