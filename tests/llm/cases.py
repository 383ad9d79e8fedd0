"""Small frames with awkward rows."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    """Documents numbered from 0; extra columns as in the real table."""
    rows = [(i, text, "en", "src0", len(text or "")) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)
