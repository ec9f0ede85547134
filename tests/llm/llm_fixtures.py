"""Small tables for the tests of the training-data operators."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Awkward rows: null id, null and empty text, a very long text, repeated rows.
AWKWARD = [(None, "a null id with some words in it"), (1, None), (2, ""), (3, " \n\t "), (4, "word " * 30000),
           (5, "twice the same row"), (5, "twice the same row"), (6, "é ü \U0001F600 \x00   z"), (7, "x" * 40000)]


def make_docs(spark, rows):
    """A documents table from (doc_id, text[, source]) tuples."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)
