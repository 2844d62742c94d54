from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def odd_rows():
    """Null, empty, blank and very long texts, repeated rows, equal ids with other texts, a null id."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "a b c"), (5, long_text), (5, long_text), (6, long_text + " end"), (7, "a b c"),
        (7, "a different text of the same id"), (None, "text without an id that is long enough to count as a line"), (None, None), (8, "é ß 漢字 😀 \u0085 x"),
    ]
