"""Shared inputs of the tests in this folder."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use for their own columns
    T.StructField("kept", T.StringType()), T.StructField("words", T.StringType()),
    T.StructField("n_words", T.StringType()), T.StructField("key", T.StringType()),
])


def rows(*texts, lang="en", source="s", start=1):
    return [(i, t, lang, source, len(t or ""), "x", "y", "z", "k") for i, t in enumerate(texts, start)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


#: null, empty, blank, one word, very long, and rows with null columns
AWKWARD = [
    (1, None, "en", "s", None, "x", "y", "z", "k"), (2, "", None, None, 0, None, None, None, None),
    (3, " \t\n\r ", "en", None, 5, "x", "y", "z", "k"), (4, "word", "en", "s", 4, "x", "y", "z", "k"),
    (5, "lorem ipsum dolor sit amet " * 20000, "en", "s", 0, "x", "y", "z", "k"),
    (6, "a" * 200000, "de", "s", 0, "x", "y", "z", "k"),
    (7, "same text twice over", "en", "s", 0, "x", "y", "z", "k"),
    (7, "same text twice over", "en", "s", 0, "x", "y", "z", "k"),
    (None, "a row without an id", "en", "s", 0, "x", "y", "z", "k"),
]
