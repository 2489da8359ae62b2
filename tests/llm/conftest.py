import datetime as dt

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [(1, "alpha beta gamma", "en", "a", 3), (2, None, None, None, None), (3, "", "en", "a", 0),
            (None, "no id here at all", "fr", None, 5), (None, "no id here at all", "fr", None, 5), (None, None, None, None, None),
            (4, " \t\n\n", "en", "b", 4), (5, "one\ntwo\r\n\nthree. Four! Five?", "de", "b", 1),
            (6, "alpha beta gamma", "en", "a", 3), (6, "alpha beta gamma", "en", "a", 3),
            (7, "word " * 30_000, "en", "b", 150_000), (8, "é" * 50 + " x", "fr", "a", 52), (9, "\x00\x1c\x85", "xx", "a", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F
    extra = {c: F.lit(7) for c in ("row", "kept", "n_words", "n_lines", "id0", "text_key", "score", "shard", "b", "key", "items", "items_x")}
    return df.withColumns(extra | {"when": F.lit(dt.date(2024, 1, 1)), "a.b": F.lit("dot")})


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 0), (7, 0, None), (5, None, 1)],
                                 "doc_id long, quality int, toxic int")
