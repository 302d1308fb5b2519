import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, size string, key int, bucket int, lines string"


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, in a table whose other columns clash with made names."""
    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(30_000))
    texts = [
        (1, "One two three four five six.\nShared line here\n\nend", "a"), (2, None, "a"), (3, "", "a"), (4, long, "b"),
        (None, "No id here, but some words do follow it all the same", "b"), (5, "x", None), (6, "same text twice over and over", "c"),
        (7, "same text twice over and over", "c"), (7, "same text twice over and over", "c"), (8, "  spaces  and\ttabs \r\n\n", "c"),
        (9, "日本語 été ß ﬁ <|endoftext|> end", None), (10, "Shared line here\nother", "a"), (None, None, None), (11, " \n ", "a"),
    ]
    return [(i, t, "en", s, len(t or ""), 1, "s", 2, 3, "l") for i, t, s in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
