import os

import pytest

#: Columns besides the given ones, named like the operators' own.
EXTRA = ["n", "digest", "key", "token", "label", "count", "cls", "gone", "words", "score"]

LONG = "lorem ipsum dolor sit amet " * 30_000


def texts():
    """Rows (doc_id, text): nulls, empty and blank texts, repeats of rows and texts, ties, a very long text."""
    base = "the quick brown fox jumps over the lazy dog and runs away from here to there again"
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, base), (5, base), (6, base + " now"), (6, base + " now"),
        (7, "one"), (8, "one two three four"), (9, "ONE two\tthree\x0bfour"), (10, LONG), (11, LONG + "x"),
        (12, "Über die Brücke 日本語 😀 été"), (13, "á é   z"), (None, "no id"), (None, base), (14, "x" * 5000),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd rows with clashing extra columns that hold nulls."""
    rows = [(i, t, None, *([k] * len(EXTRA))) for k, (i, t) in enumerate(texts())]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} int" for c in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def write_tables(spark, folder, **tables):
    """Write frames as <name>.parquet and return the folder."""
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder
