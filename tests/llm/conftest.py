import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def dirty(spark):
    """Null and empty texts, null ids, repeated rows, one id with two texts, a
    long text, and extra columns named like the operators' own."""
    base = "The quick brown fox jumps over the lazy dog while seven wizards boil strange potions under moonlight tonight. "
    rows = [
        (1, None), (2, ""), (3, base * 3), (3, base * 3), (4, base * 3), (None, base * 3), (None, None),
        (5, "one two"), (6, "One  two"), (7, base.upper() + "\nsecond line of this text has quite enough words\nsecond line of this text has quite enough words"),
        (7, "another text under one id\nwith two lines that are long enough"), (8, "\n\n \n"), (9, " ".join(f"w{i}" for i in range(30_000))),
        (10, " ".join(f"w{i}" for i in range(30_000)) + " end"), (11, "é" * 250), (12, "x" * 700),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars", "1 AS key", "2 AS row", "3 AS v",
        "4 AS node", "5 AS score", "6 AS spans", "7 AS words", "8 AS island", "9 AS _row_key", "'p' AS hash")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=repr)
