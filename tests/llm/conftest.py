import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ("_row", "_new", "score", "kept", "n", "m", "sig", "row", "rep", "key", "digest", "toxic", "at", "block", "ids")


def documents(spark, rows):
    """(doc_id, text[, lang[, source]]) rows as documents with more columns of unlucky names."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en",)), *(("s",) if len(r) < 4 else ()), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit(c) for c in CLASHES})


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id here"), (None, None),
    (6, "word " * 30_000), (7, "x" * 150_000), (8, "漢字かな é 😀 <|endoftext|> \x00 end"), (9, "a b c d e f g h i j", None, None),
]


@pytest.fixture(scope="session")
def edges(spark):
    return documents(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, EDGES).limit(0)
