import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal texts, odd signs."""
    long = " ".join(f"w{k % 7919}x" for k in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 3), (4, "one", "en", "a", 3),
        (5, "one", "fr", "b", 3), (5, "one", "fr", "b", 3), (None, "one two three four", "en", "a", 18), (6, long, "en", "b", len(long)),
        (7, long + " end", "en", "b", len(long) + 4), (8, "# *   \U0001f600 ퟿\n\n> x\r\nA A A A A A A", None, "é", 20),
        (None, None, None, None, None), (9, "a\nb\nc\nd\na\nb\nc\ne", "en", "z", 15), (10, "z\na \n b\nc\n\ne", "de", "z", 12),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns with names that an operator may use itself."""
    names = ("id", "n", "a", "b", "bands", "size", "target", "hash", "removed", "rep", "words", "body", "lines", "score", "start", "key", "host", "v", "half", "k")
    from pyspark.sql import functions as F

    return odd_docs.select("*", *[F.lit(7).alias(n) for n in names])
