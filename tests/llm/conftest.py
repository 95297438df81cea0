import pytest

#: Odd cases that every operator on documents must take: nulls, empty and long texts, ties, repeated rows, clashing extra columns.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (None, "no id here", None, None), (3, "x " * 30_000 + "y" * 50_000, "en", "a"),
    (4, "same text\nsame text\n", "en", "b"), (4, "same text\nsame text\n", "en", "b"), (5, "same text\nsame text\n", "en", "a"),
    (6, "\n \t\n", "en", "a"), (7, "Ärger – naïve 日本語 😀".encode("utf-16", "surrogatepass").decode("utf-16"), "de", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd cases, with extra columns named as operators might name their own."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    extra = {c: "'z'" for c in ("same", "n", "words", "ids", "start", "score", "host", "owner", "key", "pos", "shard", "length", "_class", "kept", "d", "t")}
    return df.selectExpr("*", *(f"{v} as {k}" for k, v in extra.items()))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
