"""A small table with every awkward case, and copies of it."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = " ".join(f"alpha{i % 97} beta{i % 89} gamma{i}" for i in range(120))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in each column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i * 7919 % 100003}" for i in range(400_000))
    rows = [
        (1, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (3, PROSE.upper(), "en", "b", 10),
        (4, None, "en", "a", None),
        (5, "", "de", "b", 0),
        (None, "ein kleiner Hund und eine Katze", "de", None, 3),
        (None, None, None, None, None),
        (6, " \n\t ", None, "c", 3),
        (7, long, "en", "c", len(long)),
        (8, "Müller's “Straße” — 5 kg, don't…\r\nzweite Zeile  ​<|endoftext|> x\n\nend ", "de", "c", 1),
        (9, "12345 67890 !!! ???", "fr", "", 1),
        (9, "12345 67890 !!! ???", "fr", "", 2),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "key", "rank", "fingerprint", "score", "hash", "position", "n_tokens", "kept", "lang_pred"):
        docs = docs.selectExpr("*", f"'x' as {name}")
    return docs.cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
