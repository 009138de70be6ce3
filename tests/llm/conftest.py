import pytest

#: Edge rows: NULLs in any column, empty and very long texts, ties and repeated rows, clashing extra columns.
LONG = " ".join(f"word{i % 9000} alpha{i}" for i in range(20_000))
EDGE = [(1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"), (2, None, "en", None), (3, "", None, "a"),
        (4, LONG, "en", "b"), (5, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (5, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"), (None, "one text without an id", "de", "b"),
        (7, "   ", "en", "a"), (8, "x", "fr", "a"), (9, "ü\U0001f389 " * 30, "de", "c"), (10, "aaaa" * 5000, "en", "c")]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, node long, key string, score double, `range` int, shard int, "
          "rate string, copy string, row_number string, Row_Number_ string, `a.b` string, text_hash long, low long, id long")


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(d, t, la, s, len(t or ""), 1, 2, "k", 0.5, 3, 4, "mine1", "mine2", "mine3", "mine4", "mine5", 5, 6, 7) for d, t, la, s in EDGE], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, 1, None), (None, 1, 1), (8, None, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
