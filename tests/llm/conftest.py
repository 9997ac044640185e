import pytest

LONG = "word " * 30000


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty, blank and long texts, repeats, and columns with clashing names."""
    rows = [
        (None, None, None, None, None),
        (None, "null id", "en", "s1", 7),
        (1, None, None, None, 0),
        (2, "", "en", "s1", 0),
        (3, " \t\n ", "de", "", 4),
        (4, LONG, "en", "s2", len(LONG)),
        (5, "x" * 200000, None, "s2", 200000),
        (6, "same text here", "en", "s2", 14),
        (6, "same text here", "en", "s2", 14),
        (7, "same text here", "en", None, 14),
        (8, "a\0b 漢字 😀 é ᠎ z", "fr", "s1", 15),
    ]
    extra = [(*r, i, f"c{i}", i / 2) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        extra, "doc_id long, text string, lang string, source string, n_chars long, k int, shard string, size double"
    ).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
