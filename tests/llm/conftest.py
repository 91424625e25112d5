import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, key string, row string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns with clashing names."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a", 1, "x", "y", "z", "r"),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a", 1, "x", "y", "z", "r"),
        (2, None, "en", None, None, None, None, None, None), (3, "", None, "b", 0, "", "", "", ""),
        (3, "", None, "b", 0, "", "", "", ""), (None, "one two", "fr", "b", 7, "q", None, "q", "q"),
        (None, None, None, None, None, None, None, None, None), (5, long, "en", "a", len(long), "x", "y", "z", "r"),
        (6, " \t\n ", "de", "c", 4, "x", "y", "z", "r"), (7, "été ça 漢字 😀 <|endoftext|>\r\n  x", "fr", "a", 9, "x", "y", "z", "r"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
