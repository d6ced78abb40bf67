import pytest

pytest.importorskip("tidelog.llm")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, fp long"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing names."""
    long = "word " * 3000
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, None, 2), (3, " \n\t", "en", "a", 3, "x", 3),
            (4, "a b c d", "en", "a", 7, "x", 4), (4, "a b c d", "en", "a", 7, "x", 4), (5, "a  b\nc d", "de", None, 8, "x", 5),
            (6, "abcd", "de", "b", 4, "x", 6), (7, long, "fr", "b", len(long), "x", 7), (8, long + "x", "fr", "b", 0, "x", 8),
            (None, "a b c d e", "fr", "b", 9, "x", 9), (9, "é́ ABC <|endoftext|> \U0001F600 it's 42", "fr", "b", 9, "x", 9),
            (10, "z" * 20000, "fr", "c", 9, "x", 9), (11, "two words", "fr", "c", 9, "x", 9), (12, "two words", "fr", "c", 9, "x", 9)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
