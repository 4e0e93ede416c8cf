import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and clashing names."""
    long_text = " ".join(f"w{i % 701}" for i in range(30_000))
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [
        (1, "", "en", "a", 0, "x"), (2, None, None, None, None, None), (3, " \n\t ", "en", "a", 4, "x"),
        (4, "one", "en", "b", 3, "x"), (5, "One two three four five six", "en", "b", 27, "x"),
        (6, "one two three four five six", "en", None, 27, "x"), (7, long_text, "en", "a", 1, "x"),
        (8, long_text, "en", "b", 1, "x"), (9, "x " * 300, "en", "a", 600, "x"), (10, "é🙂 " * 80, "fr", "c", 240, "x"),
        (11, passage, "en", "a", 1, "x"), (12, "lead " + passage + " tail", "en", "b", 1, "x"),
        (12, "lead " + passage + " tail", "en", "b", 1, "x"), (13, "\u00a0a\u2003b c", "en", "c", 7, "x"),
        (14, "a\0b" * 70, "en", "c", 210, "x"), (15, passage + " " + passage, "en", "a", 1, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
