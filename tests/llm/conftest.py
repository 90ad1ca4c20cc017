import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Words that differ from one another, to make texts of.
WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "lm")]


def prose(start: int, n: int) -> str:
    """A text of n words, told by where it starts."""
    return " ".join(WORDS[(start * 7 + i * (3 + start % 5) + i * i % 11) % len(WORDS)] + str((start + i) % 97) for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    columns with names that results have too."""
    long = prose(900, 30_000)
    rows = [
        (1, prose(1, 60), "en", "a", 1),
        (2, prose(1, 60), "en", "a", 1),
        (2, prose(1, 60), "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "de", "b", 4),
        (6, "word", "de", None, 4),
        (7, long, "de", "c", len(long)),
        (8, prose(40, 30) + " " + prose(1, 30), "en", "c", 9),
        (None, prose(1, 60), "en", "a", 1),
        (None, None, None, None, None),
        (9, "é中\U0001f600 ▁ \x00 !!", None, "d", 9),
        (-10, prose(77, 40), "fr", "d", 9),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    extra = {c: __import__("pyspark").sql.functions.lit(1) for c in ("key", "chunk", "bands", "score", "place", "kept", "part", "start")}
    return docs.withColumns(extra).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
