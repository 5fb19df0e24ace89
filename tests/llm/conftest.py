import pytest
from pyspark.sql import functions as F

ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 3), (3, " \n\t ", None, "a", 3),
    (4, "Word", "en", None, 4), (5, "naïve ÉTÉ 漢字 \U0001f600 end", "fr", "b", None), (None, "a text without id", "en", "b", 17),
    (6, "one two three four five six seven eight nine ten eleven twelve " * 40, "en", "b", 0),
    (7, "one two three four five six seven eight nine ten eleven twelve " * 40, "en", "b", 0),
    (8, "x" * 60_000 + " <|endoftext|>  spaces \n ", "en", "b", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like those of results."""
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({"score": F.lit("mine"), "n_words": F.lit(1.5), "spans": F.lit(None), "block": F.lit("x")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
