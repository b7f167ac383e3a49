import pytest

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "de", "a"), (4, "a", "en", "a"), (4, "a", "en", "a"), (5, LONG, "en", None),
    (None, "x y z", "en", "b"), (6, None, None, "a"), (7, "!!! 123 ...", "fr", "b"), (8, "one two three four five six", None, "a"),
    (9, "One TWO three four five six", "en", "b"), (10, "été 你好 \U0001f600 naïve", "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns of the table whose names the operators use themselves.
CLASHING = ("size", "fp", "hash", "term", "words", "score", "rank", "target", "taken", "copies", "n_chars", "lang_pred", "held_out")


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).select("*", *[F.lit("x").alias(c) for c in CLASHING]).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
