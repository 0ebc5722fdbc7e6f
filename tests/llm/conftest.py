import pytest

AWKWARD = [
    (1, "one two three four five six. One two!", "en", "a", 5),
    (1, "one two three four five six. One two!", "en", "a", 5),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \n\t ", "de", None, 3),
    (None, "no id here at all", "en", "c", 1),
    (5, "word " * 30_000, "en", "c", None),
    (6, "x" * 60_000, "fr", "c", 9),
    (7, "Große Straße é ñ 日本 🎉 \x00 end <|endoftext|> it's", "de", "c", 9),
    (8, "one two three four five six. One two!", "en", "c", 9),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Further columns with names that the operators use themselves.
CLASH = ["start", "length", "piece", "n_tokens", "fp", "component_id", "score", "kept", "uid", "part", "key", "spans", "ids", "id"]


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, COLUMNS)
    return df.select("*", *[F.lit("?").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
