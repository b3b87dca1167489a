import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

SHARED = "first line of it\nsecond line of it\nthird line of it"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, an empty and a long text, ties, repeated rows, extra columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, f"alpha beta\n{SHARED}\nomega", "en", "a", 10),
        (2, f"gamma\n{SHARED}", "en", "a", None),
        (2, f"gamma\n{SHARED}", "en", "a", None),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (None, f"no id\n{SHARED}\nend", "en", None, 5),
        (5, long_text, "en", "b", len(long_text)),
        (6, "idiot 😀 é ....", "fr", "b", 9),
        (6, "another text of the same id", "fr", "b", 9),
        (7, "\n\n\n\n", "en", "a", 4),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.selectExpr("*", "1 AS lines", "'x' AS score", "'y' AS copy", "'z' AS place", "2 AS row_key")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
