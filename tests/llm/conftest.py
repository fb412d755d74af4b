import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or longer tuples; the rest is filled with plain values."""

    def make(rows):
        defaults = (None, None, "en", "s", 0)
        full = [tuple(r) + defaults[len(r) :] for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


#: Null and empty texts, white space only, repeated rows, a row without an id, a very long word.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "a b c"),
    (4, "a b c"),
    (None, "a b c"),
    (5, "x" * 50_000),
    (6, "Some plain words, " * 40 + "é ß 中 \U0001f600"),
    (7, "a b c", None, None, None),
]
