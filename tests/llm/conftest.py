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

CLASHING = ["row", "shard", "size", "hits", "print", "score", "keeper", "file", "word", "block"]


@pytest.fixture(scope="session")
def documents(spark):
    """Frames of (doc_id, text) rows with the other columns of documents, or with
    columns whose names the operators use themselves."""

    def frame(rows, clashing=False):
        out = spark.createDataFrame(
            [(k, t, "en", "s", None if t is None else len(t)) for k, t in rows], DOCUMENTS
        )
        if clashing:
            for name in CLASHING:
                out = out.selectExpr("*", f"'x' AS {name}")
        return out

    return frame


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "   \t\n "),
    (None, "a null key"),
    (5, "twice the same row"),
    (5, "twice the same row"),
    (7, "word " * 30_000),
    (-8, "a negative key"),
]


@pytest.fixture(scope="session")
def awkward():
    return AWKWARD
