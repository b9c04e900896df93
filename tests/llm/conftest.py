import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 7919} and{i % 13}" for i in range(60_000))
TEXTS = [None, "", " \n\t ", "one", "two words", "a b c d e f g h a b c d e f g h", "same text here, twice.",
         "same text here, twice.", "line one\nline two\nline one\n\nline two", "Ünïcödé ßtraße 日本語 テキスト 😀 é",
         "x" * 5000, "The quick brown fox jumps over the lazy dog. " * 6, LONG, "1d10t t0ken \x00 end"]
#: column names that the operators might use inside
CLASHING = ["n", "key", "fp", "t", "word", "_q", "_kept", "range", "first", "score", "unit", "label", "later", "_later"]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty, blank and very long texts, repeated rows and ids, clashing columns."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "an id is missing"), (None, None), (6, TEXTS[6]), (5, "another text of id five")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.IntegerType()) for c in CLASHING]])
    return spark.createDataFrame([(*r, *range(len(CLASHING))) for r in rows], schema).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def texts_of(df):
    return {(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()}
