import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("twin", T.StringType()), T.StructField("n_tokens", T.StringType()),
])


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def made(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", "z") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return made


@pytest.fixture(scope="session")
def real_docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


ODD_ROWS = [
    (1, "the cat sat on the mat and the dog sat on the log by the door of the old house in the wood"),
    (2, "the cat sat on the mat and the dog sat on the log by the door of the old house in the wood"),
    (2, "the cat sat on the mat and the dog sat on the log by the door of the old house in the wood"),
    (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "two words"), (None, "a text without a key"),
    (8, "Ünïcode ✓ 😀 text\x85here and\x1cthere"), (9, "x " * 30_000), (2, "another text under a key used before"),
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD_ROWS)


@pytest.fixture(scope="session")
def odd_rows():
    return ODD_ROWS
