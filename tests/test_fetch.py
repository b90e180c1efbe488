import json

import pytest
from pyspark.sql import functions as F

from vectable.operators import fetch
from vectable.sources.tables import save_snapshot
from vectable.table import VectorTable

TABLE = VectorTable()


@pytest.fixture(scope="module")
def nested(spark):
    """Books whose page text and vector lie in one struct and whose facts lie in another."""
    rows = [("b7", ([0.5], "of whales"), (1851, "sea"), 3), ("b8", None, (1818, "ice"), 4)]
    return spark.createDataFrame(rows, "id string, page struct<coords array<float>, words string>, facts struct<year int, topic string>, floor int")


NESTED = VectorTable(text="page.words", embedding="page.coords", metadata="facts")


@pytest.mark.parametrize("limit", [0, 100])
def test_get_by_ids(spark, corpus, limit):
    wanted = spark.createDataFrame([("a",), ("c",), ("c",), ("nope",)], "key string")
    out = fetch.get_by_ids(corpus, wanted, TABLE, max_broadcast=limit)
    assert sorted(r.id for r in out.collect()) == ["a", "c"] and out.columns == corpus.columns
    assert fetch.get_by_ids(corpus, wanted.limit(0), TABLE).count() == 0
    assert fetch.get_by_ids(corpus, wanted, TABLE, ["id"]).columns == ["id"]


def test_filtered_fetch(corpus):
    out = fetch.filtered_fetch(corpus, {"category": {"$ne": "none"}}, TABLE, 3, order=[("tenant", False), ("metadata.year", True)], skip=1)
    assert [r.id for r in out.collect()] == ["c", "d", "b"] and "embedding" not in out.columns
    assert fetch.filtered_fetch(corpus, None, TABLE, 9, include_vectors=True).columns == corpus.columns
    for top, skip in ((0, 0), (1, -1)):
        with pytest.raises(ValueError):
            fetch.filtered_fetch(corpus, None, TABLE, top, skip=skip)


def test_fetch_does_not_read_vectors(spark, corpus, tmp_path, plan_of):
    saved = save_snapshot(corpus, str(tmp_path / "t"))
    text = plan_of(fetch.filtered_fetch(saved, {"year": 2025}, TABLE, 2))
    assert "TakeOrderedAndProject" in text and "embedding" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_documents_fold_columns(spark, nested):
    out = {r.id: r for r in fetch.to_documents(nested, NESTED).collect()}
    assert out["b7"].text == "of whales" and out["b7"].metadata.asDict() == {"year": 1851, "topic": "sea", "floor": 3}
    with pytest.raises(Exception, match="no text"):
        fetch.to_documents(nested, NESTED, strict=True).collect()
    with pytest.raises(ValueError):
        fetch.to_documents(nested.withColumn("page", F.struct(F.lit(42).alias("words"))), NESTED, strict=True)
    with pytest.raises(ValueError):
        fetch.to_documents(nested.withColumn("facts", F.lit(5)), NESTED)
    with pytest.raises(Exception, match="no JSON object"):
        fetch.to_documents(nested.withColumn("facts", F.lit("[1]")), NESTED).collect()


def test_extra_columns_win_and_internal_ones_go(spark):
    df = spark.createDataFrame([("1", "t", (1, "old"), "new", "i", [1.0])], "id string, text string, metadata struct<n int, tag string>, tag string, hidden string, embedding array<float>")
    table = VectorTable(internal=("hidden",))
    row = fetch.to_documents(df, table).first()
    assert row.metadata.asDict() == {"n": 1, "tag": "new"} and row.__fields__ == ["id", "text", "metadata"]
    assert fetch.to_documents(df, table, include_vectors=True).first().embedding == [1.0]
    dynamic = df.select("id", "text", F.parse_json(F.lit('{"n": 1}')).alias("metadata"))
    assert fetch.to_documents(dynamic, table).select(F.to_json("metadata")).first()[0] == '{"n":1}'
    tagged = fetch.to_documents(dynamic.withColumn("tag", F.lit("x")).withColumn("n", F.lit(None).cast("int")), table)
    assert tagged.select(F.to_json("metadata")).first()[0] == '{"n":null,"tag":"x"}'
    bare = df.select("id", "text")
    assert fetch.to_documents(bare, table).columns == ["id", "text"]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("""'{"a": {"b": [1, 2]}, "tag": "old"}'""", {"a": {"b": [1, 2]}, "tag": "new"}), ("CAST(NULL AS string)", {"tag": "new"}), ("' {} '", {"tag": "new"}),
        ("""parse_json('{"a": 1.5, "tag": {"x": 1}}')""", {"a": 1.5, "tag": "new"}), ("map('k', 3, 'tag', 4)", {"k": 3, "tag": "new"}),
        ("map('k', named_struct('z', 1))", {"k": {"z": 1}, "tag": "new"}), ("CAST(NULL AS variant)", {"tag": "new"}),
    ],
    ids=["json", "none", "empty", "variant", "map", "map of structs", "no variant"],
)
def test_columns_fold_into_schemaless_metadata(spark, value, want):
    df = spark.createDataFrame([("1", "t", "new")], "id string, text string, tag string").withColumn("metadata", F.expr(value))
    out = fetch.to_documents(df, VectorTable())
    shown = F.col("metadata") if dict(out.dtypes)["metadata"] == "string" else F.to_json("metadata")
    assert json.loads(out.select(shown).first()[0]) == want


def test_paths(spark, nested):
    assert nested.select(fetch.get_path(nested, "page.words")).first()[0] == "of whales"
    with pytest.raises(KeyError):
        fetch.get_path(nested, "page.nope")
    put = fetch.set_path(nested, "page.more.deep", F.lit(5))
    assert [r[0] for r in put.select("page.more.deep").collect()] == [5, 5]
    assert put.select("page.words").first()[0] == "of whales"
    assert fetch.set_path(nested, "fresh.a.b", F.lit(1)).select("fresh.a.b").first()[0] == 1
    assert fetch.set_path(nested, "floor", F.lit("t")).select("floor").first()[0] == "t"
    with pytest.raises(ValueError):
        fetch.set_path(nested, "floor.name", F.lit(1))
    gone = fetch.remove_path(nested, "page.coords")
    assert gone.schema["page"].dataType.names == ["words"]
    assert "page" not in fetch.remove_path(gone, "page.words").columns
    assert fetch.remove_path(nested, "page.nope.x").schema == nested.schema
    assert "floor" not in fetch.remove_path(nested, "floor").columns
    deep = fetch.remove_path(fetch.set_path(nested, "page.more.deep", F.lit(5)), "page.more.deep")
    assert deep.schema["page"].dataType.names == ["coords", "words"]
    assert [r.page is None for r in gone.orderBy("id").collect()] == [False, True]


NAMES = {"Id": "_id", "Text": "content", "Category": "category", "Embedding": "vector"}


def test_storage_names_round_trip(spark, tmp_path, plan_of):
    records = spark.createDataFrame([("1", "hello", "greeting", [1.0, 2.0])], "Id string, Text string, Category string, Embedding array<float>")
    stored = fetch.to_storage(records, NAMES)
    assert stored.columns == ["_id", "content", "category", "vector"]
    assert fetch.from_storage(stored, NAMES).columns == ["Id", "Text", "Category"]
    assert fetch.from_storage(stored, NAMES, include_vectors=True).collect() == records.collect()
    saved = save_snapshot(stored, str(tmp_path / "t"))
    text = plan_of(fetch.from_storage(saved, NAMES).filter((F.col("Category") == "greeting") & (F.col("Text") != "x")))
    assert "EqualTo(category,greeting)" in text and "vector" not in text.split("ReadSchema:")[1]
    with pytest.raises(ValueError):
        fetch.from_storage(records, NAMES)
    with pytest.raises(ValueError):
        fetch.to_storage(records, {"Id": "x", "Text": "x"})


@pytest.mark.parametrize(("top", "skip"), [(7, 0), (50, 333), (10, 995), (5, 2000), (1000, 0)])
def test_deep_pages_are_the_same_pages(spark, top, skip):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 13).alias("n"), F.lit("t").alias("text")).repartition(6)
    shallow = fetch.filtered_fetch(df, None, TABLE, top, order=[("n", False)], skip=skip)
    deep = fetch.filtered_fetch(df, None, TABLE, top, order=[("n", False)], skip=skip, deep=0)
    assert deep.collect() == shallow.collect() and deep.columns == shallow.columns
