import pytest
from pyspark.sql import functions as F

from vectable.functions.predicates import matched, where
from vectable.sources.tables import save_snapshot
from vectable.table import VectorTable

TABLE = VectorTable()


def ids(df):
    return "".join(sorted(r.id for r in df.collect()))


@pytest.mark.parametrize(
    ("condition", "want"),
    [
        ({"category": "news"}, "ab"),
        ({"metadata.category": "news"}, "ab"),
        ({"category": {"$eq": "blog"}}, "cf"),
        ({"category": {"$ne": "news"}}, "cdef"),
        ({"priority": {"$gt": 2}}, "cf"),
        ({"priority": {"$gte": 2}}, "bcf"),
        ({"priority": {"$lt": 2}}, "a"),
        ({"priority": {"$lte": 2}}, "ab"),
        ({"priority": {"$gte": 2, "$lt": 5}}, "bc"),
        ({"year": {"$in": [2023, 2024]}}, "bf"),
        ({"year": {"$in": [2023, None]}}, "cef"),
        ({"year": {"$in": []}}, ""),
        ({"year": {"$nin": [2025]}}, "bcef"),
        ({"year": {"$nin": [2025, None]}}, "bf"),
        ({"title": {"$contains": "ocean"}}, "b"),
        ({"title": {"$contains": "0%"}}, "a"),
        ({"title": {"$contains": "a.b"}}, "f"),
        ({"category": "news", "$or": [{"year": 2025}, {"featured": True}]}, "a"),
        ({"$or": [{"category": "news"}, {"featured": False}]}, "abcf"),
        ({"$and": [{"category": "blog"}, {"year": 2023}]}, "f"),
        ({"$nor": [{"category": "news"}, {"year": 2025}]}, "cef"),
        ({"$not": {"category": "news"}}, "cdef"),
        ({"priority": {"$not": {"$gte": 2}}}, "ade"),
        ({"year": None}, "ce"),
        ({"year": {"$ne": None}}, "abdf"),
        ({"unknown": "x"}, ""),
        ({"unknown": {"$ne": "x"}}, "abcdef"),
        ({"category": 5}, ""),  # another type never matches
        ({"category": {"$gt": 5}}, ""),
        ({"category": {"$ne": 5}}, "abcdef"),
        ({"year": "2025"}, ""),
        ({"year": {"$in": ["2025", 2023, True]}}, "f"),
        ({"featured": 1}, ""),
        ({"year": {"$gt": 2024.5}}, "ad"),
        ({"priority": {"$contains": "1"}}, ""),
        ({"namespace": "t1"}, ""),  # a bare key is always a metadata field
        ({}, "abcdef"),
        (None, "abcdef"),
    ],
)
def test_filters(corpus, condition, want):
    assert ids(where(corpus, TABLE, condition)) == want


@pytest.mark.parametrize("positive", [{"category": "news"}, {"priority": {"$gt": 2}}, {"$or": [{"year": 2025}, {"featured": True}]}])
def test_negation_is_the_complement(corpus, positive):
    inside, outside = where(corpus, TABLE, positive), where(corpus, TABLE, {"$nor": [positive]})
    assert ids(inside.union(outside)) == "abcdef"
    assert corpus.filter(matched(corpus, TABLE, positive).isNull()).count() == 0


@pytest.mark.parametrize(
    "bad",
    [
        {"$where": "x"}, {"year": {"$regex": "x"}}, {"": 1}, {" ": 1}, {"a\0b": 1}, {"$or": []}, {"$and": {"a": 1}},
        {"year": {"$in": 3}}, {"year": {}},
    ],
)
def test_bad_filters_are_errors(corpus, bad):
    with pytest.raises(ValueError):
        where(corpus, TABLE, bad)


def test_a_filter_is_a_dict_or_a_column(corpus):
    assert ids(where(corpus, TABLE, F.col("namespace") == "t1")) == "ab"
    with pytest.raises(TypeError):
        where(corpus, TABLE, "namespace = 't1'")


def test_positive_filters_reach_the_scan(spark, corpus, tmp_path, plan_of):
    saved = save_snapshot(corpus, str(tmp_path / "t"))
    text = plan_of(where(saved, TABLE, {"category": "news", "year": {"$gte": 2025}}).select("id"))
    assert "EqualTo(metadata.category,news)" in text and "GreaterThanOrEqual(metadata.year,2025)" in text
    assert "embedding" not in text.split("ReadSchema:")[1]


def test_map_and_variant_metadata(spark, corpus):
    as_map = corpus.select("id", F.create_map(F.lit("category"), F.col("metadata.category")).alias("metadata"))
    assert ids(where(as_map, TABLE, {"category": "news"})) == "ab"
    dynamic = corpus.select("id", F.parse_json(F.to_json("metadata")).alias("metadata"))
    assert ids(where(dynamic, TABLE, {"category": "news", "year": {"$gte": 2025}})) == "a"
    assert ids(where(dynamic, TABLE, {"featured": True})) == "ad"
    assert ids(where(dynamic, TABLE, {"year": {"$ne": 2025}})) == "bcef"
    assert ids(where(dynamic, TABLE, {"category": {"$gt": 3}})) == ""


def test_variant_numbers_and_types(spark):
    rows = [("a", '{"k": 5}'), ("b", '{"k": 5.7}'), ("c", '{"k": "5"}'), ("d", '{"k": true}'), ("e", '{"k": null}'), ("f", "{}"), ("g", '{"o": {"x": "y"}}')]
    df = spark.createDataFrame(rows, "id string, j string").select("id", F.parse_json("j").alias("metadata"))
    for condition, want in (
        ({"k": 5}, "a"), ({"k": {"$gt": 5}}, "b"), ({"k": "5"}, "c"), ({"k": True}, "d"), ({"k": None}, "efg"),
        ({"k": {"$in": [5, "5"]}}, "ac"), ({"k": {"$ne": 5}}, "bcdefg"), ({"o.x": "y"}, "g"), ({"k": {"$gte": 5.7}}, "b"),
    ):
        assert ids(where(df, TABLE, condition)) == want, condition


def test_json_text_is_read_as_metadata(spark):
    rows = [("a", '{"lang": "en", "n": 1}'), ("b", '{"lang": "de"}'), ("c", None), ("d", "not json")]
    df = spark.createDataFrame(rows, "id string, metadata string")
    assert ids(where(df, TABLE, {"lang": "en"})) == "a"
    assert ids(where(df, TABLE, {"lang": {"$ne": "en"}})) == "bcd"
    assert ids(where(df, TABLE, {"n": {"$gte": 1}})) == "a"


@pytest.mark.parametrize("kind", [None, "int", "array<int>"])
def test_unreadable_metadata_is_an_error(corpus, kind):
    df = corpus.drop("metadata") if kind is None else corpus.withColumn("metadata", F.lit(None).cast(kind))
    with pytest.raises(ValueError, match="needs metadata"):
        where(df, TABLE, {"lang": {"$ne": "en"}})


def test_variant_names_are_exact(spark):
    rows = [("a", """{"o'clock": 1, "oclock": 2, "x?": 3, "q\\"": 4}"""), ("b", '{"oclock": 1}')]
    df = spark.createDataFrame(rows, "id string, j string").select("id", F.parse_json("j").alias("metadata"))
    for condition, want in (({"o'clock": 1}, "a"), ({"oclock": 1}, "b"), ({"x?": 3}, "a"), ({'q"': 4}, "a"), ({"o'clock": 2}, "")):
        assert ids(where(df, TABLE, condition)) == want, condition


def test_list_fields(spark):
    rows = [("a", (["x", "y"], [1, 5])), ("b", (["z"], [])), ("c", (None, None)), ("d", None)]
    df = spark.createDataFrame(rows, "id string, metadata struct<tags array<string>, marks array<int>>")
    for condition, want in (
        ({"tags": "x"}, "a"), ({"tags": {"$in": ["z", "q"]}}, "b"), ({"tags": {"$ne": "x"}}, "bcd"), ({"marks": {"$gt": 4}}, "a"),
        ({"tags": {"$nin": ["x", "z"]}}, "cd"), ({"tags": {"$contains": "y"}}, "a"), ({"tags": ["z"]}, "b"), ({"marks": "x"}, ""), ({"tags": None}, "cd"),
    ):
        assert ids(where(df, TABLE, condition)) == want, condition
