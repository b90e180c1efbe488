import pytest
from pyspark.sql import functions as F

from vectable.functions.embedders import counts_of
from vectable.operators import delete, ingest, validate
from vectable.plans.ingest import ingest as ingest_batch
from vectable.table import VectorTable

TABLE = VectorTable(dims=3)
SPACED = VectorTable(dims=3, namespace="namespace")
KEYED = "id string, text string, embedding array<float>"


def by_id(df):
    return {r.id: r.asDict(recursive=True) for r in df.collect()}


MODEL = counts_of("e", "t")


def changes(corpus):
    new = corpus.filter("id IN ('a', 'c')").withColumn("id", F.concat("id", F.lit("2")))
    return corpus.filter("id IN ('b', 'd')").unionByName(new).withColumn("text", F.concat(F.lit("new "), "text"))


def test_embed(spark):
    df = spark.createDataFrame([("a", "a tree, the tent"), ("b", None), ("c", "né"), ("d", "")], "id string, text string")
    got = by_id(ingest.embed_corpus(df, TABLE, MODEL))
    assert got["a"]["embedding"] == [4.0, 4.0] and got["b"]["embedding"] is None
    assert got["c"]["embedding"] == got["d"]["embedding"] == [0.0, 0.0]
    assert ingest.embed_query(MODEL, "letter") == [2.0, 2.0]


def test_embedder_must_answer_every_text(spark):
    def short_model():
        return lambda texts: [[1.0]] * (len(texts) - 1)

    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string").coalesce(1)
    with pytest.raises(Exception, match="1 vectors for 2 texts"):
        ingest.embed_corpus(df, TABLE, short_model).collect()


def test_ids_are_kept_or_made(spark):
    rows = [("given", "o1"), (None, "o2"), ("  ", None), ("", " ")]
    df = spark.createDataFrame(rows, "id string, option string")
    got = [r.id for r in ingest.assign_ids(df, TABLE).collect()]
    assert got[0] == "given" and len(set(got)) == 4 and all(len(x) == 36 for x in got[1:])
    got = [r.id for r in ingest.assign_ids(df, TABLE, given=["option"]).collect()]
    assert got[:2] == ["o1", "o2"] and all(len(x) == 36 for x in got[2:])
    got = [r.id for r in ingest.assign_ids(df.drop("id"), TABLE).collect()]
    assert len(set(got)) == 4


def test_append_and_empty_batch(spark, corpus):
    batch = spark.createDataFrame([("z", "text z"), (None, "text n")], "id string, text string")
    out = ingest.append_documents(corpus, batch, TABLE)
    assert out.count() == 8 and by_id(out)["z"]["tenant"] is None
    assert ingest.append_documents(corpus, batch.limit(0), TABLE).count() == 6


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_upsert_replace(spark, corpus, limit):
    out = ingest.upsert_replace(corpus, changes(corpus).drop("tenant"), TABLE, max_broadcast=limit)
    got = by_id(out)
    assert sorted(got) == ["a", "a2", "b", "c", "c2", "d", "e", "f"] and out.count() == 8
    assert got["b"]["text"] == "new beta" and got["b"]["tenant"] is None and got["a"]["tenant"] == "x"
    again = ingest.upsert_replace(out, changes(corpus).drop("tenant"), TABLE, max_broadcast=limit)
    assert by_id(again) == got


@pytest.mark.parametrize("way", ["broadcast", "keys", "shuffle"])
def test_upsert_merge(spark, corpus, way, monkeypatch):
    if way == "keys":  # rows too wide to broadcast, keys small enough
        monkeypatch.setattr(ingest, "fits_broadcast", lambda df, n: df.columns == ["id"])
    batch = changes(corpus).select("id", "text", F.lit(None).cast("array<float>").alias("embedding"))
    out = ingest.upsert_merge(corpus, batch, TABLE, max_broadcast=0 if way == "shuffle" else 100)
    got = by_id(out)
    assert out.columns == corpus.columns and out.count() == 8
    assert got["b"]["text"] == "new beta" and got["b"]["embedding"] is None and got["b"]["tenant"] == "x"
    assert got["b"]["metadata"]["title"] == "ocean" and got["a"] == by_id(corpus)["a"]
    assert got["a2"]["text"] == "new alpha" and got["a2"]["metadata"] is None and got["a2"]["tenant"] is None
    with pytest.raises(ValueError):
        ingest.upsert_merge(corpus, batch, TABLE, ["metadata"])


def test_upsert_embeddings_keeps_text(spark, corpus):
    batch = spark.createDataFrame([("a", [0.0, 0.0, 9.0]), ("n", [1.0, 0.0, 0.0])], "id string, embedding array<float>")
    got = by_id(ingest.upsert_embeddings(corpus, batch, TABLE))
    assert got["a"]["embedding"] == [0.0, 0.0, 9.0] and got["a"]["text"] == "alpha"
    assert got["n"]["text"] is None and len(got) == 7


@pytest.mark.parametrize("limit", [0, 100])
def test_upsert_by_namespace_and_id(spark, corpus, limit):
    batch = spark.createDataFrame(
        [("t1", "a", "changed"), ("t2", "a", "other")], "namespace string, id string, text string"
    )
    out = ingest.upsert_merge(corpus, batch, SPACED, max_broadcast=limit)
    got = {(r.namespace, r.id): r.text for r in out.collect()}
    assert got["t1", "a"] == "changed" and got["t2", "a"] == "other" and len(got) == 7


def test_latest_per_id(spark):
    df = spark.createDataFrame([("a", "t1", 1), ("a", "t1", 3), ("a", "t2", 2), ("b", "t1", 1)], "id string, namespace string, ord long")
    assert sorted((r.id, r.ord) for r in ingest.latest_per_id(df, TABLE).collect()) == [("a", 3), ("b", 1)]
    assert ingest.latest_per_id(df, SPACED).count() == 3


def test_latest_per_id_cuts_before_the_shuffle(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("id"), F.col("id").alias("ord"))
    text = plan_of(ingest.latest_per_id(df, TABLE))
    assert text.count("WindowGroupLimit") >= 2


def test_known_documents_never_reach_the_embedder(spark):
    def picky_model():
        def run(texts):
            assert "skip" not in texts and "stored" not in texts
            return [[1.0] for _ in texts]

        return run

    batch = spark.createDataFrame(
        [("1", "keep", None), ("2", "skip", True), ("3", "stored", False), ("4", "keep", False)], "id string, text string, dup boolean"
    )
    known = spark.createDataFrame([("stored",), ("stored",), (None,)], "text string")
    out = ingest.drop_known(batch, known, duplicate=F.col("dup"))
    assert sorted(by_id(ingest.embed_corpus(out, TABLE, picky_model))) == ["1", "4"]
    assert ingest.drop_known(batch).count() == 4


def test_validate_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        ("ok", [1.0, 2.0, 3.0]), ("zero", [0.0] * 3), ("short", [1.0]), ("long", [1.0] * 4), ("null", None),
        ("hole", [1.0, None, 2.0]), ("nan", [nan, 1.0, 2.0]), ("inf", [1.0, inf, 2.0]), ("-inf", [1.0, -inf, 2.0]),
    ]
    df = spark.createDataFrame(rows, "id string, embedding array<float>")
    out = validate.validate_vectors(df, TABLE)
    assert sorted(by_id(out.valid)) == ["ok", "zero"]
    assert {r.id: r.reason for r in out.rejects.collect()} == {
        "short": "wrong dimensions", "long": "wrong dimensions", "null": "missing vector", "hole": "not finite",
        "nan": "not finite", "inf": "not finite", "-inf": "not finite",
    }
    with pytest.raises(validate.InvalidRows):
        validate.validate_vectors(df, TABLE, mode="strict")
    assert validate.validate_vectors(out.valid, TABLE, mode="strict").rejects.count() == 0
    with pytest.raises(ValueError):
        validate.validate_vectors(df, TABLE, mode="loose")


def test_validate_rows(spark, corpus):
    df = corpus.withColumn("id", F.when(F.col("id") == "b", F.lit(" ")).otherwise(F.col("id")))
    out = validate.validate_rows(df, TABLE)
    assert sorted(by_id(out.valid)) == ["a", "c", "d", "e", "f"]  # e has a vector only, and no metadata
    assert [(r.id, r.reason) for r in out.rejects.collect()] == [(" ", "blank key")]
    bare = validate.validate_rows(df.drop("embedding", "metadata"), TABLE)
    assert {(r.id, r.reason) for r in bare.rejects.collect()} == {(" ", "blank key"), ("e", "neither text nor vector")}
    numbers = validate.validate_rows(df.withColumn("text", F.lit(42)), TABLE)
    assert {r.reason for r in numbers.rejects.collect()} == {"blank key", "text is not a string"}
    wrong = corpus.withColumn("metadata", F.lit("invalid"))
    assert validate.validate_rows(wrong, TABLE).valid.count() == 0
    dynamic = corpus.withColumn("metadata", F.parse_json(F.when(F.col("id") == "a", F.lit("[1]")).otherwise(F.lit('{"k": 1}'))))
    assert sorted(by_id(validate.validate_rows(dynamic, TABLE).valid)) == ["b", "c", "d", "e", "f"]


# ---- structs by name, one row per key, one evaluation ------------------------------------------------


@pytest.mark.parametrize("limit", [0, 100])
def test_merge_matches_struct_fields_by_name(spark, corpus, limit):
    batch = spark.createDataFrame([("a", "new", ("extra", "blog")), ("n", "new", ("more", "news"))], "id string, text string, metadata struct<added string, category string>")
    got = by_id(ingest.upsert_merge(corpus, batch, TABLE, max_broadcast=limit))
    assert got["a"]["metadata"] == {"category": "blog", "year": None, "featured": None, "priority": None, "title": None, "added": "extra"}
    assert got["n"]["metadata"]["category"] == "news" and got["n"]["metadata"]["added"] == "more"
    assert got["b"]["metadata"]["year"] == 2024 and got["b"]["metadata"]["added"] is None and got["e"]["metadata"] is None
    assert got["a"]["tenant"] == "x" and len(got) == 7


@pytest.mark.parametrize("limit", [0, 100])
def test_rows_without_text_may_refresh_the_vector_only(spark, corpus, limit):
    batch = corpus.filter("id IN ('a', 'b')").select(
        "id", F.when(F.col("id") == "b", F.lit("set")).alias("text"), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)).cast("array<float>").alias("embedding"),
        F.lit(None).cast(corpus.schema["metadata"].dataType).alias("metadata"),
    )
    got = by_id(ingest.upsert_merge(corpus, batch, TABLE, keep_text=True, max_broadcast=limit))
    assert got["a"]["text"] == "alpha" and got["a"]["metadata"]["year"] == 2025 and got["a"]["embedding"] == [0.0, 0.0, 1.0]
    assert got["b"]["text"] == "set" and got["b"]["metadata"] is None
    assert by_id(ingest.upsert_merge(corpus, batch, TABLE, max_broadcast=limit))["a"]["text"] is None


@pytest.mark.parametrize("put", [ingest.upsert_replace, ingest.upsert_merge])
def test_a_repeated_key_is_an_error(corpus, put):
    with pytest.raises(ValueError, match="occurs twice"):
        put(corpus, changes(corpus).union(changes(corpus)), TABLE)


@pytest.mark.parametrize("put", [ingest.upsert_replace, ingest.upsert_merge])
def test_the_model_runs_once_per_row(spark, corpus, put, tmp_path):
    calls = str(tmp_path)

    def counted():
        import uuid

        def run(texts):
            with open(f"{calls}/{uuid.uuid4().hex}", "w") as file:
                file.write(str(len(texts)))
            return [[1.0, 0.0, 0.0]] * len(texts)

        return run

    batch = validate.validate_vectors(ingest.embed_corpus(changes(corpus).drop("embedding"), TABLE, counted), TABLE).valid
    put(corpus, batch, TABLE).collect()
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 4


def test_latest_does_not_depend_on_partitioning(spark):
    rows = [("k", n, {"m": str(n)}, None if n % 2 else 5) for n in range(40)] + [("j", 1, None, None)]
    df = spark.createDataFrame(rows, "id string, n int, more map<string,string>, ord int")
    found = {tuple(sorted((r.id, r.n) for r in ingest.latest_per_id(df.repartition(p), VectorTable(), order).collect())) for p in (1, 3, 7) for order in ("ord",)}
    assert len(found) == 1 and dict(next(iter(found)))["k"] % 2 == 0
    found = {tuple(sorted((r.id, r.n) for r in ingest.latest_per_id(df.repartition(p), VectorTable(), None).collect())) for p in (1, 3, 7)}
    assert len(found) == 1 and len(next(iter(found))) == 2


def test_ingest_without_metadata_and_mixed_rows(spark):
    table = VectorTable(dims=2)
    current = spark.createDataFrame([("a", "old", [9.0, 9.0], ("en",))], "id string, text string, embedding array<float>, metadata struct<lang string>")
    out = ingest_batch(current, spark.createDataFrame([("b", "tee"), ("b", "tee two")], "id string, text string"), table, model=MODEL)
    got = by_id(out.table)
    assert got.keys() == {"a", "b"} and got["b"]["metadata"] is None and out.rejects.count() == 0
    rows = [("a", None, [1.0, 2.0]), ("c", None, [3.0, 4.0]), ("d", "tree", None), ("e", None, None)]
    out = ingest_batch(current, spark.createDataFrame(rows, "id string, text string, embedding array<float>"), table, model=MODEL, merge=True)
    got = by_id(out.table)
    assert (got["a"]["text"], got["a"]["embedding"], got["a"]["metadata"]) == ("old", [1.0, 2.0], {"lang": "en"})
    assert got["c"]["text"] is None and got["c"]["embedding"] == [3.0, 4.0] and got["d"]["embedding"] == [2.0, 1.0]
    assert [(r.id, r.reason) for r in out.rejects.collect()] == [("e", "neither text nor vector")]


# ---- deletes --------------------------------------------------------------------------------------


def names(df):
    return "".join(sorted(r.id for r in df.collect()))


@pytest.mark.parametrize("limit", [0, 100])
def test_delete_by_ids(spark, corpus, limit):
    listed = spark.createDataFrame([("a",), ("a",), ("c",), ("nope",)], "id string")
    out = delete.delete_by_ids(corpus, listed, TABLE, max_broadcast=limit)
    assert names(out.kept) == "bdef" and names(out.gone) == "ac" and out.count() == 2
    none = delete.delete_by_ids(corpus, listed.limit(0), TABLE, max_broadcast=limit)
    assert names(none.kept) == "abcdef" and none.count() == 0


def test_delete_by_filter_keeps_unknown_rows(corpus):
    out = delete.delete_by_filter(corpus, {"featured": True}, TABLE)
    assert names(out.kept) == "bcef" and names(out.gone) == "ad"
    for empty in ({}, None):
        with pytest.raises(ValueError):
            delete.delete_by_filter(corpus, empty, TABLE)


def test_delete_needs_namespace_ids_and_filter_at_once(spark, corpus):
    listed = spark.createDataFrame([("a",), ("c",), ("d",)], "id string")
    out = delete.delete_in_namespace(corpus, listed, SPACED, namespace="t2", condition={"featured": True})
    assert names(out.gone) == "d" and names(out.kept) == "abcef"
    out = delete.delete_in_namespace(corpus, listed, SPACED, namespace="t2")
    assert names(out.gone) == "cd"
    with pytest.raises(ValueError):
        delete.delete_in_namespace(corpus, None, SPACED, namespace="t2")
    with pytest.raises(ValueError):
        delete.delete_in_namespace(corpus, listed, TABLE, namespace="t2")


def test_delete_all_is_explicit(corpus):
    out = delete.delete_all(corpus, SPACED, namespace="t2")
    assert names(out.kept) == "abf" and {r.namespace: r.deleted for r in delete.delete_counts(out.gone, SPACED).collect()} == {"t2": 3}
    assert names(delete.delete_all(corpus, SPACED, namespace="t2", condition={"year": 2025}).gone) == "d"
    everything = delete.delete_all(corpus, TABLE)
    assert everything.kept.count() == 0 and delete.delete_counts(everything.gone, TABLE).first().deleted == 6


def test_delete_after_upsert_leaves_no_key(spark, corpus):
    batch = changes(corpus)
    after = ingest.upsert_replace(corpus, batch, TABLE)
    left = delete.delete_by_ids(after, batch.select("id"), TABLE).kept
    assert names(left) == "acef"


# ---- the whole way --------------------------------------------------------------------------------


def test_ingest(spark, corpus):
    rows = [
        ("a", "updated", 1), ("a", "updated twice", 2), (None, "fresh", 1), ("x", "alpha", 1), ("y", None, 1),
    ]
    batch = spark.createDataFrame(rows, "id string, text string, ord long").withColumn(
        "metadata", F.struct(F.lit("made").alias("category"))
    )
    table = VectorTable(dims=2)
    current = corpus.select("id", "text", F.struct("metadata.category").alias("metadata"), "tenant").withColumn(
        "embedding", F.array(F.lit(0.0), F.lit(1.0)).cast("array<float>")
    )
    out = ingest_batch(current, batch, table, model=MODEL, skip_known=True, order="ord", merge=True)
    got = {r.text: r for r in out.table.collect()}
    assert out.table.count() == 7 and got["updated twice"].id == "a" and got["updated twice"].tenant == "x"
    assert got["fresh"].embedding == [1.0, 0.0] and len(got["fresh"].id) == 36
    assert got["fresh"].id in {r.id for r in out.batch.collect()}  # drawn once
    assert [(r.id, r.reason) for r in out.rejects.collect()] == [("y", "neither text nor vector")]


@pytest.mark.parametrize("merge", [False, True])
def test_upsert_rewrites_only_touched_buckets(spark, corpus, tmp_path, merge):
    path = str(tmp_path / "t")
    corpus.withColumn("bucket", ingest.bucket_of(TABLE, 16)).write.partitionBy("bucket").parquet(path)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    batch = changes(corpus).filter("id IN ('b', 'a2')")
    out = ingest.upsert_buckets(spark, path, batch, TABLE, 16, merge=merge)
    got, want = by_id(out.drop("bucket").select(*corpus.columns)), by_id((ingest.upsert_merge if merge else ingest.upsert_replace)(corpus, batch, TABLE))
    assert got == want and out.count() == 7
    after = {f.name for f in (tmp_path / "t").rglob("*.parquet")}
    touched = {r[0] for r in batch.select(ingest.bucket_of(TABLE, 16)).collect()}
    untouched = corpus.filter(~ingest.bucket_of(TABLE, 16).isin(touched)).count()
    assert untouched and len(set(before) & after) >= 1
    assert ingest.upsert_buckets(spark, path, batch.limit(0), TABLE, 16).count() == 7


@pytest.mark.parametrize("limit", [0, 100])
def test_known_texts_either_way(spark, corpus, limit):
    batch = corpus.filter("id IN ('a', 'b', 'e')").withColumn("id", F.concat("id", F.lit("9")))
    assert names(ingest.drop_known(batch, corpus.filter("id <> 'b'"), max_broadcast=limit)) == "b9e9"


def test_keys_with_a_namespace_in_lists(spark, corpus):
    from vectable.operators.fetch import get_by_ids

    both = corpus.unionByName(corpus.filter("id = 'a'").withColumn("namespace", F.lit("t2")))
    listed = spark.createDataFrame([("t2", "a"), ("t1", "b")], "namespace string, id string")
    out = delete.delete_by_ids(both, listed, SPACED)
    assert {(r.namespace, r.id) for r in out.gone.collect()} == {("t2", "a"), ("t1", "b")} and out.kept.count() == 5
    assert get_by_ids(both, listed, SPACED).count() == 2
    assert get_by_ids(both, listed.select("id"), SPACED).count() == 3
