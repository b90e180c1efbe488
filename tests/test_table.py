import pytest
from pyspark.sql import functions as F

from vectable.functions.vectors import cosine, inner_product, is_valid, l2_distance, normalised, query_nearness, score
from vectable.sources.tables import corpus_scan, fits_broadcast, save_bucketed, save_snapshot, semi_filter
from vectable.table import VectorTable, check_vector


@pytest.mark.parametrize(
    "bad",
    [
        {"text": ""}, {"id": " "}, {"embedding": "$v"}, {"metadata": "a\0b"}, {"text": "x", "embedding": "x"},
        {"dims": 0}, {"dims": -1}, {"metric": "cosine"}, {"namespace": "$ns"},
    ],
)
def test_bad_tables_are_rejected(bad):
    with pytest.raises(ValueError):
        VectorTable(**bad)


@pytest.mark.parametrize("bad", [[], [float("nan"), 1.0], [float("inf"), 1.0], [1.0]])
def test_bad_query_vectors_are_rejected(bad):
    with pytest.raises(ValueError):
        check_vector(bad, 2)


def test_column_types_are_checked(spark, corpus):
    table = VectorTable()
    assert table.check(corpus, need=("id", "text", "embedding", "metadata")) is corpus
    for column, value in (("text", F.lit(42)), ("metadata", F.lit("invalid")), ("metadata", F.array()), ("embedding", F.lit("x"))):
        with pytest.raises(ValueError):
            table.check(corpus.withColumn(column, value), need=(column,))
    with pytest.raises(ValueError):
        table.check(corpus.drop("id"))


def test_vector_column_must_be_chosen_when_ambiguous(spark, corpus):
    two = corpus.select("id", F.col("embedding").alias("one"), F.col("embedding").alias("two"))
    with pytest.raises(ValueError):
        VectorTable().vector_path(two)
    assert VectorTable().vector_path(two, "two") == "two"
    assert VectorTable().vector_path(two.drop("one")) == "two"
    with pytest.raises(ValueError):
        VectorTable().vector_path(two, "id")


def test_scores(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    got = row.select(
        cosine(a, b), l2_distance(a, b), inner_product(a, b), cosine(a, z), score("L2", a, b), normalised(z), normalised(a)
    ).first()
    assert got[0] == pytest.approx(0.96) and got[1] == pytest.approx(2**0.5) and got[2] == 24.0
    assert got[3] == 0.0 and got[4] == pytest.approx(1 / (1 + 2**0.5))
    assert got[5] == [0.0, 0.0] and got[6] == pytest.approx([0.6, 0.8])


def test_query_nearness_skips_unusable_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [float("nan"), 1.0]), (5, [0.0, 0.0]), (6, [1.0, None])]
    df = spark.createDataFrame(rows, "id int, v array<float>").coalesce(1)
    got = {r.id: r.s for r in df.select("id", query_nearness(F.col("v"), [2.0, 0.0]).alias("s")).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: None, 5: 0.0, 6: None}


def test_is_valid_never_gives_null(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], True), (2, None, False), (3, [1.0], False), (4, [1.0, 2.0, 3.0], False), (5, [nan, 1.0], False),
        (6, [inf, 1.0], False), (7, [-inf, 1.0], False), (8, [None, 1.0], False), (9, [None, None], False), (10, [], False),
        (11, [0.0, 0.0], True),
    ]
    df = spark.createDataFrame(rows, "id int, v array<float>, want boolean")
    assert df.filter(is_valid(F.col("v"), 2) != F.col("want")).count() == 0
    assert df.filter(is_valid(F.col("v"), 2).isNull()).count() == 0


def test_scan_prunes_columns(spark, corpus, tmp_path, plan_of):
    saved = save_snapshot(corpus, str(tmp_path / "t"))
    assert saved.schema == corpus.schema
    text = plan_of(corpus_scan(spark, str(tmp_path / "t"), ["id", "text"]))
    assert "ReadSchema: struct<id:string,text:string>" in text
    typed = corpus_scan(spark, str(tmp_path / "t"), schema="id string, tenant string")
    assert typed.columns == ["id", "tenant"] and typed.count() == 6


def test_partitioned_snapshot_keeps_rows_and_prunes(spark, corpus, tmp_path, plan_of):
    numbered = corpus.withColumn("list_id", F.length("id"))
    saved = save_snapshot(numbered, str(tmp_path / "t"), partition_by=["namespace"], sort_by=["id"])
    assert saved.select(*numbered.columns).exceptAll(numbered).count() == 0
    assert "PartitionFilters: [isnotnull(namespace" in plan_of(saved.filter("namespace = 't1'"))


def test_snapshots_are_not_overwritten(spark, corpus, tmp_path):
    save_snapshot(corpus, str(tmp_path / "t"))
    with pytest.raises(Exception, match="already exists"):
        save_snapshot(corpus, str(tmp_path / "t"))


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)
    assert not fits_broadcast(spark.range(10), 10, max_bytes=20)
    assert fits_broadcast(spark.range(0))
    wide = spark.range(4).select(
        "id", F.repeat(F.lit("é"), 500).alias("text"), F.array_repeat(F.lit(1.0), 100).alias("v"), F.lit(None).cast("string").alias("none"),
        F.struct(F.lit("abc").alias("s"), F.lit(1).alias("n")).alias("st"), F.array(F.lit("x"), F.lit("y")).alias("tags"),
        F.create_map(F.lit("k"), F.lit("v")).alias("m"), F.parse_json(F.lit('{"a": 1}')).alias("var"), F.current_date().alias("d"),
    )
    assert fits_broadcast(wide, 4, max_bytes=4 * 2200) and not fits_broadcast(wide, 4, max_bytes=4 * 1800)


def test_bucketed_table_is_not_shuffled(spark, corpus, plan_of):
    from vectable.operators.ingest import upsert_replace

    table = VectorTable()
    saved = save_bucketed(corpus, "bucketed_docs", table, 4)
    try:
        batch = corpus.filter("id = 'a'").withColumn("text", F.lit("new"))
        out = upsert_replace(saved, batch, table, max_broadcast=0)
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert plan_of(out).count("Exchange\n") <= 1 and "SortMergeJoin LeftAnti" in plan_of(out)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert {r.id: r.text for r in out.collect()}["a"] == "new"
    finally:
        spark.sql("DROP TABLE bucketed_docs")


def test_semi_filter(spark, corpus):
    wanted = spark.createDataFrame([("news",), ("news",), ("none",)], "v string")
    for limit in (0, 100):
        out = semi_filter(corpus, "metadata.category", wanted, max_broadcast=limit)
        assert sorted(r.id for r in out.collect()) == ["a", "b"]


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_row_key_sorts_as_the_key_does(spark, kind):
    table = VectorTable(namespace="namespace")
    spaces = [None, "", "a", "a\0b", "a\1b", "a\1", "=", "\0"]
    numbers = [-5, -1, 0, 9, 10, 2**31 - 1]
    rows = [(s, str(n)) for s in spaces for n in numbers]
    df = spark.createDataFrame(rows, "namespace string, id string").withColumn("id", F.col("id").cast(kind))
    keyed = df.withColumn("key", table.row_key())
    back = table.split_key(keyed.select("key", F.col("namespace").alias("n0"), F.col("id").alias("i0")), "key", df).collect()
    assert all(r.namespace == r.n0 and r.key == r.i0 for r in back) and len({r.key for r in keyed.collect()}) == len(rows)
    if kind != "string":
        one = [r.id for r in keyed.filter("namespace = 'a'").orderBy("key").collect()]
        assert one == numbers


def test_clear_settled(spark):
    from pathlib import Path

    from vectable.sources.tables import checkpoint_dir, clear_settled, settle

    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    kept = folder / "other"
    kept.mkdir(exist_ok=True)
    settle(spark.range(3))
    assert list(folder.glob("settled-*"))
    clear_settled(spark)
    assert not list(folder.glob("settled-*")) and kept.exists()
