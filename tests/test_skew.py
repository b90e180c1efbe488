"""One key holds a third of the rows: the work on it must spread over tasks, with whole results."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from vectable.operators import approx, delete, ingest, search
from vectable.sources.tables import save_snapshot, semi_filter
from vectable.table import VectorTable

TABLE = VectorTable(dims=4)
SMALL_PIECES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    n = F.col("id")
    third = n % 3 == 0
    rows = spark.range(30_000).select(
        F.format_string("r%06d", n).alias("id"),
        F.when(third, F.lit("hot")).otherwise(F.concat(F.lit("ns"), (n % 50).cast("string"))).alias("namespace"),
        F.when(third, F.lit("the same text")).otherwise(F.sha2(n.cast("string"), 256)).alias("text"),
        F.when(third, F.array(*[F.lit(0.5)] * 4)).otherwise(F.array(F.sin(n), F.cos(n), F.sin(n * 2), F.cos(n * 3))).cast("array<float>").alias("embedding"),
        F.struct((n % 7).alias("k")).alias("metadata"),
    )
    path = str(tmp_path_factory.mktemp("skew") / "t")
    rows.repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def executed(df):
    """Run and return (rows, final plan)."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_semi_join_on_a_hot_key_is_split(spark, skewed):
    wanted = skewed.filter("namespace IN ('hot', 'ns1')").select("namespace")
    with conf(spark, SMALL_PIECES):
        # AQE goes by bytes: the pad keeps the hot rows from compressing away
        padded = skewed.select("id", "namespace", F.sha2("id", 256).alias("pad"))
        rows, plan = executed(semi_filter(padded, "namespace", wanted, max_broadcast=0))
        assert "skew=true" in plan
    assert len(rows) == skewed.filter("namespace IN ('hot', 'ns1')").count()


def test_known_texts_with_a_hot_text_are_split(spark, skewed):
    known = skewed.filter("namespace = 'ns1'").limit(100)
    with conf(spark, SMALL_PIECES):
        batch = skewed.select("id", "text", F.sha2("id", 256).alias("pad"))
        rows, plan = executed(ingest.drop_known(batch, known, max_broadcast=0))
        assert "skew=true" in plan
    assert len(rows) == 29_900


def test_copies_take_their_edges_in_many_tasks(spark, skewed):
    few = approx.fits_broadcast
    with conf(spark, SMALL_PIECES):
        try:
            approx.fits_broadcast = lambda df, n: False
            rows, plan = executed(approx.knn_graph(skewed, TABLE, 3, engine="grid", cell_bytes=8 * 4 * 4000))
        finally:
            approx.fits_broadcast = few
        assert "skew=true" in plan
    assert len(rows) == 90_000
    hot = {r.src: [] for r in rows}
    for r in sorted(rows, key=lambda r: r["rank"]):
        hot[r.src].append(r.dst)
    assert hot["r000000"] == ["r000003", "r000006", "r000009"] and hot["r029997"] == ["r000000", "r000003", "r000006"]


def test_hot_partition_is_written_by_many_tasks(spark, skewed, tmp_path):
    with conf(spark, SMALL_PIECES | {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB"}):
        save_snapshot(skewed.withColumn("pad", F.sha2("id", 256)), str(tmp_path / "t"), partition_by=["namespace"])
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").iterdir() if d.is_dir()}
    hot = files.pop("namespace=hot")
    # Only what shares a shuffle partition with the hot namespace is split along with it.
    assert hot >= 2 and sorted(files.values())[len(files) // 2] == 1


def test_hot_namespace_search_is_whole(spark, skewed):
    table = VectorTable(dims=4, namespace="namespace")
    queries = spark.createDataFrame([(1, [0.5] * 4, "hot"), (2, [1.0, 0.0, 0.0, 0.0], "ns1")], "query_id long, query_vector array<float>, namespace string")
    for engine in ({}, {"engine": "grid", "cell_bytes": 8 * 4 * 500}, {"seed_fraction": 0.05}):
        hits = search.batch_topk(skewed, queries, table, 3, **engine).filter("query_id = 1").orderBy("rank").collect()
        assert [r.id for r in hits] == ["r000000", "r000003", "r000006"]


def test_counts_are_reduced_before_the_shuffle(skewed, plan_of):
    text = plan_of(delete.delete_counts(skewed, VectorTable(namespace="namespace")))
    assert "partial_count" in text
    text = plan_of(ingest.latest_per_id(skewed.withColumn("id", F.col("namespace")), TABLE, "text"))
    assert text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def test_small_batches_leave_the_table_in_place(spark, skewed, plan_of):
    batch = skewed.limit(20).withColumn("text", F.lit("new"))
    for out in (
        ingest.upsert_replace(skewed, batch, TABLE), delete.delete_by_ids(skewed, batch.select("id"), TABLE).kept,
        delete.delete_in_namespace(skewed, batch.select("id"), VectorTable(namespace="namespace"), namespace="hot").kept,
    ):
        text = plan_of(out)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
