import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_search import QUERY, brute, found, make
from vectable.operators import approx, search
from vectable.sources.tables import save_snapshot
from vectable.table import VectorTable

TABLE = VectorTable(dims=8)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(i, r.embedding) for i, r in enumerate(make(spark, 40, seed=11, bad=False).collect())], QUERY)


@pytest.mark.parametrize(
    ("kind", "bad"),
    [
        (approx.IVF, {"num_lists": 0}), (approx.IVF, {"nprobes": 0}), (approx.HNSW, {"m": 1}), (approx.HNSW, {"m": 101}),
        (approx.HNSW, {"ef_construction": 3}), (approx.HNSW, {"ef_construction": 1001}), (approx.HNSW, {"m": 33}),
        (approx.HNSW, {"ef_search": 0}), (approx.DISKANN, {"max_degree": 19}), (approx.DISKANN, {"max_degree": 2049}),
        (approx.DISKANN, {"l_build": 9}), (approx.DISKANN, {"l_build": 501}), (approx.DISKANN, {"l_search": 9}),
        (approx.DISKANN, {"l_search": 1001}), (approx.IVF, {"m": 16}), ("other", {}),
    ],
)
def test_option_ranges(kind, bad):
    with pytest.raises(ValueError):
        approx.Tuning.of(kind, **bad)


def test_option_defaults():
    assert approx.Tuning.of(approx.IVF).values == {"num_lists": 1, "nprobes": 1}
    hnsw, disk = approx.Tuning.of(approx.HNSW), approx.Tuning.of(approx.DISKANN, l_search=80)
    assert (hnsw.degree, hnsw.build_candidates, hnsw.search_candidates) == (16, 64, 40)
    assert (disk.degree, disk.build_candidates, disk.search_candidates) == (32, 50, 80)


@pytest.mark.parametrize("metric", ["COS", "L2", "IP"])
def test_all_probes_equal_exact_search(spark, queries, metric):
    corpus, table = make(spark), VectorTable(dims=8, metric=metric)
    centroids = approx.train_centroids(corpus, table, 6)
    indexed = approx.ivf_assign(corpus, centroids, table)
    assert indexed.filter("list_id IS NULL").count() == 3  # null, short, nan
    exact = found(search.batch_topk(corpus, queries, table, 5))
    assert found(approx.ivf_search(indexed, queries, centroids, table, 5, 6)) == exact
    assert found(approx.ivf_search(indexed, queries, centroids, table, 5, 99)) == exact
    few = found(approx.ivf_search(indexed, queries, centroids, table, 5, 2))
    assert few == found(approx.ivf_search(indexed, queries, centroids, table, 5, 2, shared_centroid_bytes=1))
    assert few == found(approx.ivf_search(indexed, queries, centroids, table, 5, 2, engine="grid", cell_bytes=8 * 8 * 30))
    lists = {r.id: r.list_id for r in indexed.collect()}
    assert all(len({lists[i] for i in ids}) <= 2 for ids in few.values())


def test_one_list_is_exact_and_the_default(spark, queries):
    corpus = make(spark)
    centroids = approx.train_centroids(corpus, TABLE)
    assert centroids.count() == 1
    indexed = approx.ivf_assign(corpus, centroids, TABLE)
    assert found(approx.ivf_search(indexed, queries, centroids, TABLE, 5)) == found(search.batch_topk(corpus, queries, TABLE, 5))
    with pytest.raises(ValueError):
        approx.train_centroids(corpus, TABLE, 0)


def test_assignment_in_a_grid_is_the_same(spark):
    corpus = make(spark)
    centroids = approx.train_centroids(corpus, TABLE, 6, sample_fraction=0.5)
    one = {r.id: r.list_id for r in approx.ivf_assign(corpus, centroids, TABLE).collect()}
    two = {r.id: r.list_id for r in approx.ivf_assign(corpus, centroids, TABLE, shared_bytes=1).collect()}
    assert one == two


def test_only_probed_partitions_are_read(spark, queries, tmp_path, plan_of):
    corpus = make(spark)
    centroids = approx.train_centroids(corpus, TABLE, 6)
    saved = save_snapshot(approx.ivf_assign(corpus, centroids, TABLE), str(tmp_path / "ivf"), partition_by=["list_id"])
    hits = approx.ivf_search(saved, queries.limit(1), centroids, TABLE, 5)
    partition_filter = plan_of(hits).split("PartitionFilters: ")[1].split("\n")[0]
    assert "list_id" in partition_filter and hits.count() == 5


def test_enough_candidates_equal_exact_search(spark, queries):
    corpus = make(spark)
    planes = approx.random_planes(spark, 8, 100)
    exact = found(search.batch_topk(corpus, queries, TABLE, 5))
    assert found(approx.candidate_rerank(corpus, queries, planes, TABLE, 5, 10_000)) == exact
    stored = approx.add_sketch(corpus, planes)
    few = approx.candidate_rerank(stored, queries, planes, TABLE, 5, 30, sketch_col="sketch", max_queries=40)
    assert found(few) == found(approx.candidate_rerank(corpus, queries, planes, TABLE, 5, 30))
    recall = np.mean([len(set(ids) & set(exact[q])) / 5 for q, ids in found(few).items()])
    assert recall > 0.8
    with pytest.raises(ValueError):
        approx.candidate_rerank(corpus, queries, planes, TABLE, 5, 0)


def test_sketch_bits(spark):
    axes = spark.createDataFrame([(i, [1.0 if i == j else 0.0 for j in range(70)]) for i in range(70)], "plane_id int, plane array<double>")
    rows = [(1, [1.0 if j in (0, 3, 65) else -1.0 for j in range(70)]), (2, None), (3, [0.0] * 70)]
    out = approx.add_sketch(spark.createDataFrame(rows, "id int, embedding array<float>"), axes)
    assert {r.id: r.sketch for r in out.collect()} == {1: [9, 2], 2: None, 3: [0, 0]}


def edges(df):
    return found(df, "src", "dst")


def as_queries(corpus):
    return corpus.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"), "grp")


@pytest.mark.parametrize("engine", [{}, {"engine": "grid", "cell_bytes": 8 * 8 * 50}], ids=["shared", "grid"])
def test_graph_is_exact(spark, engine):
    corpus = make(spark, 150, copies=70)  # a third of the rows are copies
    good = corpus.filter("embedding IS NOT NULL AND size(embedding) = 8 AND NOT isnan(embedding[0])")
    want = brute(good, as_queries(good), 6, "COS", lambda q, r: q.query_id != r.id)
    assert edges(approx.knn_graph(corpus, TABLE, 6, **engine)) == want
    few = approx.fits_broadcast
    try:  # many groups of copies: their lists are not broadcast
        approx.fits_broadcast = lambda df, n: False
        assert edges(approx.knn_graph(corpus, TABLE, 6, **engine)) == want
    finally:
        approx.fits_broadcast = few
    want = brute(good, as_queries(good), 6, "COS", lambda q, r: q.query_id != r.id and q.grp == r.grp)
    assert edges(approx.knn_graph(corpus, TABLE, 6, within="grp", **engine)) == {q: ids for q, ids in want.items() if ids}


def test_graph_from_candidates(spark):
    corpus = make(spark, 150, bad=False)
    planes = approx.random_planes(spark, 8, 128)
    exact = edges(approx.knn_graph(corpus, TABLE, 6))
    assert edges(approx.knn_graph(corpus, TABLE, 6, 500, planes=planes)) == exact
    rough = edges(approx.knn_graph(corpus, TABLE, 6, 30, planes=planes))
    assert np.mean([len(set(rough[i]) & set(exact[i])) / 6 for i in exact]) > 0.8
    with pytest.raises(ValueError):
        approx.knn_graph(corpus, TABLE, 6, 30)
    with pytest.raises(ValueError):
        approx.knn_graph(corpus, TABLE, 6, 5, planes=planes)


def test_keys_with_a_namespace(spark):
    rows = [("t1", "a", [1.0, 0.0]), ("t2", "a", [0.9, 0.1]), ("t2", "b", [0.0, 1.0])]
    corpus = spark.createDataFrame(rows, "namespace string, id string, embedding array<float>")
    table = VectorTable(dims=2, namespace="namespace")
    graph = approx.knn_graph(corpus, table, 1)
    got = {(r.src_namespace, r.src): (r.dst_namespace, r.dst) for r in graph.collect()}
    assert got == {("t1", "a"): ("t2", "a"), ("t2", "a"): ("t1", "a"), ("t2", "b"): ("t2", "a")}
    inside = approx.knn_graph(corpus, table, 1, within="namespace")
    assert {(r.src_namespace, r.src): r.dst for r in inside.collect()} == {("t2", "a"): "b", ("t2", "b"): "a"}
    asked = spark.createDataFrame([(1, [1.0, 0.0])], QUERY)
    planes = approx.random_planes(spark, 2, 64)
    hits = approx.candidate_rerank(corpus, asked, planes, table, 2, 3).orderBy("rank").collect()
    assert [(r.namespace, r.id) for r in hits] == [("t1", "a"), ("t2", "a")]
    centroids = approx.train_centroids(corpus, table)
    for limit in (1, 10**6):
        indexed = approx.ivf_assign(corpus, centroids, table, shared_bytes=limit)
        assert indexed.count() == 3 and indexed.filter("list_id = 0").count() == 3
