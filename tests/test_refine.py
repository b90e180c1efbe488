"""The refined graph: recall against the exact one, pairs compared, copies, odd tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tests.test_approx import edges
from tests.test_search import make
from vectable.operators import approx, refine
from vectable.operators.refine import knn_graph_refined, whole_groups
from vectable.table import VectorTable

TABLE = VectorTable(dims=16)


def clustered(spark, n, copies=0, dims=16, clusters=60):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((clusters, dims)) * 2
    vectors = (centres[rng.integers(0, clusters, n)] + rng.standard_normal((n, dims))).astype(np.float32)
    vectors[:copies] = vectors[0]
    return spark.createDataFrame([(f"r{i:05d}", v) for i, v in enumerate(vectors.tolist())], "id string, embedding array<float>").repartition(6)


def recall(got, want):
    return sum(len(set(got.get(q, [])) & set(ids)) for q, ids in want.items()) / sum(len(ids) for ids in want.values())


@pytest.mark.parametrize("metric", ["COS", "L2"])
def test_recall_with_few_pairs(spark, metric):
    table, corpus = VectorTable(dims=16, metric=metric), clustered(spark, 2_500)
    refined = knn_graph_refined(corpus, table, 8)
    exact = approx.knn_graph(corpus, table, 8)
    assert recall(edges(refined.edges), edges(exact)) > 0.95
    assert refined.compared < 0.6 * 2_500 * 2_499 / 2  # at 20,000 rows it is under a tenth
    assert refined.rounds < 12
    scores = {(r.src, r.dst): r.score for r in exact.collect()}
    assert all(scores[r.src, r.dst] == r.score for r in refined.edges.collect() if (r.src, r.dst) in scores)


def test_pairs_grow_far_slower_than_the_square(spark):
    small, large = (knn_graph_refined(clustered(spark, n), TABLE, 6, max_rounds=2).compared for n in (1_000, 4_000))
    assert large < 8 * small  # the square would be 16 times


def test_copies_are_refined_once(spark):
    corpus = clustered(spark, 900, copies=300)
    refined = knn_graph_refined(corpus, TABLE, 6)
    got, want = edges(refined.edges), edges(approx.knn_graph(corpus, TABLE, 6))
    assert len(got) == 900 and all(len(ids) == 6 for ids in got.values())
    copies = [f"r{i:05d}" for i in range(300)]
    assert all(got[i] == want[i] for i in copies)
    assert recall(got, want) > 0.95


def test_small_and_odd_tables(spark):
    corpus = make(spark, 30)  # null, short, NaN and zero vectors among them
    table = VectorTable(dims=8)
    assert edges(knn_graph_refined(corpus, table, 5).edges) == edges(approx.knn_graph(corpus, table, 5))  # one block: all pairs
    empty = knn_graph_refined(corpus.limit(0), table, 5)
    assert empty.edges.collect() == [] and empty.compared == 0
    lonely = knn_graph_refined(corpus.filter("id = 'r00001'"), table, 5)
    assert lonely.edges.collect() == []
    for bad in ({"pool": 3}, {"sample": 0}):
        with pytest.raises(ValueError):
            knn_graph_refined(corpus, table, 5, **bad)


def test_graph_of_a_table_with_a_namespace(spark):
    rows = [("t1", "a", [1.0, 0.0]), ("t2", "a", [0.9, 0.1]), ("t2", "b", [0.0, 1.0])]
    corpus = spark.createDataFrame(rows, "namespace string, id string, embedding array<float>")
    graph = knn_graph_refined(corpus, VectorTable(dims=2, namespace="namespace"), 1).edges
    got = {(r.src_namespace, r.src): (r.dst_namespace, r.dst) for r in graph.collect()}
    assert got == {("t1", "a"): ("t2", "a"), ("t2", "a"): ("t1", "a"), ("t2", "b"): ("t2", "a")}


def test_groups_are_never_cut():
    keys = ["a"] * 3 + ["b"] + ["c"] * 5 + ["d"] * 2
    batches = [pa.record_batch({"k": keys[i : i + 2], "n": list(range(len(keys)))[i : i + 2]}) for i in range(0, len(keys), 2)]
    seen = []
    for table, ends in whole_groups(iter(batches), at_least=3):
        for low, high in zip(ends[:-1], ends[1:]):
            part = table.slice(int(low), int(high - low))
            assert len(set(part["k"].to_pylist())) == 1
            seen.append((part["k"][0].as_py(), part["n"].to_pylist()))
    assert seen == [("a", [0, 1, 2]), ("b", [3]), ("c", [4, 5, 6, 7, 8]), ("d", [9, 10])]


@pytest.mark.parametrize("depth", [1_500])
def test_deep_groups_of_copies_are_cut_before_the_shuffle(spark, plan_of, depth):
    corpus = clustered(spark, 400, copies=300)
    groups, _ = approx.copies_of(corpus.select("id", corpus.embedding.alias("v")), [], depth)
    assert sorted(len(r.members) for r in groups.collect())[-1] == 300
    exact = approx.knn_graph(corpus, TABLE, depth)
    assert exact.count() == 400 * 399


def test_a_task_scores_few_pairs_at_a_time(monkeypatch):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((3_000, 64))
    sizes = []
    exact = refine.row_nearness
    monkeypatch.setattr(refine, "row_nearness", lambda m, a, b: sizes.append(a.size) or exact(m, a, b))
    batch = pa.RecordBatch.from_pydict({
        "node": np.repeat(np.arange(50), 60), "other": np.arange(3_000), "new": np.ones(3_000, bool),
        "v": pa.array(rows.tolist(), pa.list_(pa.float64())), "worst": pa.nulls(3_000, pa.float64()),
    })
    links = pa.Table.from_batches(refine._local_join(64, "COS", 59, refine._link_schema(T.LongType()))(iter([batch])))
    assert links.num_rows == 3_000 * 59 and sum(sizes) == 3_000 * 59 * 64 and max(sizes) <= 1_000_000
    src, dst = links["src"].to_numpy(), links["dst"].to_numpy()
    assert (links["near"].to_numpy() == exact("COS", rows[src], rows[dst])).all()
