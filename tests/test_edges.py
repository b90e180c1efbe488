"""Empty and one-row inputs through every search."""

import pytest

from vectable.operators import approx, ingest, search
from vectable.operators.mmr import mmr
from vectable.plans.retrieve import retrieve
from vectable.table import VectorTable

TABLE = VectorTable(dims=2)
SPACED = VectorTable(dims=2, namespace="namespace")


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame(
        [("a", "n", "text", [1.0, 0.0], (1,))], "id string, namespace string, text string, embedding array<float>, metadata struct<k int>"
    )


@pytest.fixture(scope="module")
def ask(spark):
    return spark.createDataFrame([(1, [1.0, 1.0], "n")], "query_id long, query_vector array<float>, namespace string")


@pytest.mark.parametrize("engine", ["shared", "grid"])
def test_empty_sides_with_a_namespace(one, ask, engine):
    assert search.batch_topk(one, ask.limit(0), SPACED, 2, engine=engine).count() == 0
    assert search.batch_topk(one.limit(0), ask, SPACED, 2, engine=engine).count() == 0
    assert search.batch_topk(one, ask, SPACED, 2, engine=engine).count() == 1
    other = ask.selectExpr("query_id", "query_vector", "'elsewhere' AS namespace")
    assert search.batch_topk(one, other, SPACED, 2, engine=engine).count() == 0


def test_empty_sides_of_the_rest(spark, one, ask):
    plain = ask.drop("namespace")
    for corpus, queries in ((one.limit(0), plain), (one, plain.limit(0))):
        assert mmr(corpus, queries, TABLE).count() == 0
        assert retrieve(corpus, queries, TABLE, search_type="mmr").count() == 0
        assert approx.candidate_rerank(corpus, queries, approx.random_planes(spark, 2), TABLE).count() == 0
        assert retrieve(corpus, queries, TABLE, gather=True).count() == 0
    assert search.topk(one.limit(0), [1.0, 0.0], TABLE).count() == 0
    with pytest.raises(ValueError):
        approx.ivf_assign(one, one.limit(0).selectExpr("0 AS list_id", "embedding AS centroid"), TABLE)


def test_graphs_of_none_and_one(one):
    assert approx.knn_graph(one.limit(0), TABLE, 3).count() == 0
    assert approx.knn_graph(one, TABLE, 3).count() == 0
    assert approx.knn_graph(one, TABLE, 3, within="namespace", engine="grid").count() == 0


def test_whole_numbers_as_ids(spark, ask):
    corpus = spark.createDataFrame([(10, [1.0, 0.0]), (9, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<float>")
    for engine in ("shared", "grid"):
        hits = search.batch_topk(corpus, ask.drop("namespace"), TABLE, 3, engine=engine).orderBy("rank").collect()
        assert [r.id for r in hits] == [2, 9, 10]  # equal scores, by number
    assert {(r.src, r.dst) for r in approx.knn_graph(corpus, TABLE, 1).collect()} == {(9, 10), (10, 9), (2, 9)}


def test_empty_batches(one):
    none = one.limit(0)
    for put in (ingest.upsert_replace, ingest.upsert_merge, ingest.upsert_embeddings):
        for limit in (0, 100):
            assert put(one, none, TABLE, max_broadcast=limit).count() == 1
            assert put(none, one, TABLE, max_broadcast=limit).count() == 1
