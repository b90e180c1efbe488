"""Recall at 10 of the cheaper searches on real vectors (floors are a little under measured values)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_search import found
from vectable.operators import approx, search
from vectable.table import VectorTable

TABLE = VectorTable(id="vec_id", dims=64)


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")


@pytest.fixture(scope="module")
def queries(vectors):
    return vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


@pytest.fixture(scope="module")
def exact(vectors, queries):
    return found(search.batch_topk(vectors, queries, TABLE, 10))


def recall(hits, exact):
    got = found(hits)
    return np.mean([len(set(got.get(q, [])) & set(ids)) / 10 for q, ids in exact.items()])


@pytest.fixture(scope="module")
def lists(vectors):
    centroids = approx.train_centroids(vectors, TABLE, 20)
    return approx.ivf_assign(vectors, centroids, TABLE), centroids


@pytest.mark.parametrize(("nprobes", "floor"), [(1, 0.25), (3, 0.44), (5, 0.57), (20, 1.0)])
def test_lists(lists, queries, exact, nprobes, floor):
    assert recall(approx.ivf_search(*lists[:1], queries, lists[1], TABLE, 10, nprobes), exact) >= floor


@pytest.mark.parametrize(("candidates", "floor"), [(10, 0.34), (40, 0.62), (80, 0.77), (200, 0.92)])
def test_candidates(spark, vectors, queries, exact, candidates, floor):
    planes = approx.random_planes(spark, 64)
    assert recall(approx.candidate_rerank(vectors, queries, planes, TABLE, 10, candidates), exact) >= floor
