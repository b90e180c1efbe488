"""The learned index: recall against brute force, exact distances, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import types as T

from vectable.llm import learned_index
from vectable.llm.learned_index import balanced_cut, build_index, fit_router, neighbours, search_index, usable

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("id", T.StringType()),
    T.StructField("v", T.IntegerType()), T.StructField("part", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("scope", T.LongType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1, "y", "z", 2) for i, v in rows], SCHEMA)


def nearest(ids, vectors, query, k=10):
    gap = np.sqrt(((vectors.astype(np.float64) - vectors[query].astype(np.float64)) ** 2).sum(1))
    gap[ids == ids[query]] = np.inf
    order = np.lexsort((ids, gap))[: min(k, len(ids) - 1)]
    return [(int(ids[i]), float(gap[i])) for i in order]


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16)) * 3
    vectors = (centres[rng.integers(0, 40, 6_000)] + rng.standard_normal((6_000, 16))).astype(np.float32)
    vectors[rng.permutation(6_000)[:2_000]] = vectors[0]  # a third are copies of one vector
    return np.arange(6_000), vectors


def test_recall_and_scores(spark, clustered):
    ids, vectors = clustered
    rows = frame(spark, zip(ids.tolist(), vectors.tolist()))
    hits = {}
    for r in neighbours(rows, every=50, dims=16, sample_rows=2_048, part_rows=200).collect():
        hits.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    found = total = 0
    for query in range(0, 6_000, 50):
        got = sorted(hits[query])
        assert [g[0] for g in got] == list(range(1, 11))
        assert all(s == np.sqrt(((vectors[i].astype(float) - vectors[query].astype(float)) ** 2).sum()) for _, i, s in got)
        want = nearest(ids, vectors, query)
        found += len({g[1] for g in got} & {w[0] for w in want})
        total += len(want)
    assert found >= 0.9 * total


def test_visits_few_parts_of_clustered_vectors_and_indexes_every_row(spark, clustered):
    ids, vectors = clustered
    rows = usable(frame(spark, zip(ids.tolist(), vectors.tolist())), 16)
    router = fit_router(rows, 16, sample_rows=2_048, part_rows=200)
    assert router.parts > 10 and router.probes <= router.parts // 2
    index = build_index(rows, router)
    assert index.count() == len(ids) and index.filter("part IS NULL OR part < 0").count() == 0


def test_all_parts_give_the_exact_result(spark, clustered):
    ids, vectors = clustered
    rows = usable(frame(spark, zip(ids.tolist(), vectors.tolist())), 16)
    router = fit_router(rows, 16, sample_rows=1_024, part_rows=500)
    index = build_index(rows, router)
    queries = index.filter("id % 1000 = 0").selectExpr("id AS query_id", "v")
    got = {}
    for r in search_index(index, queries, router, 10, probes=router.parts).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    for query, hits in got.items():
        assert [(i, s) for _, i, s in sorted(hits)] == nearest(ids, vectors, query)


def test_odd_vectors(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    rows = [
        (0, one), (0, one), (100, two), (100, [0.0, 2.0]), (1, one), (1, one), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]),
        (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (None, one), (200, [0.0, 0.0]), (300, None), (-100, one), (9, [-0.0, -1.0]),
    ]
    got = sorted(map(tuple, neighbours(frame(spark, rows), dims=2).collect()))
    left = {0: one, 100: two, 1: one, -100: one, 9: [0.0, -1.0]}
    want = []
    for query in (q for q in left if q % 100 == 0):
        others = sorted((float(np.sqrt(((np.array(left[query]) - np.array(v)) ** 2).sum())), i) for i, v in left.items() if i != query)
        want += [(query, rank, i, s) for rank, (s, i) in enumerate(others, 1)]
    assert got == sorted(want)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_find(spark, rows):
    assert neighbours(frame(spark, rows), dims=2).collect() == []


def test_cut_is_balanced_and_follows_the_links():
    rng = np.random.default_rng(0)
    group = np.repeat(np.arange(8), 100)
    links = np.array([[rng.choice(np.flatnonzero(group == g)) for _ in range(6)] for g in group])
    part = balanced_cut(links, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() <= 111 and sizes.min() >= 80
    across = np.mean(part[:, None] != part[links])
    assert across < 0.3  # at random it is 7 of 8
    lonely = balanced_cut(np.full((50, 3), -1), 5)
    assert np.bincount(lonely).tolist() == [10] * 5


def test_sample_counts_a_vector_once(spark, clustered):
    ids, vectors = clustered
    rows = usable(frame(spark, zip(ids.tolist(), vectors.tolist())), 16)
    sample = learned_index._sample(rows, 1_000, len(ids), 7)
    assert sample.num_rows == 1_000
    assert len({tuple(v) for v in sample.column("v").to_pylist()}) == 1_000
