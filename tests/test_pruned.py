"""Search and assignment by bounds equal the plain ones and do less."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tests.test_refine import clustered
from tests.test_search import QUERY, found, make
from vectable.operators import approx, search
from vectable.operators.pruned import (
    _hold_tree, batch_topk_pruned, best_possible, centroid_tree, ivf_assign_tree, list_bounds, nearest_in_tree, train_centroid_tree, tree_nearest, unit_rows,
)
from vectable.functions.vectors import row_nearness
from vectable.sources.tables import save_snapshot
from vectable.table import VectorTable


def asked(corpus, n):
    rows = corpus.orderBy("id").limit(n).collect()
    return corpus.sparkSession.createDataFrame([(i, r.embedding) for i, r in enumerate(rows)], QUERY)


@pytest.mark.parametrize("metric", ["COS", "L2", "IP"])
def test_bounded_search_is_exact_and_scores_less(spark, metric):
    corpus, table = clustered(spark, 3_000, copies=600), VectorTable(dims=16, metric=metric)
    corpus = corpus.unionByName(spark.createDataFrame([("zero", [0.0] * 16), ("bad", [1.0]), ("nan", [float("nan")] * 16), ("null", None)], corpus.schema))
    centroids = approx.train_centroids(corpus, table, 40)
    indexed = approx.ivf_assign(corpus, centroids, table)
    bounds = list_bounds(indexed, centroids, table)
    queries = asked(corpus.filter("id like 'r%'"), 50)
    want = found(search.batch_topk(indexed, queries, table, 6))
    got = batch_topk_pruned(indexed, queries, bounds, table, 6)
    assert found(got.hits) == want
    assert got.rows == 50 * 3_001 and got.scored < (0.5 if metric != "IP" else 0.9) * got.rows
    again = batch_topk_pruned(indexed, queries, bounds, table, 6, first_lists=3, growth=2)
    assert found(again.hits) == want
    unbounded = batch_topk_pruned(indexed, queries, bounds, table, 6, bound_bytes=1)
    assert found(unbounded.hits) == want and unbounded.scored == unbounded.rows


def test_random_vectors_few_rows_and_no_rows(spark):
    corpus, table = make(spark, 60), VectorTable(dims=8)
    centroids = approx.train_centroids(corpus, table, 5)
    indexed = approx.ivf_assign(corpus, centroids, table)
    bounds = list_bounds(indexed, centroids, table)
    queries = asked(make(spark, 20, seed=11, bad=False), 20)
    for k in (1, 4, 200):
        assert found(batch_topk_pruned(indexed, queries, bounds, table, k).hits) == found(search.batch_topk(indexed, queries, table, k))
    assert batch_topk_pruned(indexed, queries.limit(0), bounds, table, 3).hits.count() == 0
    none = indexed.limit(0)
    assert batch_topk_pruned(none, queries, list_bounds(none, centroids, table), table, 3).hits.count() == 0


def test_a_round_reads_only_the_lists_it_visits(spark, tmp_path, plan_of):
    corpus, table = clustered(spark, 2_000), VectorTable(dims=16)
    centroids = approx.train_centroids(corpus, table, 30)
    saved = save_snapshot(approx.ivf_assign(corpus, centroids, table), str(tmp_path / "lists"), partition_by=["list_id"])
    got = batch_topk_pruned(saved, asked(corpus, 1), list_bounds(saved, centroids, table), table, 3)
    assert found(got.hits) == found(search.batch_topk(saved, asked(corpus, 1), table, 3))
    assert got.scored < got.rows


@pytest.mark.parametrize("metric", ["COS", "L2", "IP"])
def test_no_member_beats_the_bound(metric):
    rng = np.random.default_rng(2)
    rows, members, centres = rng.standard_normal((40, 6)) * 3, rng.standard_normal((300, 6)), rng.standard_normal((5, 6))
    members[7], rows[3] = 0, 0
    own = unit_rows(members) if metric == "COS" else members
    centres = unit_rows(centres) if metric == "COS" else centres
    part = rng.integers(0, 5, 300)
    radius = np.array([np.sqrt(((own[part == j] - centres[j]) ** 2).sum(1)).max() for j in range(5)])
    bound = best_possible(metric, rows, centres, radius)
    for i, row in enumerate(rows):
        near = row_nearness(metric, members, np.broadcast_to(row, members.shape))
        assert all(near[m] <= bound[i, part[m]] for m in range(300))


@pytest.mark.parametrize("metric", ["COS", "L2", "IP"])
def test_assignment_down_the_tree_is_the_same(spark, metric):
    corpus, table = clustered(spark, 3_000), VectorTable(dims=16, metric=metric)
    corpus = corpus.unionByName(spark.createDataFrame([("zero", [0.0] * 16), ("bad", [1.0]), ("null", None)], corpus.schema))
    lists = corpus.filter("id LIKE 'r0%' AND id < 'r02000'").select((F.row_number().over(Window.orderBy("id")) - 1).alias("list_id"), F.col("embedding").cast("array<double>").alias("centroid"))
    want = {r.id: r.list_id for r in approx.ivf_assign(corpus, lists, table).collect()}
    tree = centroid_tree(lists, table)
    assert {r.id: r.list_id for r in ivf_assign_tree(corpus, tree, table).collect()} == want
    assert {r.id: r.list_id for r in ivf_assign_tree(corpus, tree, table, shared_bytes=1).collect()} == want


def test_four_thousand_lists(spark):
    corpus, table = clustered(spark, 9_000, clusters=300), VectorTable(dims=16)
    tree = train_centroid_tree(corpus, table, 4_000, sample_rows=8_000)
    assert tree.lists.count() == 4_000 and 50 <= tree.nodes.count() <= 64
    want = {r.id: r.list_id for r in approx.ivf_assign(corpus, tree.lists.select("list_id", "centroid"), table).collect()}
    assert {r.id: r.list_id for r in ivf_assign_tree(corpus, tree, table).collect()} == want
    probes = corpus.select("id", nearest_in_tree(F.col("embedding"), tree, "COS", 5).alias("lists")).collect()
    assert all(r.lists[0] == want[r.id] and len(set(r.lists)) == 5 for r in probes)


def test_the_tree_compares_less(spark):
    rng = np.random.default_rng(4)
    middles = rng.standard_normal((50, 16)) * 4
    leaves = np.repeat(middles, 40, axis=0) + rng.standard_normal((2_000, 16)) * 0.5
    rows = middles[rng.integers(0, 50, 500)] + rng.standard_normal((500, 16)) * 0.5
    table = VectorTable(dims=16, metric="L2")
    lists = spark.createDataFrame([(i, v) for i, v in enumerate(leaves.tolist())], "list_id int, centroid array<double>")
    tree = centroid_tree(lists, table, 50)
    held = _hold_tree(tree, 10**9)
    got, compared = tree_nearest((held.centres, held.radius, held.starts, held.ids, held.rows), "L2", rows, 3)
    gap = ((rows[:, None] - leaves[None]) ** 2).sum(-1)
    assert (got == np.argsort(gap, axis=1, kind="stable")[:, :3]).all()
    assert compared < 500 * 2_000 / 4


def test_training_on_few_rows(spark):
    corpus, table = make(spark, 12), VectorTable(dims=8)
    tree = train_centroid_tree(corpus, table, 5)
    assert 1 <= tree.lists.count() <= 5
    with pytest.raises(ValueError):
        train_centroid_tree(corpus.limit(0), table, 5)
    with pytest.raises(ValueError):
        train_centroid_tree(corpus, table, 0)
