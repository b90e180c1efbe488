"""The running top-k against a plain sort: few distinct vectors, so that copies and ties abound."""

import numpy as np
import pyarrow as pa
import pytest

from vectable.functions import running_topk
from vectable.functions.running_topk import HAMMING, RunningTopK, as_matrix
from vectable.functions.vectors import row_nearness


def nearness(metric, rows, query):
    if metric == HAMMING:
        return -np.bitwise_count(rows ^ query[None, :]).sum(axis=1).astype(np.float64)
    return row_nearness(metric, rows, np.broadcast_to(query, rows.shape))


@pytest.mark.parametrize("metric", ["COS", "L2", "IP", HAMMING])
@pytest.mark.parametrize("k", [1, 3, 40])
@pytest.mark.parametrize("words", [True, False], ids=["text ids", "number ids"])
def test_ties_and_copies(metric, k, words):
    rng = np.random.default_rng(k)
    rows = rng.integers(-1, 2, (600, 3)).astype(np.float64)
    rows[rng.random(600) < 0.4] = [1.0, 1.0, 0.0]  # the hot vector
    queries = np.vstack([rng.integers(-1, 2, (20, 3)).astype(np.float64), [[1.0, 1.0, 0.0], [0.0, 0.0, 0.0]]])
    if metric == HAMMING:
        rows, queries = (np.abs(x).astype(np.uint64) for x in (rows, queries))
    numbers = rng.permutation(600)
    ids = np.array([f"id{n}" for n in numbers]) if words else numbers
    best = RunningTopK(metric, queries, k)
    for start in range(0, 600, 75):
        best.offer(rows[start : start + 75], pa.array(ids[start : start + 75]))
    id_type = pa.string() if words else pa.int64()
    schema = pa.schema([("query_id", pa.int64()), ("id", id_type), ("near", pa.float64())])
    got = pa.Table.from_batches(best.result(pa.array(range(len(queries)), pa.int64()), schema), schema)
    for at, query in enumerate(queries):
        near = nearness(metric, rows, query)
        want = [ids[i] for i in sorted(range(600), key=lambda i: (-near[i], ids[i]))[:k]]
        mine = got.filter(pa.compute.equal(got["query_id"], at))
        assert mine["id"].to_pylist() == want


def test_floor_only_drops_what_cannot_win():
    rng = np.random.default_rng(1)
    rows, queries = rng.standard_normal((300, 5)), rng.standard_normal((4, 5))
    ids = pa.array(range(300), pa.int64())
    plain = RunningTopK("IP", queries, 6)
    plain.offer(rows, ids)
    floor = np.sort(queries @ rows[:50].T, axis=1)[:, -6]
    seeded = RunningTopK("IP", queries, 6, floor)
    seeded.offer(rows, ids)
    assert seeded.winner_ids().tolist() == plain.winner_ids().tolist()


def test_unusable_rows_are_left_out():
    column = pa.array([[1.0, 2.0], None, [1.0], [np.nan, 1.0], [1.0, None], [3.0, 4.0]], pa.list_(pa.float32()))
    for part, offset in ((column, 0), (column.slice(1), 1)):
        positions, matrix = as_matrix(part, "COS", 2)
        assert (positions + offset).tolist() == [0, 5][offset:] and matrix[-1].tolist() == [3.0, 4.0]
    words = pa.array([[1, -1], None, [5]], pa.list_(pa.int64()))
    positions, matrix = as_matrix(words, HAMMING, 2)
    assert positions.tolist() == [0] and matrix.tolist() == [[1, 2**64 - 1]]


@pytest.mark.parametrize("metric", ["IP", "L2"])
def test_one_very_long_row_does_not_make_all_pairs_be_scored_again(monkeypatch, metric):
    rng = np.random.default_rng(8)
    rows, queries = rng.standard_normal((4_000, 32)), rng.standard_normal((50, 32))
    scored = []
    exact = running_topk.row_nearness
    monkeypatch.setattr(running_topk, "row_nearness", lambda m, r, q: scored.append(len(r)) or exact(m, r, q))

    def run(stored):
        scored.clear()
        best = running_topk.RunningTopK(metric, queries, 5)
        for start in range(0, len(stored), 1_000):
            best.offer(stored[start : start + 1_000], pa.array(np.arange(start, start + 1_000)))
        return best.winner_ids().reshape(50, 5), sum(scored)

    _, plain = run(rows)
    rows[123] *= 1e8
    found, with_outlier = run(rows)
    near = rows @ queries.T if metric == "IP" else -((rows[:, None] - queries[None]) ** 2).sum(-1)
    assert (found == np.argsort(-near.T, axis=1, kind="stable")[:, :5]).all()
    assert with_outlier < 2 * plain


def test_pairs_are_scored_again_few_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    rows, queries = rng.standard_normal((300, 64)), rng.standard_normal((200, 64))
    sizes = []
    exact = running_topk.row_nearness
    monkeypatch.setattr(running_topk, "row_nearness", lambda m, r, q: sizes.append(r.size) or exact(m, r, q))
    best = running_topk.RunningTopK("L2", queries, 300)  # all pairs are kept
    best.offer(rows, pa.array(np.arange(300)))
    gaps = ((rows[None] - queries[:, None]) ** 2).sum(-1)
    assert (best.winner_ids().reshape(200, 300) == np.argsort(gaps, axis=1)).all()
    assert sum(sizes) == 300 * 200 * 64 and max(sizes) <= 1_000_000
