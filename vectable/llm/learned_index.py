"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors is linked by its exact nearest neighbours, that graph is cut into parts of
equal size with few links across, and a small network learns from the sample which parts the neighbours of
a vector lie in. The network then puts every row of the table into its most probable part and sends a
query to several of them, where rows are compared exactly. How many parts a query visits follows from a
measurement: a few hundred rows are searched exactly, and the least number of parts that finds the wanted
share of their neighbours is taken.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vectable.functions.vectors import is_valid, to_matrix
from vectable.operators.search import nearest
from vectable.sources.tables import settle
from vectable.table import EUCLIDEAN

SAMPLE_ROWS = 16_384  # distinct vectors that are linked, cut and learned from; every row is indexed
PART_ROWS = 1_024  # rows in a part, about, while the sample allows it
LEAST_SAMPLED = 32  # sampled rows in a part: bounds the number of parts
LINKS = 10
MEASURED = 256  # rows searched exactly to choose the number of parts visited
RECALL = 0.95
HIDDEN = 128


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer from a vector to the probabilities of the parts."""

    centre: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1  # parts a query visits

    @property
    def parts(self) -> int:
        return len(self.b2)

    @property
    def network(self) -> tuple:
        """What ``most_probable`` needs, as plain data."""
        return self.centre, self.scale, self.w1, self.b1, self.w2, self.b2

    def ranked(self, rows: np.ndarray, n: int) -> np.ndarray:
        return most_probable(self.network, rows, n)


def most_probable(network: tuple, rows: np.ndarray, n: int) -> np.ndarray:
    """The n most probable parts of each row, best first, equal ones by number."""
    centre, scale, w1, b1, w2, b2 = network
    x = ((rows - centre) * scale).astype(np.float32)
    scores = np.maximum(x @ w1 + b1, 0) @ w2 + b2
    return np.argsort(-scores, axis=1, kind="stable")[:, :n].astype(np.int32)


def usable(rows: DataFrame, dims: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v of the rows that take part: with a key, and a vector of ``dims`` finite elements that are not all
    zero. Rows under one key count once, with the least of their vectors."""
    v = F.col(vector)
    some = F.coalesce((F.array_max(v) > 0) | (F.array_min(v) < 0), F.lit(False))
    kept = rows.select(F.col(key).alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & is_valid(F.col("v"), dims) & some)
    n, ids = kept.agg(F.count("id"), F.count_distinct("id")).first()
    return kept if n == ids else kept.groupBy("id").agg(F.min("v").alias("v"))


def fit_router(
    rows: DataFrame, dims: int, k: int = 10, *, sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS, recall: float = RECALL, seed: int = 7
) -> Router:
    """Learn the parts of ``rows`` (id, v as from ``usable``). At most ``sample_rows`` distinct vectors and the
    neighbours of ``MEASURED`` rows reach the driver, whatever the size of the table."""
    total = rows.count()
    parts = int(max(1, min(total // part_rows, sample_rows // LEAST_SAMPLED)))
    if parts == 1:
        return Router(np.zeros(dims), 1.0, np.zeros((dims, 1), np.float32), np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32))
    sample = _sample(rows, sample_rows, total, seed)
    positions, vectors = to_matrix(sample.column("v"), dims)
    links = _links(rows.sparkSession, vectors, LINKS)
    parts = max(1, min(parts, len(vectors) // LEAST_SAMPLED))
    cut = balanced_cut(links, parts, seed)
    router = _learn(vectors, links, cut, parts, seed)
    return _with_probes(router, rows, vectors, sample.column("id"), dims, k, recall, seed)


def _sample(rows: DataFrame, sample_rows: int, total: int, seed: int) -> pa.Table:
    """Distinct vectors picked by a hash of the vector, so that a vector carried by very many rows is one
    candidate like any other. Of more than ``sample_rows`` those with the least hash stay."""
    mark = F.xxhash64("v", F.lit(seed))
    share = min(1.0, 4.0 * sample_rows / max(1, total))
    some = rows.filter(mark < F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
    distinct = some.groupBy(mark.alias("mark")).agg(F.min_by("v", "id").alias("v"), F.min("id").alias("id"))
    return distinct.orderBy("mark").limit(sample_rows).select("id", "v").toArrow()


def _links(spark, vectors: np.ndarray, degree: int) -> np.ndarray:
    """Positions of the nearest others of every sampled vector, found on the cluster; -1 where there are fewer."""
    table = pa.table({"id": pa.array(np.arange(len(vectors))), "v": pa.array(list(vectors), pa.list_(pa.float64()))})
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame = spark.createDataFrame(table).repartition(width, "id")
    near = nearest(frame, frame.withColumnRenamed("id", "query_id"), EUCLIDEAN, degree + 1, dims=vectors.shape[1], trusted=True)
    found = near.filter("query_id <> id").select("query_id", "rank", "id").toArrow().sort_by([("query_id", "ascending"), ("rank", "ascending")])
    source, target = found.column("query_id").to_numpy(), found.column("id").to_numpy()
    links = np.full((len(vectors), degree), -1, np.int64)
    first = np.searchsorted(source, np.arange(len(vectors)))
    place = np.arange(len(source)) - first[source]
    links[source[place < degree], place[place < degree]] = target[place < degree]
    return links


def balanced_cut(links: np.ndarray, parts: int, seed: int = 7, rounds: int = 12, slack: float = 0.1) -> np.ndarray:
    """The part of every node: parts of about equal size (at most ``slack`` over the mean) with few links across.

    Parts grow side by side from seeds, the smallest one next, along the links. Then nodes move to
    the part with most of their neighbours while it has room and their own does not get too small.
    """
    n, rng = len(links), np.random.default_rng(seed)
    around: list[list[int]] = [[] for _ in range(n)]
    for a, row in enumerate(links.tolist()):
        for b in row:
            if b >= 0:
                around[a].append(b)
                around[b].append(a)
    most, least = int(np.ceil(n / parts * (1 + slack))), int(n / parts * (1 - slack))
    part, sizes = [-1] * n, [0] * parts
    order = rng.permutation(n).tolist()
    fronts = [deque([order[i]]) for i in range(parts)]
    free, at = iter(order), 0
    left = n
    while left:
        at = min(range(parts), key=sizes.__getitem__)
        node = -1
        while fronts[at]:
            got = fronts[at].popleft()
            if part[got] < 0:
                node = got
                break
        if node < 0:  # its surroundings are taken: go on from any free node
            node = next(x for x in free if part[x] < 0)
        part[node] = at
        sizes[at] += 1
        left -= 1
        fronts[at] += [x for x in around[node] if part[x] < 0]
    for _ in range(rounds):
        moved = 0
        for node in rng.permutation(n).tolist():
            own = part[node]
            if sizes[own] <= least:
                continue
            votes: dict[int, int] = {}
            for x in around[node]:
                votes[part[x]] = votes.get(part[x], 0) + 1
            best = max((p for p in votes if p == own or sizes[p] < most), key=lambda p: (votes[p], p == own, -p), default=own)
            if best != own and votes[best] > votes.get(own, 0):
                part[node] = best
                sizes[own] -= 1
                sizes[best] += 1
                moved += 1
        if moved * 1000 < n:
            break
    return np.asarray(part)


def _learn(vectors: np.ndarray, links: np.ndarray, cut: np.ndarray, parts: int, seed: int, epochs: int = 40, batch: int = 512) -> Router:
    """Fit the network to the shares of the parts among a vector's neighbours and itself (Adam, cross entropy)."""
    rng, n = np.random.default_rng(seed), len(vectors)
    wanted = np.zeros((n, parts), np.float32)
    wanted[np.arange(n), cut] = 1
    for column in range(links.shape[1]):
        have = np.flatnonzero(links[:, column] >= 0)
        wanted[have, cut[links[have, column]]] += 1
    wanted /= wanted.sum(axis=1, keepdims=True)
    centre = vectors.mean(axis=0)
    scale = 1.0 / max(float((vectors - centre).std()), 1e-30)
    x = ((vectors - centre) * scale).astype(np.float32)
    weights = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)).astype(np.float32), np.zeros(parts, np.float32),
    ]
    mean, spread, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rate = 3e-3 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(n)
        for start in range(0, n, batch):
            rows = order[start : start + batch]
            hidden = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            out = hidden @ weights[2] + weights[3]
            out -= out.max(axis=1, keepdims=True)
            p = np.exp(out)
            p /= p.sum(axis=1, keepdims=True)
            error = (p - wanted[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            step += 1
            for w, m, s, g in zip(weights, mean, spread, (x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Router(centre, scale, *weights)


def _with_probes(router: Router, rows: DataFrame, vectors: np.ndarray, ids: pa.Array, dims: int, k: int, recall: float, seed: int) -> Router:
    """The least number of parts that holds ``recall`` of the exact neighbours of some sampled rows."""
    picked = np.random.default_rng(seed).permutation(len(vectors))[:MEASURED]
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    asked = pa.table({"query_id": ids.take(pa.array(picked)), "v": pa.array(list(vectors[picked]), pa.list_(pa.float64()))})
    spark = rows.sparkSession
    near = nearest(rows, spark.createDataFrame(asked), EUCLIDEAN, k + 1, dims=dims, trusted=True).filter("query_id <> id")
    met = near.join(rows.select("id", F.col("v").alias("nv")), "id").select("query_id", "nv").toArrow()  # MEASURED * k rows
    _, found = to_matrix(met.column("nv"), dims)
    at = {key: i for i, key in enumerate(asked.column("query_id").to_pylist())}
    query = np.array([at[key] for key in met.column("query_id").to_pylist()], dtype=np.int64)
    order = router.ranked(vectors[picked], router.parts)
    place = np.empty_like(order)
    place[np.arange(len(order))[:, None], order] = np.arange(router.parts)
    needed = np.sort(place[query, router.ranked(found, 1)[:, 0]]) if len(found) else np.zeros(1, int)
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
    return Router(router.centre, router.scale, router.w1, router.b1, router.w2, router.b2, probes)


def _sent(df: DataFrame, router: Router):
    return df.sparkSession.sparkContext.broadcast(router.network)


def parts_of(v: Column, router: Router, n: int, sent) -> Column:
    """The n most probable parts of a vector column; the vectors are usable ones."""
    width = len(router.centre)

    @F.arrow_udf("array<int>")
    def routed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            _, rows = to_matrix(column, width)
            found = most_probable(sent.value, rows, n)
            ends = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32) if len(rows) else np.zeros(1, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return routed(v)


def build_index(rows: DataFrame, router: Router) -> DataFrame:
    """id, v, part for every row: an ordinary table, to be kept with ``save_snapshot(..., partition_by=["part"])``."""
    sent = _sent(rows, router)
    return rows.withColumn("part", F.element_at(parts_of(F.col("v"), router, 1, sent), 1))


def search_index(index: DataFrame, queries: DataFrame, router: Router, k: int = 10, probes: int | None = None) -> DataFrame:
    """query_id, rank, id, score: the k nearest rows of the parts each query visits, but those under its own id.

    ``queries``: query_id, v. score is the Euclidean distance in double; ties go to the smaller id. A query
    whose parts hold fewer rows has fewer hits. Queries that fit in memory go to every task and no row of
    the index is moved; more of them meet the parts in cells of bounded size (``search.nearest``).
    """
    sent = _sent(index, router)
    n = min(router.parts, probes or router.probes)
    asked = queries.withColumn("scope", parts_of(F.col("v"), router, n, sent))
    pool = index.select("id", "v", F.col("part").alias("scope"))
    near = nearest(pool, asked.select("query_id", "v", "scope"), EUCLIDEAN, k + 1, dims=len(router.centre))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "id"))
    others = near.filter("query_id <> id").withColumn("rank", order).filter(F.col("rank") <= k)
    return others.select("query_id", "rank", "id", (-F.col("near")).alias("score"))


def neighbours(rows: DataFrame, every: int = 100, k: int = 10, dims: int = 64, key: str = "vec_id", vector: str = "embedding", **fit) -> DataFrame:
    """query_id, rank, ``key``, score for every row whose key is divisible by ``every``, against all rows.

    Vectors that are NULL, zero, of another length than ``dims`` or hold a NULL or non-finite element, and rows
    without a key, take no part. Rows under one key count once (least vector). An empty table has no hits.
    """
    pool = settle(usable(rows, dims, key, vector))
    router = fit_router(pool, dims, k, **fit)
    index = settle(build_index(pool, router))
    queries = index.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "v")
    hits = search_index(index, queries, router, k)
    return hits.select(F.col("query_id").cast("bigint"), "rank", F.col("id").cast("bigint").alias(key), "score")
