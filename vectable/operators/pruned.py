"""Exact search and exact assignment that skip what a bound rules out.

Rows in lists (``ivf_assign``), or lists under nodes, have a centre and a radius: by the triangle inequality no row of
a list is nearer to a query than the query's distance to the centre, less the radius. Lists whose bound is
worse than the k-th best found so far need not be read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vectable.functions.running_topk import RunningTopK
from vectable.functions.vectors import is_valid, normalised, row_norms, to_matrix
from vectable.operators.approx import kmeans, rows_as_table
from vectable.operators.search import HELD_BYTES, as_hits, batch_topk, nearest
from vectable.sources.tables import drop_settled, settle
from vectable.table import COSINE, INNER_PRODUCT, VectorTable, check_metric, check_range, path_col


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norms = row_norms(rows)
    return np.divide(rows, norms[:, None], out=np.zeros_like(rows), where=norms[:, None] > 0)


def best_possible(metric: str, rows: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """At most how near (cosine, dot product, minus the distance) a row can be to a member of each ball, rows x balls.

    For the cosine both sides are unit vectors and a chord c stands for the cosine 1 - c^2 / 2; a zero vector, which
    has cosine 0, is never ruled out by it, since 1 - 1/2 is more. Widened by more than the rounding of the sums.
    """
    if metric == COSINE:
        rows = unit_rows(rows)
    squares = (rows**2).sum(1)[:, None] + (centres**2).sum(1)[None, :]
    slack = 1e-9 * (1 + squares + radius[None, :] ** 2)
    if metric == INNER_PRODUCT:
        return rows @ centres.T + row_norms(rows)[:, None] * radius[None, :] + slack
    gap = np.sqrt(np.maximum(0, squares - 2 * (rows @ centres.T) - slack))
    least = np.maximum(0, gap - radius[None, :])
    return 1 - least**2 / 2 + slack if metric == COSINE else -least + np.sqrt(slack) * 1e-3


# ---- search -----------------------------------------------------------------------------------------


class Pruned(NamedTuple):
    hits: DataFrame
    scored: int  # rows scored, over all queries
    rows: int  # what scoring every row for every query would be


def list_bounds(indexed: DataFrame, centroids: DataFrame, table: VectorTable, *, metric: str | None = None, vector_col: str | None = None) -> DataFrame:
    """list_id, centre, radius, rows: a ball around every list's rows. One pass over the table, one row per task and
    list is sent. For the cosine the balls are those of the unit vectors."""
    metric = check_metric(metric or table.metric)
    path = path_col(table.vector_path(indexed, vector_col))
    held = _centres(centroids, metric)
    if held is None:
        raise ValueError("the centres do not fit in memory; search the lists without bounds")
    ids, centres = held
    sent = indexed.sparkSession.sparkContext.broadcast((ids, centres))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, middles = sent.value
        radius, rows = np.zeros(len(names)), np.zeros(len(names), np.int64)
        for batch in batches:
            positions, found = to_matrix(batch.column(1), middles.shape[1])
            found = unit_rows(found) if metric == COSINE else found
            listed = batch.column(0).to_numpy(zero_copy_only=False)[positions]
            at = np.searchsorted(names, listed)
            known = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == listed)
            if not known.all():
                raise ValueError("a list has no centre")
            np.maximum.at(radius, at, row_norms(found - middles[at]))
            np.add.at(rows, at, 1)
        some = np.flatnonzero(rows)
        yield pa.record_batch({"list_id": pa.array(names[some].astype(np.int32)), "radius": radius[some], "rows": rows[some]})

    placed = indexed.filter(is_valid(path, table.dims) & F.col("list_id").isNotNull()).select(F.col("list_id").cast("int"), path.alias("v"))
    parts = placed.mapInArrow(measure, "list_id int, radius double, rows bigint")
    widest = parts.groupBy("list_id").agg((F.max("radius") * (1 + 1e-9)).alias("radius"), F.sum("rows").alias("rows"))
    middle = normalised(F.col("centroid")) if metric == COSINE else F.col("centroid").cast("array<double>")
    centre = centroids.select(F.col("list_id").cast("int").alias("list_id"), middle.alias("centre"))
    return widest.join(centre, "list_id").select("list_id", "centre", "radius", "rows")


def _centres(centroids: DataFrame, metric: str, limit: int = HELD_BYTES) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted list ids and centres; None beyond the limit."""
    facts = centroids.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("width")).first()
    if not facts["n"] or facts["n"] * facts["width"] * 8 > limit:
        return None
    held = centroids.select(F.col("list_id").cast("int").alias("list_id"), "centroid").orderBy("list_id").toArrow()
    _, rows = to_matrix(held.column("centroid"), facts["width"])
    return held.column("list_id").to_numpy(), unit_rows(rows) if metric == COSINE else rows


def batch_topk_pruned(
    indexed: DataFrame,
    queries: DataFrame,
    bounds: DataFrame,
    table: VectorTable,
    k: int = 4,
    *,
    metric: str | None = None,
    vector_col: str | None = None,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    first_lists: int = 1,
    growth: int = 4,
    bound_bytes: int = HELD_BYTES,
    **search: Any,
) -> Pruned:
    """``batch_topk`` over a table with ``list_id``, reading for each query only the lists that can hold one of its hits.

    A query visits the lists in the order of their bounds: ``first_lists``, then ``growth`` times as many, and so on, as
    long as the bound of the next list is not worse than its k-th best score. ``bounds`` is what ``list_bounds`` gives for the
    same rows and metric. On a table partitioned by ``list_id`` a round reads the lists it visits only.
    """
    check_range("k", k, 1)
    check_range("first_lists", first_lists, 1)
    check_range("growth", growth, 2)
    metric = check_metric(metric or table.metric)
    table.check(indexed, need=["id"])
    facts = bounds.agg(F.count("*").alias("n"), F.max(F.size("centre")).alias("width"), F.sum("rows").alias("rows")).first()
    asked = settle(queries.select(path_col(query_id).alias("query_id"), path_col(query_vector).alias("v")))
    total = asked.count() * (facts["rows"] or 0)
    if not facts["n"] or facts["n"] * facts["width"] * 8 > bound_bytes:  # bounds too many to hold: every row is scored
        named = asked.withColumnRenamed("v", "query_vector")
        return Pruned(batch_topk(indexed, named, table, k, metric=metric, vector_col=vector_col, **search), total, total)
    held = bounds.select("list_id", "centre", "radius", "rows").orderBy("list_id").toArrow()
    _, centres = to_matrix(held.column("centre"), facts["width"])
    balls = (held.column("list_id").to_numpy().astype(np.int32), centres, held.column("radius").to_numpy(), held.column("rows").to_numpy())
    sent = indexed.sparkSession.sparkContext.broadcast(balls)
    path = path_col(table.vector_path(indexed, vector_col))
    pool = indexed.select(table.row_key().alias("id"), path.alias("v"), F.col("list_id").cast("int").alias("scope"))

    open_ = asked.select("query_id", "v", F.lit(None).cast("double").alias("edge"))
    found, scored, seen, take = None, 0, 0, first_lists
    while True:
        visit = settle(open_.withColumn("plan", _visits(F.col("v"), F.col("edge"), sent, metric, seen, take)).select("query_id", "v", "plan.scope", "plan.rows", "plan.more"))
        going = visit.filter(F.size("scope") > 0)
        scored += going.agg(F.sum("rows")).first()[0] or 0
        near = nearest(pool, going.select("query_id", "v", "scope"), metric, k, dims=table.dims, trusted=seen > 0, **search).select("query_id", "id", "near")
        if found is not None:
            near = near.unionByName(found)
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "id"))
        kept = settle(near.withColumn("rank", place).filter(F.col("rank") <= k))
        found = kept.select("query_id", "id", "near")
        edge = kept.filter(F.col("rank") == k).select("query_id", F.col("near").alias("edge"))
        seen, take = seen + take, take * growth
        open_ = visit.filter("more").select("query_id", "v").join(edge, "query_id", "left").select("query_id", "v", "edge")
        if seen >= facts["n"] or not open_.head(1):
            break
    drop_settled(visit)
    return Pruned(table.split_key(as_hits(kept, metric), "id", indexed), int(scored), int(total))


def _visits(v: Column, edge: Column, sent, metric: str, seen: int, take: int) -> Column:
    """scope: the next ``take`` lists of a query after the ``seen`` best whose bound reaches ``edge``; rows: how many rows those
    hold; more: whether there are lists left."""

    @F.arrow_udf("struct<scope:array<int>,rows:bigint,more:boolean>")
    def planned(column: pa.Array, edges: pa.Array) -> pa.Array:
        names, centres, radius, sizes = sent.value
        positions, rows = to_matrix(column, centres.shape[1])
        if len(positions) != len(column):
            raise ValueError(f"every query needs {centres.shape[1]} finite vector elements")
        low = edges.fill_null(-np.inf).to_numpy(zero_copy_only=False)
        scopes, counts, more = [], [], []
        step = max(1, 4_000_000 // len(names))
        for start in range(0, len(rows), step):
            top = best_possible(metric, rows[start : start + step], centres, radius)
            for bound, floor in zip(top, low[start : start + step]):
                able = np.lexsort((names, -bound))
                able = able[: np.searchsorted(-bound[able], -floor, side="right")]
                now = able[seen : seen + take]
                scopes.append(names[now])
                counts.append(int(sizes[now].sum()))
                more.append(len(able) > seen + take)
        return pa.StructArray.from_arrays(
            [pa.array(scopes, pa.list_(pa.int32())), pa.array(counts, pa.int64()), pa.array(more, pa.bool_())], ["scope", "rows", "more"]
        )

    return planned.asNondeterministic()(v, edge)


# ---- a tree of centroids ------------------------------------------------------------------------------


@dataclass(frozen=True)
class CentroidTree:
    """``nodes``: node_id, centre, radius; ``lists``: list_id, node_id, centroid. Two tables, in any store."""

    nodes: DataFrame
    lists: DataFrame


def centroid_tree(centroids: DataFrame, table: VectorTable, branches: int | None = None, *, metric: str | None = None, seed: int = 42) -> CentroidTree:
    """Group given centroids (list_id, centroid) under nodes, by default about as many as a node then has lists."""
    metric = check_metric(metric or table.metric)
    held = _centres(centroids, "", HELD_BYTES)
    if held is None:
        raise ValueError("no centroids, or too many to hold")
    ids, rows = held
    compared = unit_rows(rows) if metric == COSINE else rows
    branches = check_range("branches", branches or max(1, int(round(len(ids) ** 0.5))), 1)
    centres = kmeans(compared, min(branches, len(ids)), seed=seed)
    return _as_tree(centroids.sparkSession, ids, rows, compared, centres)


def _as_tree(spark, ids: np.ndarray, rows: np.ndarray, compared: np.ndarray, centres: np.ndarray) -> CentroidTree:
    gap = (centres**2).sum(1)[None, :] - 2 * (compared @ centres.T)
    node = gap.argmin(1).astype(np.int32)
    radius = np.zeros(len(centres))
    np.maximum.at(radius, node, row_norms(compared - centres[node]))
    nodes = rows_as_table(spark, {"node_id": np.arange(len(centres), dtype=np.int32), "centre": centres, "radius": radius * (1 + 1e-9)})
    lists = rows_as_table(spark, {"list_id": ids.astype(np.int32), "node_id": node, "centroid": rows})
    return CentroidTree(nodes, lists)


def train_centroid_tree(
    corpus: DataFrame, table: VectorTable, num_lists: int, branches: int | None = None, *, sample_rows: int = 200_000, max_iter: int = 15, seed: int = 42
) -> CentroidTree:
    """Two levels of k-means on at most ``sample_rows`` rows, picked by a hash of their key.

    The first level is trained on the driver's sample, the second inside each node, one task per node, with lists in proportion
    to the node's rows. Costs rows x (branches + lists per node) per iteration instead of rows x lists.
    """
    check_range("num_lists", num_lists, 1)
    branches = check_range("branches", branches or max(1, int(round(num_lists**0.5))), 1, num_lists)
    path = path_col(table.vector_path(corpus))
    rows = corpus.filter(is_valid(path, table.dims)).select(F.xxhash64(F.lit(seed), table.row_key()).alias("mark"), path.alias("v"))
    total = rows.count()
    share = min(1.0, 1.2 * sample_rows / max(1, total))
    some = rows if share >= 1 else rows.filter(F.col("mark") < F.lit(int(-(2**63) + share * (2**64 - 1))))
    sample = settle(some.orderBy("mark").limit(sample_rows).select("v"))
    width = sample.select(F.size("v")).head(1)
    if not width:
        raise ValueError("no usable vectors to train on")
    held = sample.toArrow()
    _, found = to_matrix(held.column("v"), width[0][0])
    found = unit_rows(found) if table.metric == COSINE else found
    centres = kmeans(found, min(branches, len(found)), max_iter, seed)
    node = ((centres**2).sum(1)[None, :] - 2 * (found @ centres.T)).argmin(1)
    sizes = np.bincount(node, minlength=len(centres))
    wanted = np.maximum(1, np.floor(sizes / len(found) * num_lists)).astype(int)
    wanted = np.minimum(wanted, np.maximum(1, sizes))
    for at in np.argsort(-(sizes / np.maximum(1, wanted)), kind="stable")[: max(0, num_lists - wanted.sum())]:
        wanted[at] += 1
    spark = corpus.sparkSession
    parts = rows_as_table(spark, {"node": node.astype(np.int32), "n": wanted[node].astype(np.int32), "v": found}).repartition(len(centres), "node")
    width, kind = found.shape[1], "node int, centroid array<double>"

    def split(members: pa.Table) -> pa.Table:
        _, own = to_matrix(members.column("v"), width)
        middles = kmeans(own, min(members.column("n")[0].as_py(), len(own)), max_iter, seed)
        return pa.table({"node": pa.array([members.column("node")[0].as_py()] * len(middles), pa.int32()), "centroid": pa.array(list(middles), pa.list_(pa.float64()))})

    leaves = parts.groupBy("node").applyInArrow(split, kind).orderBy("node", "centroid").toArrow()
    _, leaf = to_matrix(leaves.column("centroid"), width)
    return _as_tree(spark, np.arange(len(leaf), dtype=np.int32), leaf, leaf, centres)


@dataclass(frozen=True)
class _HeldTree:
    centres: np.ndarray
    radius: np.ndarray
    starts: np.ndarray  # of each node's lists
    ids: np.ndarray
    rows: np.ndarray


def _hold_tree(tree: CentroidTree, limit: int) -> _HeldTree | None:
    facts = tree.lists.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("width")).first()
    if not facts["n"]:
        raise ValueError("no rows in the centroid table")
    if facts["n"] * facts["width"] * 8 > limit:
        return None
    nodes = tree.nodes.orderBy("node_id").toArrow()
    lists = tree.lists.select("node_id", F.col("list_id").cast("int").alias("list_id"), "centroid").orderBy("node_id", "list_id").toArrow()
    _, centres = to_matrix(nodes.column("centre"), facts["width"])
    _, rows = to_matrix(lists.column("centroid"), facts["width"])
    starts = np.searchsorted(lists.column("node_id").to_numpy(), np.r_[nodes.column("node_id").to_numpy(), np.iinfo(np.int32).max])
    return _HeldTree(centres, nodes.column("radius").to_numpy(), starts, lists.column("list_id").to_numpy(), rows)


def tree_nearest(held: tuple, metric: str, rows: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """Ids of the n nearest lists of each row, rows x n, and how many centroids were compared."""
    centres, radius, starts, ids, leaves = held
    best = RunningTopK(metric, rows, n)
    bound = best_possible(metric, rows, centres, radius)
    compared = len(rows) * len(centres)
    order = np.argsort(-bound, axis=1, kind="stable")
    sizes = np.diff(starts)
    reach = np.cumsum(sizes[order], axis=1)
    lead = np.minimum((reach < n).sum(axis=1) + 1, len(centres))  # the nodes that hold the first n lists
    early = np.zeros(bound.shape, dtype=bool)
    early[np.arange(len(rows))[:, None], order] = np.arange(len(centres))[None, :] < lead[:, None]
    names = pa.array(ids)
    for late in (False, True):
        edge = best.edge.copy()
        for node in range(len(centres)):
            low, high = starts[node], starts[node + 1]
            which = np.flatnonzero(early[:, node] if not late else ~early[:, node] & (bound[:, node] >= edge))
            if len(which) and high > low:
                best.offer(leaves[low:high], names.slice(low, high - low), which)
                compared += len(which) * int(high - low)
        best._merge()
    return best.winner_ids().reshape(len(rows), n).astype(np.int32), compared


def nearest_in_tree(v: Column, tree: CentroidTree, metric: str, n: int, *, shared_bytes: int = HELD_BYTES) -> Column | None:
    """Ids of the n nearest lists for each vector, nearest first, ties to the smaller id; NULL for an unusable vector. None
    where the tree is too large to hold."""
    held = _hold_tree(tree, shared_bytes)
    if held is None:
        return None
    sent = tree.lists.sparkSession.sparkContext.broadcast((held.centres, held.radius, held.starts, held.ids, held.rows))
    n = min(n, len(held.ids))

    @F.arrow_udf("array<int>")
    def found(column: pa.Array) -> pa.Array:
        plain = sent.value
        positions, rows = to_matrix(column, plain[0].shape[1])
        out = np.zeros((len(column), n), dtype=np.int32)
        if len(rows):
            out[positions] = tree_nearest(plain, metric, rows, n)[0]
        usable = np.zeros(len(column), dtype=bool)
        usable[positions] = True
        ends = pa.array(np.arange(0, (len(column) + 1) * n, n, dtype=np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()), mask=pa.array(~usable))

    return found(v)


def ivf_assign_tree(corpus: DataFrame, tree: CentroidTree, table: VectorTable, *, vector_col: str | None = None, shared_bytes: int = HELD_BYTES) -> DataFrame:
    """``ivf_assign`` down the tree: a row is compared with the lists of its nearest node, and with those of another node only if
    one of them may be nearer. The same ``list_id``. A tree too large to hold is compared list by list (``ivf_assign``)."""
    from vectable.operators.approx import ivf_assign

    path = path_col(table.vector_path(corpus, vector_col))
    lists = nearest_in_tree(path, tree, table.metric, 1, shared_bytes=shared_bytes)
    if lists is None:
        return ivf_assign(corpus, tree.lists.select("list_id", "centroid"), table, vector_col=vector_col, shared_bytes=shared_bytes)
    return corpus.withColumn("list_id", F.element_at(lists, 1))
