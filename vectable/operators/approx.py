"""Cheaper search with a recall knob, as tables and Spark jobs.

* Inverted lists: every row gets the list of its nearest centroid; a query scans only the lists
  nearest to it.
* Candidate lists: rows are first compared by a sketch of sign bits (32 bytes for 256 planes), and
  only the best candidates are scored exactly.
* k-NN graph: the nearest rows of every row, as edges.

Probing all lists, or as many candidates as rows, gives the exact result.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vectable.functions.predicates import Filter, where
from vectable.functions.running_topk import HAMMING, RunningTopK
from vectable.functions.vectors import is_valid, normalised, row_nearness, to_matrix
from vectable.operators.search import HELD_BYTES, as_hits, batch_topk, nearest
from vectable.sources.tables import BROADCAST_ROWS, fits_broadcast, settle
from vectable.table import COSINE, VectorTable, check_metric, check_range, path_col

# The index kinds, the default of each tuning number and its allowed range.
IVF, HNSW, DISKANN = "vector-ivf", "vector-hnsw", "vector-diskann"
_TUNING: dict[str, dict[str, tuple[int, int, int | None]]] = {
    IVF: {"num_lists": (1, 1, None), "nprobes": (1, 1, None)},
    HNSW: {"m": (16, 2, 100), "ef_construction": (64, 4, 1000), "ef_search": (40, 1, None)},
    DISKANN: {"max_degree": (32, 20, 2048), "l_build": (50, 10, 500), "l_search": (40, 10, 1000)},
}


@dataclass(frozen=True)
class Tuning:
    """Checked tuning numbers of one index kind, read by what they mean here."""

    kind: str
    values: dict[str, int]

    @classmethod
    def of(cls, kind: str, **given: int) -> Tuning:
        if kind not in _TUNING:
            raise ValueError(f"kind must be one of {', '.join(_TUNING)}, got {kind!r}")
        known = _TUNING[kind]
        unknown = sorted(set(given) - set(known))
        if unknown:
            raise ValueError(f"{kind} has no option {', '.join(unknown)}")
        values = {
            name: check_range(name, given.get(name, default), low, high)
            for name, (default, low, high) in known.items()
        }
        if kind == HNSW and values["ef_construction"] < 2 * values["m"]:
            raise ValueError("with m links per row, a build needs ef_construction of 2 * m or more")
        return cls(kind, values)

    @property
    def degree(self) -> int:
        """Edges per row in the graph."""
        return self.values["m" if self.kind == HNSW else "max_degree"]

    @property
    def build_candidates(self) -> int:
        return self.values["ef_construction" if self.kind == HNSW else "l_build"]

    @property
    def search_candidates(self) -> int:
        return self.values["ef_search" if self.kind == HNSW else "l_search"]


# ---- inverted lists -------------------------------------------------------------------------------


def train_centroids(
    corpus: DataFrame,
    table: VectorTable,
    num_lists: int = 1,
    *,
    sample_fraction: float = 1.0,
    max_iter: int = 20,
    seed: int = 42,
) -> DataFrame:
    """``list_id, centroid`` by k-means (on unit vectors for the cosine metric).

    Centroids only steer the search, so a sample is enough to train them on a large corpus; every
    row is assigned all the same. Take num_lists in proportion to the corpus, so that lists keep
    their size as it grows.
    """
    check_range("num_lists", num_lists, 1)
    v = path_col(table.vector_path(corpus))
    rows = corpus.filter(is_valid(v, table.dims))
    if sample_fraction < 1.0:
        rows = rows.sample(sample_fraction, seed=seed)
    unit = normalised(v) if table.metric == COSINE else v.cast("array<double>")
    features = rows.select(array_to_vector(unit).alias("features"))
    spark = corpus.sparkSession
    if num_lists == 1:
        mean = features.select(vector_to_array(Summarizer.mean(F.col("features"))).alias("centroid"))
        return mean.select(F.lit(0).alias("list_id"), "centroid")
    model = KMeans(k=num_lists, maxIter=max_iter, seed=seed).fit(features)
    centres = np.array(model.clusterCenters())
    return rows_as_table(spark, {"list_id": np.arange(len(centres), dtype=np.int32), "centroid": centres})


def rows_as_table(spark: SparkSession, columns: dict[str, np.ndarray]) -> DataFrame:
    """A table of numbers and, for matrices, vectors, handed over as Arrow buffers."""

    def column(values: np.ndarray) -> pa.Array:
        if values.ndim == 1:
            return pa.array(values)
        ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32) if len(values) else np.zeros(1, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values, dtype=np.float64).ravel()))

    return spark.createDataFrame(pa.table({name: column(values) for name, values in columns.items()}))


def kmeans(rows: np.ndarray, k: int, max_iter: int = 15, seed: int = 42) -> np.ndarray:
    """k centres of a bounded set of rows: distinct rows to start from, then rounds of means; a centre that lost
    its rows keeps its place. Fewer where there are fewer distinct rows."""
    distinct = np.unique(rows, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]].astype(np.float64)
    before = None
    for _ in range(max_iter):
        nearest_one = np.empty(len(rows), np.int64)
        step = max(1, 8_000_000 // len(centres))
        for start in range(0, len(rows), step):
            nearest_one[start : start + step] = ((centres**2).sum(1)[None, :] - 2 * (rows[start : start + step] @ centres.T)).argmin(1)
        if before is not None and (before == nearest_one).all():
            break
        before = nearest_one
        order = np.argsort(nearest_one, kind="stable")
        some, first = np.unique(nearest_one[order], return_index=True)
        sums = np.add.reduceat(rows[order], first, axis=0)
        centres[some] = sums / np.diff(np.r_[first, len(rows)])[:, None]
    return centres


@dataclass(frozen=True)
class _Held:
    ids: pa.Array
    rows: np.ndarray


def _hold(vectors: DataFrame, key: str, value: str, limit: int = HELD_BYTES) -> _Held | None:
    """A small table of vectors in memory, in key order; None when it is over the limit."""
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(value)).alias("width")).first()
    if not facts["n"]:
        raise ValueError(f"no rows in the {value} table")
    if facts["n"] * facts["width"] * 8 > limit:
        return None
    held = vectors.select(F.col(key).cast("int").alias(key), value).orderBy(key).toArrow()
    positions, rows = to_matrix(held.column(value), facts["width"])
    if len(positions) != facts["n"]:
        raise ValueError(f"{value} rows must be finite vectors of one length")
    return _Held(held.column(key).combine_chunks(), rows)


def _nearest_ids(v: Column, held: _Held, metric: str, n: int) -> Column:
    """Ids of the n nearest held vectors for each vector of a column, nearest first; NULL for an
    unusable vector."""
    sent = SparkSession.active().sparkContext.broadcast((held.ids, held.rows))  # plain data only
    n = min(n, len(held.rows))

    @F.arrow_udf("array<int>")
    def lists(column: pa.Array) -> pa.Array:
        ids, centres = sent.value
        positions, rows = to_matrix(column, centres.shape[1])
        best = RunningTopK(metric, rows, n)
        best.offer(centres, ids)
        found = np.zeros((len(column), n), dtype=np.int32)
        found[positions] = best.winner_ids().reshape(len(rows), n)
        usable = np.zeros(len(column), dtype=bool)
        usable[positions] = True
        offsets = pa.array(np.arange(0, (len(column) + 1) * n, n, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()), mask=pa.array(~usable))

    return lists(v)


def ivf_assign(
    corpus: DataFrame,
    centroids: DataFrame,
    table: VectorTable,
    *,
    vector_col: str | None = None,
    shared_bytes: int = HELD_BYTES,
) -> DataFrame:
    """The corpus with ``list_id``, its nearest centroid (ties to the smaller list; NULL for an unusable
    vector). Save it with ``save_snapshot(..., partition_by=["list_id"])``.

    Centroids that fit are handed to every task and no row is moved; more of them are compared in a
    grid of cells.
    """
    path = table.vector_path(corpus, vector_col)
    held = _hold(centroids, "list_id", "centroid", shared_bytes)
    if held is not None:
        return corpus.withColumn("list_id", F.element_at(_nearest_ids(path_col(path), held, table.metric, 1), 1))
    usable = corpus.filter(is_valid(path_col(path), table.dims))
    found = nearest(
        centroids.select(F.col("list_id").cast("int").alias("id"), F.col("centroid").alias("v")),
        usable.select(table.row_key().alias("query_id"), path_col(path).alias("v")),
        table.metric, 1, dims=table.dims, engine="grid", trusted=True,
    )
    assigned = found.select(F.col("query_id").alias("__key"), F.col("id").alias("list_id"))
    return corpus.join(assigned, table.row_key() == F.col("__key"), "left").drop("__key")


def ivf_search(
    indexed: DataFrame,
    queries: DataFrame,
    centroids: DataFrame,
    table: VectorTable,
    k: int = 4,
    nprobes: int = 1,
    *,
    condition: Filter = None,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    shared_centroid_bytes: int = HELD_BYTES,
    **search: Any,
) -> DataFrame:
    """Top-k among the rows of the ``nprobes`` lists nearest to each query.

    On a table partitioned by ``list_id`` only the probed partitions are read.
    """
    check_range("nprobes", nprobes, 1)
    held = _hold(centroids, "list_id", "centroid", shared_centroid_bytes)
    asked = queries.select(path_col(query_id).alias("query_id"), path_col(query_vector).alias("query_vector"))
    if held is not None:
        asked = asked.withColumn("lists", _nearest_ids(F.col("query_vector"), held, table.metric, nprobes))
    else:  # too many centroids to hold: rank them in a grid of cells
        probed = nearest(
            centroids.select(F.col("list_id").cast("int").alias("id"), F.col("centroid").alias("v")),
            asked.select("query_id", F.col("query_vector").alias("v")), table.metric, nprobes, engine="grid",
        )
        asked = asked.join(probed.groupBy("query_id").agg(F.collect_list("id").alias("lists")), "query_id")
    return batch_topk(indexed, asked, table, k, condition=condition, scope=("list_id", "lists"), **search)


# ---- candidate lists ------------------------------------------------------------------------------


def random_planes(spark: SparkSession, dims: int, count: int = 256, seed: int = 7) -> DataFrame:
    """``plane_id, plane``: directions whose signs make a sketch. The same seed gives the same table."""
    check_range("dims", dims, 1)
    check_range("count", count, 1)
    values = np.random.default_rng(seed).standard_normal((count, dims))
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(values)], "plane_id int, plane array<double>")


def add_sketch(df: DataFrame, planes: DataFrame, vector: str = "embedding", name: str = "sketch") -> DataFrame:
    """Pack the signs of a vector against the planes into ``array<bigint>``; NULL for an unusable
    vector. Worth saving beside the corpus: the first stage then reads 8 bytes per 64 planes."""
    held = _hold(planes, "plane_id", "plane")
    if held is None:
        raise ValueError("too many planes to hold in memory")
    sent = df.sparkSession.sparkContext.broadcast(held.rows)

    @F.arrow_udf("array<bigint>")
    def packed(column: pa.Array) -> pa.Array:
        directions = sent.value
        positions, rows = to_matrix(column, directions.shape[1])
        words = -(-len(directions) // 64)
        bits = np.zeros((len(column), words * 64), dtype=bool)
        bits[positions, : len(directions)] = rows @ directions.T > 0
        usable = np.zeros(len(column), dtype=bool)
        usable[positions] = True
        longs = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
        offsets = pa.array(np.arange(0, (len(column) + 1) * words, words, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(longs.ravel()), mask=pa.array(~usable))

    return df.withColumn(name, packed(path_col(vector)))


def pair_nearness(a: Column, b: Column, metric: str) -> Column:
    """Nearness of two vector columns, one Arrow batch at a time; both must hold usable vectors."""
    check_metric(metric)

    @F.arrow_udf("double")
    def compared(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.float64())
        width = len(left[0])
        return pa.array(row_nearness(metric, to_matrix(left, width)[1], to_matrix(right, width)[1]))

    return compared(a, b)


def _rescored(
    pairs: DataFrame, stored: DataFrame, asked: DataFrame, metric: str, k: int, max_pairs: int | None
) -> DataFrame:
    """Exact nearness of (query_id, id) pairs, best k per query."""
    small = max_pairs is not None and max_pairs <= BROADCAST_ROWS
    found = stored.join(F.broadcast(pairs) if small else pairs, "id").join(asked, "query_id")
    exact = found.select("query_id", "id", pair_nearness(F.col("v"), F.col("qv"), metric).alias("near"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), F.col("id")))
    return exact.withColumn("rank", place).filter(F.col("rank") <= k)


def candidate_rerank(
    corpus: DataFrame,
    queries: DataFrame,
    planes: DataFrame,
    table: VectorTable,
    k: int = 4,
    candidates: int = 40,
    *,
    metric: str | None = None,
    condition: Filter = None,
    sketch_col: str | None = None,
    vector_col: str | None = None,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    max_queries: int | None = None,
    **search: Any,
) -> DataFrame:
    """Keep the ``candidates`` rows with the fewest differing sketch bits, then rank those exactly.

    ``sketch_col`` names a stored sketch; without one it is computed on the fly. ``max_queries`` is a
    known bound on the queries (counted if not given): where the candidates are few enough, the
    second stage leaves the corpus in place.
    """
    check_range("k", k, 1)
    check_range("candidates", candidates, 1)
    metric = check_metric(metric or table.metric)
    table.check(corpus, need=["id"])
    path = table.vector_path(corpus, vector_col)
    pool = where(corpus, table, condition)
    sketched = pool if sketch_col else add_sketch(pool, planes, path)
    asked = queries.select(path_col(query_id).alias("query_id"), path_col(query_vector).alias("qv"))
    close = nearest(
        sketched.select(table.row_key().alias("id"), path_col(sketch_col or "sketch").alias("v")),
        add_sketch(asked, planes, "qv").select("query_id", F.col("sketch").alias("v")),
        HAMMING, candidates, **search,
    ).select("query_id", "id")
    stored = pool.select(table.row_key().alias("id"), path_col(path).alias("v"))
    bound = (queries.count() if max_queries is None else max_queries) * candidates
    return table.split_key(as_hits(_rescored(close, stored, asked, metric, k, bound), metric), "id", corpus)


# ---- k-NN graph -----------------------------------------------------------------------------------


def knn_graph(
    corpus: DataFrame,
    table: VectorTable,
    max_degree: int = 32,
    build_candidates: int | None = None,
    *,
    planes: DataFrame | None = None,
    within: str | None = None,
    metric: str | None = None,
    **search: Any,
) -> DataFrame:
    """``src, dst, rank, score``: for every row its ``max_degree`` nearest others (in a table with a
    namespace each end has one too: ``src_namespace``, ``dst_namespace``).

    ``within`` names a column (``list_id``) that both ends must share, which turns the all-pairs cost
    into the sum over lists. With ``build_candidates`` a sketch picks that many distinct vectors per
    row first and only those are scored exactly; without it the edges are exact (inside ``within``).

    Equal vectors are searched once, however many rows carry them: a group of copies costs one row in
    the search, and its edges are filled in afterwards, with the same result.
    """
    check_range("max_degree", max_degree, 1)
    metric = check_metric(metric or table.metric)
    if build_candidates is not None:
        check_range("build_candidates", build_candidates, max_degree)
        if planes is None:
            raise ValueError("a candidate stage needs planes")
    table.check(corpus, need=["id"])
    path = path_col(table.vector_path(corpus))
    scope = ["scope"] if within else []
    rows = corpus.filter(is_valid(path, table.dims)).select(
        table.row_key().alias("id"), path.alias("v"), *([path_col(within).alias("scope")] if within else [])
    )
    depth = max_degree + 1  # one more than asked: the row itself may be among them
    groups, hashed = copies_of(rows, scope, depth)
    distinct = settle(rows.join(groups.select("id"), "id", "left_semi"))
    near = _distinct_neighbours(distinct, metric, depth, build_candidates, planes, table.dims, scope, search)
    return spread_to_copies(near, groups, hashed, scope, max_degree, metric, table, corpus)


def copies_of(rows: DataFrame, scope: list[str], depth: int) -> tuple[DataFrame, DataFrame]:
    """Groups of rows (id, v, scope) with one vector, and every row's group key.

    A group is its smallest id, which stands for it, and ``members``, its first ``depth`` ids. Only ids and a
    128-bit hash of the vector are moved.
    """
    same = [*scope, "__h", "__g"]
    hashed = rows.select("id", *scope, F.xxhash64(F.lit(1), "v").alias("__h"), F.xxhash64(F.lit(2), "v").alias("__g"))
    first = hashed
    spark = rows.sparkSession
    if depth > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        # So deep a rank is not cut before the shuffle by itself: cut it in every task first.
        first = first.withColumn("__task", F.spark_partition_id())
        place = F.row_number().over(Window.partitionBy(*same, "__task").orderBy("id"))
        first = first.withColumn("__place", place).filter(F.col("__place") <= depth).drop("__task", "__place")
    place = F.row_number().over(Window.partitionBy(*same).orderBy("id"))
    first = first.withColumn("__place", place).filter(F.col("__place") <= depth)
    groups = first.groupBy(*same).agg(F.sort_array(F.collect_list("id")).alias("members"))
    return settle(groups.withColumn("id", F.col("members")[0])), hashed


def spread_to_copies(
    near: DataFrame, groups: DataFrame, hashed: DataFrame, scope: list[str], max_degree: int, metric: str, table: VectorTable, corpus: DataFrame
) -> DataFrame:
    """The graph of all rows from ``near`` (query_id, id, near), the neighbours of each distinct vector and itself."""
    depth, same = max_degree + 1, [*scope, "__h", "__g"]
    # Ids in place of distinct vectors: of each neighbour only its first ids can be wanted.
    named = near.join(groups.select("id", "members"), "id").select(
        "query_id", "near", F.explode("members").alias("id")
    )
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), F.col("id")))
    best = named.withColumn("__place", order).filter(F.col("__place") <= depth)
    lists = settle(  # used for both kinds of rows below
        best.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("__place", "id", "near"))).alias("__found"))
    )

    # Every row takes the list of its vector, minus itself. Rows beyond ``members`` exist only in big
    # groups of copies. They are the hot keys: the lists go to them by broadcast when those groups are
    # few, else in a join that reads both sides straight from a shuffle, where AQE splits the hot ones.
    taken = groups.select(F.col("id").alias("query_id"), F.explode("members").alias("src")).join(lists, "query_id")
    big = groups.filter(F.size("members") == depth).select(
        *same, F.col("id").alias("query_id"), F.element_at("members", -1).alias("__last")
    )
    few = fits_broadcast(big, BROADCAST_ROWS // depth)
    big = big.join(lists, "query_id")
    more = hashed.withColumnRenamed("id", "src").join(F.broadcast(big) if few else big, same)
    taken = taken.select("src", "__found").unionByName(
        more.filter(F.col("src") > F.col("__last")).select("src", "__found")
    )
    others = F.filter("__found", lambda hit: hit["id"] != F.col("src"))
    taken = taken.select("src", F.slice(others, 1, max_degree).alias("__found"))
    edges = taken.select("src", F.posexplode("__found").alias("__at", "hit")).select(
        F.col("src").alias("query_id"), (F.col("__at") + 1).alias("rank"),
        F.col("hit.id").alias("id"), F.col("hit.near").alias("near"),
    )
    hits = as_hits(edges, metric)
    graph = hits.select(F.col("query_id").alias("src"), F.col("id").alias("dst"), "rank", *hits.columns[3:])
    return table.split_key(table.split_key(graph, "src", corpus, "src_"), "dst", corpus, "dst_")


def _distinct_neighbours(
    distinct: DataFrame,
    metric: str,
    depth: int,
    build_candidates: int | None,
    planes: DataFrame | None,
    dims: int | None,
    scope: list[str],
    search: dict[str, Any],
) -> DataFrame:
    """``query_id, id, near``: the ``depth`` nearest among distinct vectors, each itself included."""

    def asked(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").alias("query_id"), "v", *[F.array(c).alias(c) for c in scope])

    if build_candidates is None:
        found = nearest(distinct, asked(distinct), metric, depth, dims=dims, trusted=True, **search)
        return found.select("query_id", "id", "near")
    sketched = add_sketch(distinct, planes, "v").select("id", F.col("sketch").alias("v"), *scope)
    close = nearest(sketched, asked(sketched), HAMMING, build_candidates + 1, trusted=True, **search)
    sources = distinct.select(F.col("id").alias("query_id"), F.col("v").alias("qv"))
    exact = _rescored(close.select("query_id", "id"), distinct.select("id", "v"), sources, metric, depth, None)
    return exact.select("query_id", "id", "near")
