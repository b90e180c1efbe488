"""Exact nearest-neighbour search over whole tables.

``topk`` answers one query vector; ``batch_topk`` a table of queries. Both return hits
``rank, id, score`` (batch: also ``query_id``; L2: also ``distance``; in a table with a namespace also
``namespace``), best first, ties to the smaller key, and never more than k per query.

How a batch runs. Queries that fit are shared with all tasks; each task keeps a running top-k per
query while it streams through its part of the corpus, and sends on only that. The corpus is read
once, never shuffled, and pairs are never rows. Queries that do not fit are laid out with the corpus
in a grid of cells of bounded size, one matrix product per cell; again only top-k leaves a cell. Where a
vector would be copied to more than a few cells, both sides are packed, written once and read by the
tasks of a Cartesian product, so that the shuffle grows with the input and not with the cells.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vectable.functions.predicates import Filter, where
from vectable.functions.running_topk import HAMMING, WINNER_BYTES, RunningTopK, as_matrix
from vectable.functions.vectors import is_valid, query_nearness
from vectable.sources.tables import BROADCAST_ROWS, either_side, fits_broadcast, row_bytes, settle
from vectable.table import EUCLIDEAN, VectorTable, check_metric, check_range, check_vector, path_col, path_type

HELD_BYTES = 256 * 1024 * 1024  # centroids, planes and bounds that a task may hold
SHARED_QUERY_BYTES = 16 * 1024 * 1024  # every Python worker holds the queries several times over, and their winners
CELL_BYTES = 16 * 1024 * 1024
FEW_SLABS = 4  # of the other side, to which a vector is copied in a shuffle
PACK_BYTES = 2 * 1024 * 1024  # vectors that travel as one row to the cells of a grid
FEW_HITS = 50_000  # broadcast without being weighed
LISTED_SCOPES = 10_000  # written into the filter, where they prune partitions at once; more of them are joined


# ---- one query ------------------------------------------------------------------------------------


def scope_to(df: DataFrame, table: VectorTable, namespace: str | None) -> DataFrame:
    """Rows of one namespace; on a table partitioned by namespace this prunes the scan."""
    if namespace is None:
        return df
    if table.namespace is None:
        raise ValueError("the table has no namespace column")
    return df.filter(path_col(table.namespace) == F.lit(namespace))


def scored(
    corpus: DataFrame,
    vector: Sequence[float],
    table: VectorTable,
    *,
    metric: str | None = None,
    vector_col: str | None = None,
) -> DataFrame:
    """The corpus with its ``score`` for one query (L2: and ``distance``); unusable vectors drop out."""
    metric = check_metric(metric or table.metric)
    target = check_vector(vector, table.dims)
    v = path_col(table.vector_path(corpus, vector_col))
    out = corpus.withColumn("score", query_nearness(v, target, metric)).filter(F.col("score").isNotNull())
    if metric != EUCLIDEAN:
        return out
    return out.withColumn("distance", -F.col("score")).withColumn("score", 1 / (1 + F.col("distance")))


def topk(
    corpus: DataFrame,
    vector: Sequence[float],
    table: VectorTable,
    k: int = 4,
    *,
    metric: str | None = None,
    condition: Filter = None,
    namespace: str | None = None,
    vector_col: str | None = None,
) -> DataFrame:
    """The k best rows for one query vector. The filter and namespace apply before ranking, so k rows
    come back whenever k rows match."""
    check_range("k", k, 1)
    metric = check_metric(metric or table.metric)
    table.check(corpus, need=["id"])
    pool = where(scope_to(corpus, table, namespace), table, condition)
    spaced = [path_col(table.namespace).alias("namespace")] if table.namespace else []
    pool = pool.select(*spaced, path_col(table.id).alias("id"), path_col(table.vector_path(corpus, vector_col)).alias("v"))
    hits = scored(pool, vector, table, metric=metric, vector_col="v").drop("v")
    order = [F.asc("distance") if metric == EUCLIDEAN else F.desc("score")]
    order += [F.asc(c) for c in ("namespace", "id") if c in hits.columns]
    best = hits.orderBy(*order).limit(k)
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # over k rows
    return ranked.select("rank", *hits.columns)


# ---- steps on hits --------------------------------------------------------------------------------


def _per_query(hits: DataFrame) -> Window:
    keys = ["query_id"] if "query_id" in hits.columns else []
    return Window.partitionBy(*keys).orderBy("rank")


def threshold(hits: DataFrame, minimum: float | None) -> DataFrame:
    """Hits with ``score >= minimum``; may leave fewer than k. None is off."""
    return hits if minimum is None else hits.filter(F.col("score") >= F.lit(float(minimum)))


def relevance(hits: DataFrame, fn: Callable[[Column], Column] | None = None, minimum: float | None = None) -> DataFrame:
    """Map the raw score (identity by default), then cut on the mapped one."""
    return threshold(hits if fn is None else hits.withColumn("score", fn(F.col("score"))), minimum)


def page(hits: DataFrame, top: int, skip: int = 0, minimum: float | None = None) -> DataFrame:
    """Threshold, then skip, then limit, on hits ranked to ``top + skip``; skip counts the survivors."""
    check_range("top", top, 1)
    check_range("skip", skip, 0)
    left = threshold(hits, minimum).withColumn("__place", F.row_number().over(_per_query(hits)))
    kept = left.filter(F.col("__place").between(skip + 1, skip + top))
    return kept.withColumn("rank", (F.col("__place") - skip).cast("int")).drop("__place")


def post_stages(hits: DataFrame, *stages: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Caller's steps on the hit rows, after ranking."""
    for stage in stages:
        hits = hits.transform(stage)
    return hits


def attach(
    hits: DataFrame, corpus: DataFrame, table: VectorTable, columns: Sequence[str], *, max_hits: int | None = None
) -> DataFrame:
    """Join columns of the corpus to the hits by key, so that ranking never reads them.

    ``max_hits`` is a known bound (queries times k). Within the broadcast bound the corpus stays in
    place; without one Spark picks the join at run time. A column is named by the last step of its path,
    or by the whole path where last steps are the same.
    """
    last = [c.split(".")[-1] for c in columns]
    names = [c.replace(".", "_") if last.count(n) > 1 else n for c, n in zip(columns, last)]
    keys = {"id": table.id, **({"namespace": table.namespace} if "namespace" in hits.columns and table.namespace else {})}
    wanted = corpus.select(
        *[path_col(path).alias(f"__{key}") for key, path in keys.items()],
        *[path_col(c).alias(name) for c, name in zip(columns, names)],
    )
    small = max_hits is not None and max_hits <= BROADCAST_ROWS
    if small and max_hits > FEW_HITS:  # ids may be long: weigh them, computed once
        hits = settle(hits)
        small = fits_broadcast(hits)
    on = [wanted[f"__{key}"].eqNullSafe(hits[key]) if key == "namespace" else wanted[f"__{key}"] == hits[key] for key in keys]
    joined = wanted.join(F.broadcast(hits) if small else hits, on)
    return joined.select(*[hits[c] for c in hits.columns], *[wanted[name] for name in names])


# ---- many queries ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Queries:
    frame: DataFrame  # query_id, v [, scope array]
    count: int
    width: int
    shared: bool  # small enough to hand to every task


def _prepare(queries: DataFrame, metric: str, dims: int | None, k: int, limit: int) -> _Queries:
    """Count the queries, without computing their vectors, weigh their ids and scopes, and see whether all that and
    their running winners fit in a task."""
    weight = row_bytes(F.col("query_id"), queries.schema["query_id"].dataType)
    if "scope" in queries.columns:
        weight = weight + row_bytes(F.col("scope"), queries.schema["scope"].dataType)
    count, own = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    width = dims if metric != HAMMING else None
    if width is None:
        first = queries.select(F.size("v").alias("n")).filter("n > 0").head(1)
        width = first[0]["n"] if first else 1
    return _Queries(queries, count, width, own + count * (8 * width + WINNER_BYTES * k) <= limit)


def _check_held(held: pa.Table, metric: str, width: int) -> np.ndarray:
    """Raise on an unusable or repeated query; returns the query vectors as a matrix."""
    positions, matrix = as_matrix(held.column("v"), metric, width)
    ids = held.column("query_id")
    if len(positions) != held.num_rows or ids.null_count:
        raise ValueError(f"every query needs an id and {width} finite vector elements")
    if pc.count_distinct(ids).as_py() != held.num_rows:
        raise ValueError("query ids repeat")
    return matrix


def _check_spread(queries: _Queries, metric: str) -> None:
    """The same checks as a job, for queries too many to hold."""
    v = F.col("v")
    usable = is_valid(v, queries.width) if metric != HAMMING else F.size(v) == F.lit(queries.width)
    bad = F.count_if(~F.coalesce(usable, F.lit(False)) | F.col("query_id").isNull())
    if queries.frame.agg(bad).first()[0]:
        raise ValueError(f"every query needs an id and {queries.width} finite vector elements")
    if queries.frame.groupBy("query_id").count().filter("count > 1").head(1):
        raise ValueError("query ids repeat")


def batch_topk(
    corpus: DataFrame,
    queries: DataFrame,
    table: VectorTable,
    k: int = 4,
    *,
    metric: str | None = None,
    condition: Filter = None,
    scope: tuple[str, str] | None = None,
    vector_col: str | None = None,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    engine: str = "auto",
    seed_fraction: float = 0.0,
    shared_bytes: int = SHARED_QUERY_BYTES,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """The k best corpus rows for every query of a table.

    ``scope`` is (corpus column, query column): a query meets only corpus rows whose value equals its
    own, or is in its own array. A table with a namespace uses it as scope when the queries carry it.

    ``engine``: ``shared`` or ``grid`` as described above, ``auto`` picks by the measured size of the
    queries. ``seed_fraction`` first answers the queries on a sample of the corpus: the k-th best
    score found there bounds the real one from below, so tasks can drop everything under it early.
    The result is the same; it pays off when very many tasks would each send k rows per query.
    """
    check_range("k", k, 1)
    metric = check_metric(metric or table.metric)
    table.check(corpus, need=["id"])
    if scope is None and table.namespace and table.namespace in queries.columns:
        scope = (table.namespace, table.namespace)
    pool = where(corpus, table, condition)
    vectors = table.vector_path(corpus, vector_col)
    near = nearest(
        pool.select(
            table.row_key().alias("id"),
            path_col(vectors).alias("v"),
            *([path_col(scope[0]).alias("scope")] if scope else []),
        ),
        queries.select(
            path_col(query_id).alias("query_id"),
            path_col(query_vector).alias("v"),
            *([_as_array(queries, scope[1])] if scope else []),
        ),
        metric,
        k,
        dims=table.dims,
        engine=engine,
        seed_fraction=seed_fraction,
        shared_bytes=shared_bytes,
        cell_bytes=cell_bytes,
    )
    return table.split_key(as_hits(near, metric), "id", corpus)


def _as_array(queries: DataFrame, name: str) -> Column:
    column = path_col(name)
    if not isinstance(path_type(queries.schema, name), T.ArrayType):
        column = F.array(column)
    return column.alias("scope")


def as_hits(near: DataFrame, metric: str) -> DataFrame:
    """Ranked nearness to hits."""
    if metric != EUCLIDEAN:
        return near.select("query_id", "rank", "id", F.col("near").alias("score"))
    distance = -F.col("near")
    return near.select("query_id", "rank", "id", (1 / (1 + distance)).alias("score"), distance.alias("distance"))


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    metric: str,
    k: int,
    *,
    dims: int | None = None,
    engine: str = "auto",
    seed_fraction: float = 0.0,
    shared_bytes: int = SHARED_QUERY_BYTES,
    cell_bytes: int = CELL_BYTES,
    trusted: bool = False,
) -> DataFrame:
    """``query_id, id, near, rank`` from corpus (id, v [, scope]) and queries (query_id, v [, scope]).

    ``trusted``: the caller made the queries from checked rows with unique ids.
    """
    if engine not in ("auto", "shared", "grid"):
        raise ValueError("engine is 'auto', 'shared' or 'grid'")
    ready = _prepare(queries, metric, dims, k, shared_bytes)
    if engine == "grid" or (engine == "auto" and not ready.shared):
        if not trusted:
            _check_spread(ready, metric)
        return _ranked(_grid(corpus, ready, metric, k, cell_bytes), k, ready.count)
    if not ready.shared:
        raise ValueError("too many queries to share; use engine='grid'")
    held = queries.toArrow()
    matrix = _check_held(held, metric, ready.width)
    floor = None
    if seed_fraction > 0:
        sample = _shared(corpus.sample(seed_fraction, seed=1), ready, held, matrix, metric, k)
        last = _ranked(sample, k, ready.count).filter(F.col("rank") == k).select("query_id", "near").toArrow()
        found = pc.index_in(held.column("query_id"), last.column("query_id"))
        floor = last.column("near").take(found).fill_null(-np.inf).to_numpy()
    return _ranked(_shared(corpus, ready, held, matrix, metric, k, floor), k, ready.count)


def _ranked(local: DataFrame, k: int, n_queries: int) -> DataFrame:
    """Merge per-task winners. With few queries a first round over (query, slice) spreads the merge,
    so that one task never receives the winners of every corpus partition."""
    spark = local.sparkSession
    order = [F.desc("near"), F.col("id")]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = -(-width // max(1, n_queries))
    if slices > 1:
        sliced = local.withColumn("__slice", F.spark_partition_id() % slices)
        first = Window.partitionBy("query_id", "__slice").orderBy(*order)
        local = sliced.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
        local = local.select("query_id", "id", "near")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return local.withColumn("rank", place).filter(F.col("rank") <= k)


def _local_schema(corpus: DataFrame, queries: DataFrame) -> tuple[T.StructType, pa.Schema]:
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("near", T.DoubleType()),
        ]
    )
    return schema, pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema])


def _arrow_type(dtype: T.DataType) -> pa.DataType:
    known = {
        T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32(),
        T.ShortType: pa.int16(), T.ByteType: pa.int8(), T.DoubleType: pa.float64(),
    }
    for kind, arrow in known.items():
        if isinstance(dtype, kind):
            return arrow
    raise ValueError(f"ids of type {dtype.simpleString()} are not supported")


def _positions_by_scope(scope: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Scope values, where each one's queries start, and the positions of the queries that look there."""
    if isinstance(scope, pa.ChunkedArray):
        scope = scope.combine_chunks()
    parent = pc.list_parent_indices(scope).to_numpy()
    coded = scope.flatten().dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    pairs = np.unique(np.stack([codes, parent], axis=1)[codes >= 0], axis=0)
    return coded.dictionary, np.searchsorted(pairs[:, 0], np.arange(len(coded.dictionary) + 1)), pairs[:, 1]


def _shared(
    corpus: DataFrame,
    queries: _Queries,
    held: pa.Table,
    matrix: np.ndarray,
    metric: str,
    k: int,
    floor: np.ndarray | None = None,
) -> DataFrame:
    """Per-task winners, queries handed to every task."""
    width = queries.width
    schema, arrow = _local_schema(corpus, queries.frame)
    lookup = _positions_by_scope(held.column("scope")) if "scope" in held.column_names else None
    ids = held.column("query_id").combine_chunks()
    sent = corpus.sparkSession.sparkContext.broadcast((ids, matrix, lookup, floor))
    if lookup is not None and len(lookup[0]) <= LISTED_SCOPES:
        corpus = corpus.filter(F.col("scope").isin(lookup[0].sort().to_pylist()))
    elif lookup is not None:  # the join prunes partitions when it runs
        wanted = corpus.sparkSession.createDataFrame(pa.table({"__scope": lookup[0]}))
        corpus = corpus.join(F.broadcast(wanted), F.col("scope") == F.col("__scope"), "left_semi")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors, wanted, low = sent.value
        best = RunningTopK(metric, vectors, k, low)
        for batch in batches:
            positions, rows = as_matrix(batch.column(1), metric, width)
            names = batch.column(0).take(pa.array(positions))
            if wanted is None:
                best.offer(rows, names)
                continue
            coded = batch.column(2).take(pa.array(positions)).dictionary_encode()
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            values, starts, asked = wanted
            known = pc.index_in(coded.dictionary, value_set=values.cast(coded.dictionary.type)).fill_null(-1).to_numpy(zero_copy_only=False)
            for code, at in enumerate(known):
                if at >= 0:
                    member = np.flatnonzero(codes == code)
                    best.offer(rows[member], names.take(pa.array(member)), asked[starts[at] : starts[at + 1]])
        yield from best.result(query_ids, arrow)

    return corpus.mapInArrow(scan, schema)


def _grid(corpus: DataFrame, queries: _Queries, metric: str, k: int, cell_bytes: int) -> DataFrame:
    """Per-cell winners. Each side of a scope is cut by key hash into slabs of bounded size (on the query
    side with room for the winners); a cell is one corpus slab with one query slab. A hot scope has
    more slabs, hence more cells, not bigger ones. Keys are unique, so the slabs are even. Without a scope, more
    than ``FEW_SLABS`` on a side would copy every vector of the other as often: then packs are paired instead."""
    schema, arrow = _local_schema(corpus, queries.frame)
    width = queries.width
    row_slab, ask_slab = max(1, cell_bytes // (8 * width)), max(1, cell_bytes // (8 * width + WINNER_BYTES * k))
    asked = queries.frame
    if "scope" in asked.columns:
        asked = asked.withColumn("scope", F.explode(F.array_distinct("scope")))
        rows = corpus.groupBy("scope").agg(F.count(F.lit(1)).alias("__rows"))
        sizes = asked.groupBy("scope").agg(F.count(F.lit(1)).alias("__asks")).join(rows, "scope")
        sizes = either_side(sizes)
        corpus, asked = corpus.join(sizes, "scope"), asked.join(sizes, "scope")
        row_slabs = F.ceil(F.col("__rows") / row_slab).cast("int")
        ask_slabs = F.ceil(F.col("__asks") / ask_slab).cast("int")
        keys = ["scope", "__i", "__j"]
    else:
        total = corpus.count()
        slabs = [max(1, math.ceil(total / row_slab)), max(1, math.ceil(queries.count / ask_slab))]
        if max(slabs) > FEW_SLABS:
            return _all_cells(corpus, total, queries, metric, k)
        row_slabs, ask_slabs = (F.lit(n) for n in slabs)
        keys = ["__i", "__j"]

    def laid(df: DataFrame, key: str, own: str, own_slabs: Column, other: str, other_slabs: Column) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64(key), own_slabs.cast("bigint")).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), other_slabs - 1)))

    left = laid(corpus, "id", "__i", row_slabs, "__j", ask_slabs).select(
        *keys, "id", "v", F.lit(None).cast(schema["query_id"].dataType).alias("query_id"),
        F.lit(None).cast(queries.frame.schema["v"].dataType).alias("qv"),
    )
    right = laid(asked, "query_id", "__j", ask_slabs, "__i", row_slabs).select(
        *keys, F.lit(None).cast(schema["id"].dataType).alias("id"),
        F.lit(None).cast(corpus.schema["v"].dataType).alias("v"), "query_id", F.col("v").alias("qv"),
    )

    def cell(both: pa.Table) -> pa.Table:
        asks = both.filter(pc.is_valid(both.column("query_id")))
        stored = both.filter(pc.is_null(both.column("query_id")))
        _, vectors = as_matrix(asks.column("qv"), metric, width)
        positions, rows = as_matrix(stored.column("v"), metric, width)
        best = RunningTopK(metric, vectors, k)
        names = stored.column("id").combine_chunks().take(pa.array(positions))
        step = 20_000
        for start in range(0, len(rows), step):
            best.offer(rows[start : start + step], names.slice(start, step))
        found = list(best.result(asks.column("query_id").combine_chunks(), arrow))
        return pa.Table.from_batches(found, schema=arrow)

    return left.unionByName(right).groupBy(*keys).applyInArrow(cell, schema)


def _packed(df: DataFrame, key: str, metric: str, width: int, rows: int, size: int) -> DataFrame:
    """The usable vectors of (key, v), ``size`` to a row: pack, key__ids (an Arrow stream) and key__vectors. Written once."""
    single = metric != HAMMING and isinstance(df.schema["v"].dataType.elementType, T.FloatType)
    kind = _arrow_type(df.schema[key].dataType)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts, held = [], [], 0

        def out() -> pa.RecordBatch:
            ids = pa.concat_arrays(names).cast(kind)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("ids", kind)])) as stream:
                stream.write_batch(pa.record_batch([ids], names=["ids"]))
            vectors = pa.array([np.ascontiguousarray(np.concatenate(parts)).tobytes()], pa.binary())
            return pa.record_batch(
                [pa.array([uuid.uuid4().hex]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), vectors],
                names=[f"{key}__pack", f"{key}__ids", f"{key}__vectors"],
            )

        for batch in batches:
            positions, found = as_matrix(batch.column(1), metric, width)
            found = found.astype(np.float32) if single else found
            ids = batch.column(0).take(pa.array(positions))
            at = 0
            while at < len(found):
                step = min(size - held, len(found) - at)
                names.append(ids.slice(at, step))
                parts.append(found[at : at + step])
                at, held = at + step, held + step
                if held == size:
                    yield out()
                    names, parts, held = [], [], 0
        if held:
            yield out()

    tasks = min(-(-rows // size), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.select(key, "v").repartition(max(1, tasks), key)  # even, and as many full packs as there are
    return settle(dealt.mapInArrow(pack, f"{key}__pack string, {key}__ids binary, {key}__vectors binary"))


def _all_cells(corpus: DataFrame, rows: int, queries: _Queries, metric: str, k: int) -> DataFrame:
    """Every pack of the corpus with every pack of the queries, each a slab of its side. The running winners of a pack of
    queries live as long as packs of the corpus come to it."""
    schema, arrow = _local_schema(corpus, queries.frame)
    width, each = queries.width, 8 * queries.width + WINNER_BYTES * k
    single = {
        name: metric != HAMMING and isinstance(df.schema["v"].dataType.elementType, T.FloatType)
        for name, df in (("id", corpus), ("query_id", queries.frame))
    }
    stored = _packed(corpus, "id", metric, width, rows, max(1, PACK_BYTES // (8 * width + 8)))
    asked = _packed(queries.frame, "query_id", metric, width, queries.count, max(1, 2 * PACK_BYTES // each))

    def opened(ids: pa.Scalar, vectors: pa.Scalar, name: str) -> tuple[pa.Array, np.ndarray]:
        names = pa.ipc.open_stream(ids.as_buffer()).read_all().column(0).combine_chunks()
        kind = np.uint64 if metric == HAMMING else np.float32 if single[name] else np.float64
        matrix = np.frombuffer(vectors.as_buffer(), dtype=kind).reshape(len(names), width)
        return names, matrix if metric == HAMMING else matrix.astype(np.float64)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, names = None, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                pack = batch.column(0)[at].as_py()
                if pack != current:
                    if best is not None:
                        yield from best.result(names, arrow)
                    names, vectors = opened(batch.column(1)[at], batch.column(2)[at], "query_id")
                    current, best = pack, RunningTopK(metric, vectors, k)
                ids, vectors = opened(batch.column(3)[at], batch.column(4)[at], "id")
                best.offer(vectors, ids)
        if best is not None:
            yield from best.result(names, arrow)

    pairs = asked.hint("shuffle_replicate_nl").crossJoin(stored)
    pairs = pairs.select("query_id__pack", "query_id__ids", "query_id__vectors", "id__ids", "id__vectors")
    return pairs.mapInArrow(cells, schema)
