"""Diversity re-ranking: maximal marginal relevance (Carbonell & Goldstein, SIGIR 1998)."""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from vectable.functions.predicates import Filter
from vectable.operators.search import attach, batch_topk
from vectable.table import VectorTable, check_range, path_col

# Rows of a group, padded and in double, stay within this.
GROUP_BYTES = 128 * 1024 * 1024

# Gains closer than this are the same gain: where exact arithmetic ties, rounding must not decide.
_DECIMALS = 9


def check_lambda(value: float) -> float:
    if not 0 <= value <= 1:
        raise ValueError("a weight lies in [0, 1]: lambda_mult")
    return float(value)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=-1, keepdims=True))
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def pick_diverse(queries: np.ndarray, candidates: np.ndarray, present: np.ndarray, k: int, weight: float) -> np.ndarray:
    """Greedy picks for many queries at once: [queries, k] candidate positions, -1 where none is left.

    ``candidates`` is [queries, fetch_k, dims] in rank order, ``present`` marks the real ones. Always
    by cosine; the earlier candidate wins a tie.
    """
    asked, stored = _unit(queries), _unit(candidates)
    relevance = np.einsum("qd,qfd->qf", asked, stored)
    alike = np.full(relevance.shape, -np.inf)
    free = present.copy()
    rows = np.arange(len(queries))
    picks = np.full((len(queries), k), -1)
    for step in range(min(k, candidates.shape[1])):
        gain = relevance if step == 0 else weight * relevance - (1 - weight) * alike
        gain = np.where(free, np.round(gain, _DECIMALS), -np.inf)
        best = gain.argmax(axis=1)
        found = free[rows, best]
        picks[found, step] = best[found]
        free[rows[found], best[found]] = False
        alike = np.maximum(alike, np.einsum("qd,qfd->qf", stored[rows, best], stored))
    return picks


def rerank_diverse(
    hits: DataFrame, k: int = 4, lambda_mult: float = 0.5, *, queries: int | None = None, per_group: int | None = None
) -> DataFrame:
    """Pick k per query from hits that carry ``query_vector`` and ``vector``; ranks are renumbered.

    Queries are hashed into groups of about ``per_group`` (by default as many as ``GROUP_BYTES`` hold, measured), whose hits (at most fetch_k each) come
    together in one Arrow table: each greedy step is then one array operation over the group.
    ``queries`` is their number, counted if not given.
    """
    check_range("k", k, 1)
    weight = check_lambda(lambda_mult)
    if queries is None:
        queries = hits.select("query_id").distinct().count()
    if per_group is None:
        longest = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("w"))
        weight_each = longest.agg(F.max(F.col("n") * F.col("w"))).first()[0] or 1
        per_group = max(1, min(200, GROUP_BYTES // (3 * 8 * weight_each)))
    key = [c for c in ("namespace", "id") if c in hits.columns]
    schema = T.StructType(
        [
            hits.schema["query_id"],
            T.StructField("rank", T.IntegerType()),
            *[hits.schema[c] for c in key],
            T.StructField("score", T.DoubleType()),
        ]
    )

    def chosen(group: pa.Table) -> pa.Table:
        return _choose(group, key, k, weight)

    wanted = hits.select("query_id", "rank", *key, "score", "vector", "query_vector")
    groups = F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-queries // per_group)))).alias("__group")
    return wanted.groupBy(groups).applyInArrow(chosen, schema)


def _choose(group: pa.Table, key: list[str], k: int, weight: float) -> pa.Table:
    group = group.sort_by([("query_id", "ascending"), ("rank", "ascending")]).combine_chunks()
    ids = group.column("query_id").combine_chunks().dictionary_encode()
    query = ids.indices.to_numpy()
    counts = np.bincount(query)
    starts = np.cumsum(counts) - counts
    slot = np.arange(len(query)) - starts[query]

    def rows(name: str) -> np.ndarray:
        lists = group.column(name).combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)

    vectors, asked = rows("vector"), rows("query_vector")[starts]
    stacked = np.zeros((len(counts), int(counts.max()), asked.shape[1]))
    present = np.zeros(stacked.shape[:2], dtype=bool)
    stacked[query, slot], present[query, slot] = vectors, True
    picks = pick_diverse(asked, stacked, present, k, weight)
    at, step = np.nonzero(picks >= 0)
    taken = group.take(pa.array(starts[at] + picks[at, step]))
    return pa.table(
        [taken.column("query_id"), pa.array(step + 1, pa.int32()), *[taken.column(c) for c in key], taken.column("score")],
        names=["query_id", "rank", *key, "score"],
    )


def mmr(
    corpus: DataFrame,
    queries: DataFrame,
    table: VectorTable,
    k: int = 4,
    fetch_k: int = 20,
    lambda_mult: float = 0.5,
    *,
    metric: str | None = None,
    condition: Filter = None,
    vector_col: str | None = None,
    max_hits: int | None = None,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    **search: Any,
) -> DataFrame:
    """Top ``fetch_k`` by the table's metric, then k of them picked for relevance and diversity.

    k and fetch_k are independent: fewer than k rows come back when fetch_k is smaller.
    ``lambda_mult`` 1 is pure relevance, 0 pure diversity.
    """
    check_range("fetch_k", fetch_k, 1)
    hits = batch_topk(
        corpus, queries, table, fetch_k, metric=metric, condition=condition, vector_col=vector_col,
        query_id=query_id, query_vector=query_vector, **search,
    )
    hits = hits.drop("distance")
    count = queries.count() if max_hits is None else -(-max_hits // fetch_k)
    asked = queries.select(path_col(query_id).alias("query_id"), path_col(query_vector).alias("query_vector"))
    full = with_vectors(hits, corpus, asked, table, vector_col, count * fetch_k)
    weight = 3 * 8 * fetch_k * (table.dims or 2048)  # read, padded, of unit length
    return rerank_diverse(full, k, lambda_mult, queries=count, per_group=max(1, min(200, GROUP_BYTES // weight)))


def with_vectors(
    hits: DataFrame,
    corpus: DataFrame,
    asked: DataFrame,
    table: VectorTable,
    vector_col: str | None = None,
    max_hits: int | None = None,
) -> DataFrame:
    """Hits with the stored vector as ``vector`` and the query's as ``query_vector``."""
    path = table.vector_path(corpus, vector_col)
    plain = corpus.select(*[path_col(c).alias(c) for c in table.key], path_col(path).alias("vector"))
    return attach(hits, plain, table, ["vector"], max_hits=max_hits).join(asked, "query_id")
