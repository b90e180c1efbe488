"""Retrieval end to end: queries (texts or vectors) to ranked documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from vectable.functions.predicates import Filter
from vectable.operators.fetch import to_documents
from vectable.operators.ingest import EmbedderFactory, embed
from vectable.operators.mmr import mmr
from vectable.operators.search import attach, batch_topk, post_stages, relevance
from vectable.sources.tables import settle
from vectable.table import VectorTable, path_col

SEARCH_TYPES = ("similarity", "mmr", "similarity_score_threshold")


def embed_queries(queries: DataFrame, model: EmbedderFactory, text: str = "query_text") -> DataFrame:
    """Add ``query_vector`` from the query texts."""
    return queries.withColumn("query_vector", embed(path_col(text), model))


def topk_by_text(
    corpus: DataFrame, queries: DataFrame, table: VectorTable, model: EmbedderFactory, k: int = 4, **search: Any
) -> DataFrame:
    """Embed a table of query texts, then search with it. ``model`` is per call, so it may differ from
    the one that embedded the corpus."""
    return batch_topk(corpus, embed_queries(queries, model), table, k, **search)


def retrieve(
    corpus: DataFrame,
    queries: DataFrame,
    table: VectorTable,
    k: int = 4,
    *,
    search_type: str = "similarity",
    model: EmbedderFactory | None = None,
    condition: Filter = None,
    minimum: float | None = None,
    relevance_fn: Callable[[Column], Column] | None = None,
    fetch_k: int = 20,
    lambda_mult: float = 0.5,
    stages: Sequence[Callable[[DataFrame], DataFrame]] = (),
    include_vectors: bool = False,
    max_queries: int | None = None,
    gather: bool = False,
    **search: Any,
) -> DataFrame:
    """``query_id, rank, score, id, text, metadata`` for every query of a table.

    ``search_type``: ``similarity``, ``mmr``, or ``similarity_score_threshold`` (needs ``minimum``,
    compared with the score after ``relevance_fn``). Text and metadata are joined to the hits at the
    end; the search itself reads ids and vectors. ``gather`` gives one row per query with its hits in
    order (at most k).
    """
    if search_type not in SEARCH_TYPES:
        raise ValueError(f"search_type must be one of {', '.join(SEARCH_TYPES)}")
    if search_type == "similarity_score_threshold" and minimum is None:
        raise ValueError("a threshold search needs a minimum score")
    asked = queries if model is None else embed_queries(queries, model)
    if max_queries is None:
        max_queries = queries.count()
    if search_type == "mmr":
        if model is not None:
            asked = settle(asked)  # used twice below: embed once
        hits = mmr(
            corpus, asked, table, k, fetch_k, lambda_mult, condition=condition, max_hits=max_queries * fetch_k, **search
        )
    else:
        hits = batch_topk(corpus, asked, table, k, condition=condition, **search)
        cut = minimum if search_type == "similarity_score_threshold" else None
        hits = relevance(hits, relevance_fn, cut)
    stored = corpus if include_vectors else corpus.drop(table.embedding)
    columns = [c for c in stored.columns if c not in table.key]
    # Hit columns go by names of their own until stored columns, which may be called the same, are folded away.
    own = {c: c if c in ("id", "namespace") else f"__hit_{c}" for c in hits.columns}
    named = hits.select(*[F.col(c).alias(name) for c, name in own.items()])
    joined = attach(named, stored, table, columns, max_hits=max_queries * k).withColumnRenamed("id", table.id)
    keep = [name for c, name in own.items() if c != "id"]
    found = to_documents(joined, table, keep=keep, include_vectors=include_vectors)
    found = found.withColumnsRenamed({name: c for c, name in own.items() if c != "id"})
    found = post_stages(found, *stages)
    if not gather:
        return found
    parts = F.collect_list(F.struct(*[c for c in found.columns if c != "query_id"]))
    in_order = F.array_sort(parts, lambda a, b: a["rank"] - b["rank"])
    return found.groupBy("query_id").agg(in_order.alias("hits"))
