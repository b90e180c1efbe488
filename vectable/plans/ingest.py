"""Ingest end to end: a batch of documents to the next state of a table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from vectable.operators.ingest import (
    EmbedderFactory,
    assign_ids,
    drop_known,
    embed,
    embed_corpus,
    latest_per_id,
    upsert_merge,
    upsert_replace,
)
from vectable.operators.validate import validate_rows, validate_vectors
from vectable.sources.tables import settle
from vectable.table import VectorTable, path_col


class Ingested(NamedTuple):
    table: DataFrame  # the next state
    batch: DataFrame  # what went in, ids assigned
    rejects: DataFrame


def ingest(
    current: DataFrame,
    batch: DataFrame,
    table: VectorTable,
    *,
    model: EmbedderFactory | None = None,
    skip_known: bool = False,
    duplicate: Column | None = None,
    order: str | None = None,
    merge: bool = False,
) -> Ingested:
    """Drop what is known, assign ids, embed, validate, keep one row per key, upsert.

    Of rows with one key, the one with the highest ``order`` stays; without an order, one that does not
    depend on partitioning. A row without text keeps the vector it brings; in a merge it refreshes
    only the vector of its key. Missing metadata is stored as NULL, which reads as empty.
    The prepared batch is checkpointed before it is used: ids are drawn and texts embedded once, and
    a lost executor cannot make them come out differently.
    """
    fresh = drop_known(batch, current if skip_known else None, on=table.text, duplicate=duplicate)
    fresh = assign_ids(fresh, table)
    if model is not None:
        given = F.col(table.embedding).cast("array<float>") if table.embedding in fresh.columns else None
        fresh = embed_corpus(fresh, table, model) if given is None else fresh.withColumn(
            table.embedding, F.coalesce(embed(path_col(table.text), model), given)
        )
    fresh = settle(fresh)
    rows = validate_rows(fresh, table)
    vectors = validate_vectors(rows.valid, table)
    good = settle(latest_per_id(vectors.valid, table, order).drop(*([] if order is None else [order])))
    after = upsert_merge(current, good, table, keep_text=True) if merge else upsert_replace(current, good, table)
    return Ingested(after, good, rows.rejects.unionByName(vectors.rejects))
