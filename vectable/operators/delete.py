"""Deletes. Each returns the rows that stay and the rows that went; write the former as the next
snapshot. Nothing deletes everything by accident: a missing scope is an error."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from vectable.functions.predicates import Filter, matched
from vectable.operators.fetch import listed_keys
from vectable.sources.tables import BROADCAST_ROWS, small_side
from vectable.table import VectorTable, path_col


class Deleted(NamedTuple):
    kept: DataFrame
    gone: DataFrame

    def count(self) -> int:
        """Number of deleted rows (runs a job)."""
        return self.gone.count()


def delete_by_ids(
    current: DataFrame, ids: DataFrame, table: VectorTable, *, max_broadcast: int = BROADCAST_ROWS
) -> Deleted:
    """Delete the ids of a table of ids (or of key columns). An empty one deletes nothing; unknown ids
    are ignored."""
    keys = listed_keys(ids, table)
    wanted = small_side(keys, max_broadcast)
    return Deleted(
        current.join(wanted, keys.columns, "left_anti").select(*current.columns),
        current.join(wanted, keys.columns, "left_semi").select(*current.columns),
    )


def delete_by_filter(current: DataFrame, condition: Filter, table: VectorTable) -> Deleted:
    """Delete rows that match. Rows where the condition is NULL stay."""
    if condition is None or (isinstance(condition, Mapping) and not condition):
        raise ValueError("a delete needs a non-empty filter; delete_all is its own call")
    hit = matched(current, table, condition)
    return Deleted(current.filter(~hit), current.filter(hit))


def _in_scope(current: DataFrame, table: VectorTable, namespace: str | None, condition: Filter) -> Column:
    hit = F.lit(True)
    if namespace is not None:
        if table.namespace is None:
            raise ValueError("the table has no namespace column")
        hit = F.coalesce(path_col(table.namespace) == F.lit(namespace), F.lit(False))
    if condition is not None:
        hit = hit & matched(current, table, condition)
    return hit


def delete_in_namespace(
    current: DataFrame,
    ids: DataFrame | None,
    table: VectorTable,
    *,
    namespace: str | None = None,
    condition: Filter = None,
    max_broadcast: int = BROADCAST_ROWS,
) -> Deleted:
    """Delete rows that are in the namespace AND match the filter AND have one of the ids."""
    if ids is None:
        raise ValueError("ids are required; delete_all is its own call")
    hit = _in_scope(current, table, namespace, condition)
    wanted = ids.select(F.col(ids.columns[0]).alias("__id")).distinct().withColumn("__listed", F.lit(True))
    flagged = current.join(small_side(wanted, max_broadcast), path_col(table.id) == F.col("__id"), "left")
    gone = F.coalesce(F.col("__listed"), F.lit(False)) & hit
    return Deleted(
        flagged.filter(~gone).select(*current.columns),
        flagged.filter(gone).select(*current.columns),
    )


def delete_all(
    current: DataFrame, table: VectorTable, *, namespace: str | None = None, condition: Filter = None
) -> Deleted:
    """Delete every row of a namespace (or of the table), optionally only the matching ones."""
    hit = _in_scope(current, table, namespace, condition)
    return Deleted(current.filter(~hit), current.filter(hit))


def delete_counts(gone: DataFrame, table: VectorTable) -> DataFrame:
    """Deleted rows per namespace; counted before the shuffle, so a hot namespace is one row per task."""
    if table.namespace is None:
        return gone.agg(F.count(F.lit(1)).alias("deleted"))
    return gone.groupBy(path_col(table.namespace).alias("namespace")).agg(F.count(F.lit(1)).alias("deleted"))
