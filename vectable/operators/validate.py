"""Checks before any write: usable rows and rejects as two tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vectable.functions.vectors import is_valid
from vectable.table import VectorTable, path_col, path_type


class Checked(NamedTuple):
    valid: DataFrame
    rejects: DataFrame  # the key columns and ``reason``


class InvalidRows(ValueError):
    """Raised in strict mode when a batch holds unusable rows."""


def vector_problem(v: Column, dims: int | None) -> Column:
    """Why a vector is unusable, or NULL."""
    wrong_size = F.size(v) != F.lit(dims) if dims is not None else F.size(v) == F.lit(0)
    return (
        F.when(v.isNull(), F.lit("missing vector"))
        .when(wrong_size, F.lit("wrong dimensions"))
        .when(~is_valid(v, dims), F.lit("not finite"))
    )


def row_problem(df: DataFrame, table: VectorTable) -> Column:
    """Why a row cannot be stored, or NULL: blank key (or no namespace), neither text nor vector, text or
    metadata of another kind. Missing metadata is empty metadata, and a row may bring a vector only."""
    key = path_col(table.id)
    blank = key.isNull()
    if isinstance(path_type(df.schema, table.id), T.StringType):
        blank = blank | (F.trim(key) == F.lit(""))
    if table.namespace is not None:
        blank = blank | path_col(table.namespace).isNull()
    text, vector = path_type(df.schema, table.text), path_type(df.schema, table.embedding)
    text_bad = F.lit(text is not None and not isinstance(text, T.StringType))
    empty = F.lit(True) if text is None else path_col(table.text).isNull()
    if vector is not None:
        empty = empty & path_col(table.embedding).isNull()
    found = path_type(df.schema, table.metadata)
    if isinstance(found, (T.VariantType, T.StringType)):
        value = path_col(table.metadata)
        parsed = value if isinstance(found, T.VariantType) else F.try_parse_json(value)
        meta_bad = value.isNotNull() & ~F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    else:
        meta_bad = F.lit(found is not None and not isinstance(found, (T.StructType, T.MapType, T.NullType)))
    return (
        F.when(blank, F.lit("blank key"))
        .when(text_bad, F.lit("text is not a string"))
        .when(empty, F.lit("neither text nor vector"))
        .when(meta_bad, F.lit("metadata is not an object"))
    )


def _split(df: DataFrame, table: VectorTable, problem: Column, mode: str, key: list[str]) -> Checked:
    if mode not in ("split", "strict"):
        raise ValueError("mode is 'split' or 'strict'")
    rejects = df.select(*[path_col(k) for k in key], problem.alias("reason")).filter("reason IS NOT NULL")
    if mode == "strict":
        first = rejects.head(1)
        if first:
            raise InvalidRows(f"unusable row, for example {first[0].asDict()}")
    return Checked(df.filter(problem.isNull()), rejects)


def validate_vectors(
    df: DataFrame, table: VectorTable, *, vector_col: str | None = None, mode: str = "split"
) -> Checked:
    """Exact dimension, all elements finite and present. ``mode="strict"`` raises on any reject."""
    v = path_col(vector_col or table.embedding)
    return _split(df, table, vector_problem(v, table.dims), mode, table.key)


def validate_rows(df: DataFrame, table: VectorTable, *, mode: str = "split") -> Checked:
    """Non-blank key, string text or a vector, object metadata or none."""
    return _split(df, table, row_problem(df, table), mode, table.key)
