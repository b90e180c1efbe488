"""Metadata filters: a nested dict, or any Spark column, becomes one boolean column.

Bare keys name metadata fields: ``{"lang": "en", "year": {"$gte": 2024}, "$or": [...]}``. Top-level
entries are AND-ed. A missing field is NULL: the positive operators are false on it, and the
negative ones (``$ne``, ``$nin``, ``$nor``, ``$not``) are the exact complement, so true.

Positive conditions stay bare so that they reach the Parquet scan; ``coalesce`` appears only under
a negation, where pushdown would not apply anyway.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vectable.table import VectorTable, check_name, path_col, path_type

Filter = Mapping[str, Any] | Column | None
FieldOf = Callable[[str, Any], "Field"]


class Field(NamedTuple):
    """A metadata field; ``many`` if it holds a list, which a condition meets when one of its elements does."""

    column: Column
    many: bool = False

    def any(self, test: Callable[[Column], Column]) -> Column:
        return F.exists(self.column, test) if self.many else test(self.column)


def where(df: DataFrame, table: VectorTable, condition: Filter) -> DataFrame:
    """Rows that match ``condition``; None keeps all."""
    return df if condition is None else df.filter(to_column(df, table, condition))


def matched(df: DataFrame, table: VectorTable, condition: Filter) -> Column:
    """The condition as True/False, never NULL: safe to negate."""
    return F.coalesce(to_column(df, table, condition), F.lit(False))


def to_column(df: DataFrame, table: VectorTable, condition: Filter) -> Column:
    if isinstance(condition, Column):
        return condition
    if not isinstance(condition, Mapping):
        raise TypeError("a filter is a dict or a Spark column")
    return _conjunction(condition, lambda key, sample: _field(df, table, key, sample))


def _field(df: DataFrame, table: VectorTable, key: str, sample: Any) -> Field:
    """A metadata field, to be compared with values like ``sample``. A missing field, or one of another
    type (text against a number), is NULL rather than an error; metadata that cannot be read is an error, as
    every negative condition would be true on it. Metadata in a text column is read as JSON."""
    check_name(key, "filter field")
    prefix = table.metadata + "."
    inner = key.removeprefix(prefix)
    kind = _kind(sample)
    root = path_type(df.schema, table.metadata)
    if isinstance(root, T.VariantType):
        return Field(_variant_field(path_col(table.metadata), inner, kind))
    if isinstance(root, T.StringType):
        return Field(_variant_field(F.try_parse_json(path_col(table.metadata)), inner, kind))
    if isinstance(root, T.MapType):
        column, dtype = F.try_element_at(path_col(table.metadata), F.lit(inner)), root.valueType
    elif isinstance(root, T.StructType):
        column, dtype = path_col(prefix + inner), path_type(df.schema, prefix + inner)
    else:
        raise ValueError(f"a filter on {key!r} needs metadata as struct, map, variant or JSON text in column {table.metadata!r}")
    many = isinstance(dtype, T.ArrayType)
    if dtype is None or not _comparable(dtype.elementType if many else dtype, kind):
        return Field(F.lit(None))
    return Field(column, many)


def _kind(sample: Any) -> str | None:
    """text, number or truth; None for anything else."""
    if isinstance(sample, bool):
        return "truth"
    if isinstance(sample, (int, float)):
        return "number"
    return "text" if isinstance(sample, str) else None


def _comparable(dtype: T.DataType, kind: str | None) -> bool:
    for known, name in ((T.StringType, "text"), (T.NumericType, "number"), (T.BooleanType, "truth")):
        if isinstance(dtype, known):
            return kind in (name, None)
    return True


def _variant_field(metadata: Column, inner: str, kind: str | None) -> Column:
    """A field of metadata without a schema. Numbers are compared as double, whatever they are
    stored as; a value of another kind reads as NULL."""
    steps = "".join(map(_step, inner.split(".")))
    if kind is None:
        return F.try_variant_get(metadata, "$" + steps, "string")
    stored = F.schema_of_variant(F.try_variant_get(metadata, "$" + steps, "variant"))
    if kind == "number":
        fits = stored.isin("BIGINT", "DOUBLE", "FLOAT") | stored.startswith("DECIMAL")
    else:
        fits = stored == F.lit("STRING" if kind == "text" else "BOOLEAN")
    read = {"text": "string", "number": "double", "truth": "boolean"}[kind]
    return F.when(fits, F.try_variant_get(metadata, "$" + steps, read))


def _step(name: str) -> str:
    """One step of a variant path, in the form that can hold the name."""
    if "?" not in name and "'" not in name:
        return f"['{name}']"
    if "?" not in name and '"' not in name:
        return f'["{name}"]'
    if "[" in name:
        raise ValueError(f"metadata without a schema cannot be asked for field {name!r}")
    return f".{name}"


def _conjunction(condition: Mapping[str, Any], field: FieldOf) -> Column:
    parts = [_entry(key, value, field) for key, value in condition.items()]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _complement(column: Column) -> Column:
    return ~F.coalesce(column, F.lit(False))


def _entry(key: str, value: Any, field: FieldOf) -> Column:
    if key in ("$and", "$or", "$nor"):
        if not isinstance(value, (list, tuple)) or not value:
            raise ValueError(f"{key} takes a non-empty list of filters")
        branches = [_conjunction(branch, field) for branch in value]
        if key == "$and":
            return reduce(lambda a, b: a & b, branches)
        either = reduce(lambda a, b: a | b, branches)
        return either if key == "$or" else _complement(either)
    if key == "$not":
        return _complement(_conjunction(value, field))
    if isinstance(key, str) and key.startswith("$"):
        raise ValueError(f"unknown filter operator {key!r}")
    if isinstance(value, Mapping) and any(str(op).startswith("$") for op in value):
        parts = [_compare(key, op, operand, field) for op, operand in value.items()]
        return reduce(lambda a, b: a & b, parts)
    if isinstance(value, Mapping):
        if not value:
            raise ValueError(f"empty condition for field {key!r}")
        nested = {f"{key}.{inner}": operand for inner, operand in value.items()}
        return _conjunction(nested, field)
    return _compare(key, "$eq", value, field)


def _listed(found: Field, options: list) -> Column:
    return found.any(lambda x: x.isin(options))


def _compare(key: str, op: str, operand: Any, field: FieldOf) -> Column:
    if op == "$eq" and isinstance(operand, (list, tuple)):
        return field(key, operand[0] if operand else None).column == F.lit(list(operand))
    found = field(key, "" if op == "$contains" else operand)
    if op == "$eq":
        return found.column.isNull() if operand is None else found.any(lambda x: x == F.lit(operand))
    if op == "$ne":
        return _complement(_compare(key, "$eq", operand, field))
    if op == "$in":
        if not isinstance(operand, (list, tuple)):
            raise ValueError("$in and $nin take a list")
        known = [x for x in operand if x is not None]
        groups = [[x for x in known if _kind(x) == kind] for kind in dict.fromkeys(map(_kind, known))]
        parts = [_listed(field(key, group[0]), group) for group in groups]
        listed = reduce(lambda a, b: a | b, parts) if parts else F.lit(False)
        if len(known) == len(operand):
            return listed
        return F.coalesce(listed, F.lit(False)) | field(key, None).column.isNull()
    if op == "$nin":
        return _complement(_compare(key, "$in", operand, field))
    if op == "$not":
        parts = [_compare(key, inner, value, field) for inner, value in operand.items()]
        return _complement(reduce(lambda a, b: a & b, parts))
    if op == "$contains":
        text = str(operand)
        return F.array_contains(found.column, text) if found.many else found.column.contains(text)
    if op == "$gt":
        return found.any(lambda x: x > F.lit(operand))
    if op == "$gte":
        return found.any(lambda x: x >= F.lit(operand))
    if op == "$lt":
        return found.any(lambda x: x < F.lit(operand))
    if op == "$lte":
        return found.any(lambda x: x <= F.lit(operand))
    raise ValueError(f"unknown filter operator {op!r}")
