"""Reads that are not searches: by id, by filter, as documents, by nested path, by property name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vectable.functions.predicates import Filter, where
from vectable.sources.tables import BROADCAST_ROWS, settle, small_side
from vectable.table import VectorTable, check_name, check_range, is_vector, path_col, path_type

DEEP_PAGE = 100_000


def get_by_ids(
    corpus: DataFrame,
    ids: DataFrame,
    table: VectorTable,
    columns: Sequence[str] | None = None,
    *,
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of the listed ids; unknown ids are absent, repeated ids come back once. ``ids`` is one
    column of ids, or the key columns of the table."""
    wanted = listed_keys(ids, table)
    found = corpus.join(small_side(wanted, max_broadcast), wanted.columns, "left_semi")
    return found.select(*(corpus.columns if columns is None else columns))


def listed_keys(ids: DataFrame, table: VectorTable) -> DataFrame:
    """The columns of ``ids`` to match on: namespace and id when it has both, else its first column."""
    if table.namespace is not None and set(table.key) <= set(ids.columns):
        return ids.select(*table.key)
    return ids.select(F.col(ids.columns[0]).alias(table.id))


def filtered_fetch(
    corpus: DataFrame,
    condition: Filter,
    table: VectorTable,
    top: int,
    *,
    order: Sequence[tuple[str, bool]] = (),
    skip: int = 0,
    include_vectors: bool = False,
    deep: int = DEEP_PAGE,
) -> DataFrame:
    """Matching rows ordered by (column, ascending) pairs, then by key so that pages are stable.

    A page that ends within ``deep`` rows is a top-k: no full sort. For a deeper one the sort columns and keys alone are
    dealt into ranges and counted; only the ranges that the page lies in are sorted, and only the page's rows are
    read whole. Keys are unique.
    """
    check_range("top", top, 1)
    check_range("skip", skip, 0)
    rows = corpus if include_vectors else without_vectors(corpus)
    by = [path_col(c).asc() if ascending else path_col(c).desc() for c, ascending in order]
    by += [path_col(c).asc() for c in table.key if c not in [name for name, _ in order]]
    found = where(rows, table, condition)
    if skip + top <= deep:
        return found.orderBy(*by).offset(skip).limit(top)
    keys = [c for c in table.key]
    names = [*dict.fromkeys([c for c, _ in order] + keys)]
    narrow = found.select(*[path_col(c).alias(f"c{i}") for i, c in enumerate(names)])
    ways = dict(order)
    own = [F.col(f"c{i}").asc() if ways.get(c, True) else F.col(f"c{i}").desc() for i, c in enumerate(names)]
    width = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = settle(narrow.repartitionByRange(width, *own).withColumn("part", F.spark_partition_id()))
    sizes = placed.groupBy("part").count().orderBy("part").collect()  # one row per range
    start, low, high, before = 0, None, None, 0
    for size in sizes:
        if start < skip + top and start + size["count"] > skip:
            low, high, before = (size["part"], size["part"], start) if low is None else (low, size["part"], before)
        start += size["count"]
    if low is None:
        return found.limit(0)
    page = placed.filter(F.col("part").between(low, high)).orderBy(*own).offset(skip - before).limit(top)
    wanted = small_side(settle(page.select(*[F.col(f"c{names.index(c)}").alias(f"__k{i}") for i, c in enumerate(keys)])))
    on = [path_col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)]
    return found.join(wanted, on, "left_semi").orderBy(*by)


def without_vectors(df: DataFrame) -> DataFrame:
    """All columns but the vectors; pruning keeps those out of the scan."""
    return df.select(*[path_col(f.name) for f in df.schema.fields if not is_vector(f.dataType)])


# ---- documents ------------------------------------------------------------------------------------


def to_documents(
    df: DataFrame, table: VectorTable, *, include_vectors: bool = False, strict: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """``id, text, metadata``: the vector and internal columns go, every other column is folded into
    the metadata, where it wins over a field of the same name. Missing metadata counts as empty.

    ``keep`` names columns to leave beside the document (rank, score). With ``strict`` a row without
    text fails the query.
    """
    text = path_col(table.text)
    if strict:
        if not isinstance(path_type(df.schema, table.text), T.StringType):
            raise ValueError(f"no readable text: {table.text!r} holds no strings")
        message = F.concat(F.lit("stored document has no text: "), path_col(table.id).cast("string"))
        text = F.when(text.isNull(), F.raise_error(message)).otherwise(text)
    found = path_type(df.schema, table.metadata)
    rest = df.drop(*[c for c in (*table.internal, *keep, table.id) if c in df.columns])
    for path in (table.text, table.metadata, table.embedding):
        rest = remove_path(rest, path)
    if not include_vectors:
        rest = without_vectors(rest)
    extras = {name: path_col(name) for name in rest.columns}
    out = [path_col(table.id).alias("id"), text.alias("text")]
    if isinstance(found, T.StructType) or found is None:
        fields = {name: path_col(f"{table.metadata}.{name}") for name in (found.names if found else [])}
        metadata = [column.alias(name) for name, column in {**fields, **extras}.items()]
        if metadata:
            out.append(F.struct(*metadata).alias("metadata"))
    elif isinstance(found, (T.MapType, T.VariantType, T.StringType)):
        out.append(_folded(path_col(table.metadata), found, extras, rest.schema).alias("metadata"))
    else:
        raise ValueError("metadata must be an object: a struct, map, variant or JSON text")
    if include_vectors and path_type(df.schema, table.embedding) is not None:
        out.append(path_col(table.embedding).alias("embedding"))
    return df.select(*[path_col(c) for c in keep], *out)


def _folded(metadata: Column, kind: T.DataType, extras: dict[str, Column], schema: T.StructType) -> Column:
    """Metadata without a schema with columns folded into it: JSON text stays text, a variant or map becomes a variant.
    Text that is no JSON object is an error."""
    if not extras and not isinstance(kind, T.StringType):
        return metadata
    if isinstance(kind, T.MapType):
        fields = F.transform_values(F.map_from_entries(F.transform(F.map_entries(metadata), lambda e: F.struct(e["key"].cast("string"), e["value"]))),
                                    lambda _, v: _as_variant(v, kind.valueType))
    elif isinstance(kind, T.VariantType):
        fields = metadata.cast("map<string,variant>")
    else:
        whole = F.trim(metadata)
        parsed = F.from_json(whole, "map<string,variant>")
        bad = F.raise_error(F.concat(F.lit("metadata is no JSON object: "), F.substring(metadata, 1, 100)))
        fields = F.when(parsed.isNotNull() & whole.startswith("{"), parsed).when(metadata.isNotNull(), bad.cast("map<string,variant>"))
    names = list(extras)
    kept = F.coalesce(F.map_filter(fields, lambda k, _: ~k.isin(names)) if names else fields, F.create_map().cast("map<string,variant>"))
    added = [part for name, column in extras.items() for part in (F.lit(name), F.coalesce(_as_variant(column, schema[name].dataType), F.parse_json(F.lit("null"))))]
    merged = F.map_concat(kept, F.create_map(*added)) if added else kept
    return F.to_json(merged) if isinstance(kind, T.StringType) else F.to_variant_object(merged)


def _as_variant(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        return column
    return F.to_variant_object(column) if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)) else column.cast("variant")


# ---- nested field paths ---------------------------------------------------------------------------


def get_path(df: DataFrame, path: str) -> Column:
    """Column at a dotted path; an unknown path is an error."""
    if path_type(df.schema, path) is None:
        raise KeyError(path)
    return path_col(path)


def _with_value(current: Column | None, dtype: T.DataType | None, parts: list[str], value: Column) -> Column:
    if not parts:
        return value
    if dtype is not None and not isinstance(dtype, T.StructType):
        raise ValueError(f"{parts[0]!r} is asked for both whole and in part")
    names = dtype.names if dtype is not None else []
    head, *tail = parts
    fields = [current.getField(name).alias(name) for name in names if name != head]
    inner = current.getField(head) if head in names else None
    fields.append(_with_value(inner, dtype[head].dataType if inner is not None else None, tail, value).alias(head))
    return F.struct(*fields)


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Put a value at a dotted path, making missing parents; a parent that is no struct is an error."""
    head, *tail = path.split(".")
    check_name(head)
    known = head in df.columns
    dtype = df.schema[head].dataType if known else None
    return df.withColumn(head, _with_value(path_col(head) if known else None, dtype, tail, value))


def _without(current: Column, dtype: T.StructType, parts: list[str]) -> Column | None:
    head, *tail = parts
    fields = []
    for field in dtype.fields:
        inner: Column | None = current.getField(field.name)
        if field.name == head:
            nested = tail and isinstance(field.dataType, T.StructType)
            inner = _without(inner, field.dataType, tail) if nested else (inner if tail else None)
        if inner is not None:
            fields.append(inner.alias(field.name))
    return F.when(current.isNotNull(), F.struct(*fields)) if fields else None


def remove_path(df: DataFrame, path: str) -> DataFrame:
    """Drop the field at a dotted path, and parents left with no field. An unknown path is no error."""
    head, *tail = path.split(".")
    if path_type(df.schema, path) is None:
        return df
    if not tail:
        return df.drop(head)
    left = _without(path_col(head), df.schema[head].dataType, tail)
    return df.drop(head) if left is None else df.withColumn(head, left)


# ---- property names -------------------------------------------------------------------------------


def from_storage(df: DataFrame, names: Mapping[str, str], *, include_vectors: bool = False) -> DataFrame:
    """Rename storage columns to properties (``{property: storage column}``).

    Filters and sorts written against the properties pass through the projection to the scan.
    """
    chosen = {
        prop: storage
        for prop, storage in names.items()
        if include_vectors or not is_vector(path_type(df.schema, storage))
    }
    missing = [storage for storage in chosen.values() if path_type(df.schema, storage) is None]
    if missing:
        raise ValueError(f"storage columns are missing: {missing}")
    return df.select(*[path_col(storage).alias(prop) for prop, storage in chosen.items()])


def to_storage(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename properties to storage columns; properties without a storage name are left out."""
    if len(set(names.values())) != len(names):
        raise ValueError("storage names must be distinct")
    return df.select(*[path_col(prop).alias(check_name(storage)) for prop, storage in names.items()])
