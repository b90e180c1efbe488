"""What a table of embedded documents looks like.

``VectorTable`` names the columns of an ordinary DataFrame. Names may be dotted paths into structs
(``content.vector``). It holds no data: every operator takes the DataFrame next to it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Names of the three similarity metrics.
COSINE, EUCLIDEAN, INNER_PRODUCT = "COS", "L2", "IP"
METRICS = (COSINE, EUCLIDEAN, INNER_PRODUCT)

_LOWEST = -(2**63)


def check_name(name: str, what: str = "name") -> str:
    """A field name is non-blank, does not start with ``$`` and holds no NUL."""
    if not isinstance(name, str) or not name.strip() or name.startswith("$") or "\0" in name:
        raise ValueError(f"{what} must be a non-empty safe name, got {name!r}")
    return name


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}, got {metric!r}")
    return metric


def check_range(name: str, value: int, low: int, high: int | None = None) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < low or (high is not None and value > high):
        bounds = f"at least {low}" if high is None else f"between {low} and {high}"
        raise ValueError(f"{name} must be an integer {bounds}, got {value!r}")
    return value


def check_vector(vector: Sequence[float], dims: int | None = None) -> list[float]:
    """One query vector: non-empty, all finite, of ``dims`` elements when that is known."""
    values = [float(x) for x in vector]
    if not values:
        raise ValueError("vector must not be empty")
    if dims is not None and len(values) != dims:
        raise ValueError(f"vector must have {dims} elements, got {len(values)}")
    if not all(math.isfinite(x) for x in values):
        raise ValueError("vector elements must be finite")
    return values


def path_col(path: str) -> Column:
    """Column for a dotted path; each step is quoted, so any field name works."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in path.split(".")))


def path_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type found at a dotted path, or None when a step is missing."""
    current: T.DataType = schema
    for part in path.split("."):
        if not isinstance(current, T.StructType) or part not in current.names:
            return None
        current = current[part].dataType
    return current


@dataclass(frozen=True)
class VectorTable:
    """Column names, dimension and metric of a document table.

    ``namespace`` set means the key is (namespace, id). ``internal`` lists storage columns that never
    show up in documents. ``dims`` may stay None where the vectors are known to share one length.
    """

    id: str = "id"
    text: str = "text"
    embedding: str = "embedding"
    metadata: str = "metadata"
    namespace: str | None = None
    dims: int | None = None
    metric: str = COSINE
    internal: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for what in ("id", "text", "embedding", "metadata"):
            check_name(getattr(self, what), what)
        if self.namespace is not None:
            check_name(self.namespace, "namespace")
        if len({self.text, self.embedding, self.metadata}) != 3:
            raise ValueError("text, embedding and metadata must be distinct columns")
        if self.dims is not None:
            check_range("dims", self.dims, 1)
        check_metric(self.metric)

    @property
    def key(self) -> list[str]:
        return [self.id] if self.namespace is None else [self.namespace, self.id]

    def row_key(self) -> Column:
        """The key as one column: the id, or with a namespace a text that ``split_key`` takes apart."""
        if self.namespace is None:
            return path_col(self.id)
        # NUL parts the two, so it is escaped in the namespace; \1 goes first and keeps the order.
        name = F.replace(path_col(self.namespace).cast("string"), F.lit("\1"), F.lit("\1\2"))
        space = F.coalesce(F.concat(F.lit("="), F.replace(name, F.lit("\0"), F.lit("\1\1"))), F.lit(""))
        return F.concat(space, F.lit("\0"), self._id_text())

    def _id_text(self) -> Column:
        """The id as text. Integers become 16 digits that sort as the numbers do, so that ties in a search go
        to the smaller id."""
        found = path_col(self.id)
        digits = F.hex(found.try_cast("bigint").bitwiseXOR(F.lit(_LOWEST)))
        return F.when(F.typeof(found).isin("tinyint", "smallint", "int", "bigint"), F.lpad(digits, 16, "0")).otherwise(found.cast("string"))

    def split_key(self, df: DataFrame, column: str, source: DataFrame, prefix: str = "") -> DataFrame:
        """Replace a ``row_key`` column by ``namespace`` and ``id`` with the types of ``source``."""
        if self.namespace is None:
            return df
        key = F.col(column)
        space, name = F.substring_index(key, "\0", 1), F.substr(key, F.instr(key, "\0") + 1)
        plain = F.replace(F.replace(F.substr(space, F.lit(2)), F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))
        kind = path_type(source.schema, self.id)
        if isinstance(kind, T.IntegralType):
            name = F.conv(name, 16, -10).cast("bigint").bitwiseXOR(F.lit(_LOWEST))
        names = {
            f"{prefix}namespace": F.when(space.startswith("="), plain).cast(path_type(source.schema, self.namespace)),
            column: name.cast(kind),
        }
        at = df.columns.index(column)
        before, after = df.columns[:at], df.columns[at + 1 :]
        return df.select(*before, *[value.alias(name) for name, value in names.items()], *after)

    def vector_path(self, df: DataFrame, vector_col: str | None = None) -> str:
        """The vector column to search; with several vector columns the caller must choose."""
        if vector_col is not None:
            if not is_vector(path_type(df.schema, vector_col)):
                raise ValueError(f"{vector_col!r} is not a vector column")
            return vector_col
        if is_vector(path_type(df.schema, self.embedding)):
            return self.embedding
        found = [f.name for f in df.schema.fields if is_vector(f.dataType)]
        if len(found) != 1:
            raise ValueError(f"name the vector column to search, candidates: {found}")
        return found[0]

    def check(self, df: DataFrame, *, need: Sequence[str] = ("id", "embedding")) -> DataFrame:
        """Raise unless the needed columns exist with usable types; returns ``df`` unchanged."""
        if self.namespace is not None and path_type(df.schema, self.namespace) is None:
            raise ValueError(f"namespace column {self.namespace!r} is missing")
        for what in need:
            path = getattr(self, what)
            found = path_type(df.schema, path)
            if found is None:
                raise ValueError(f"{what} column {path!r} is missing")
            if what == "embedding" and not is_vector(found):
                raise ValueError(f"embedding column {path!r} must be an array of float or double")
            if what == "text" and not isinstance(found, T.StringType):
                raise ValueError(f"text column {path!r} must be a string")
            if what == "metadata" and not isinstance(found, (T.StructType, T.MapType, T.VariantType)):
                raise ValueError(f"metadata column {path!r} must be a struct, map or variant")
            if what == "id" and not isinstance(found, (T.StringType, T.IntegralType)):
                raise ValueError(f"id column {path!r} must be a string or an integer")
        return df


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: structs have the fields of ``a`` in their order, then those only ``b`` has."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        known = {f.name: f.dataType for f in b.fields}
        fields = [T.StructField(f.name, merged_type(f.dataType, known[f.name]) if f.name in known else f.dataType) for f in a.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    return b if isinstance(a, T.NullType) else a


def align(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of type ``have`` as ``want``. Structs are matched by field name at every depth: a field that
    ``have`` lacks becomes NULL, and one that ``want`` lacks is an error."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        unknown = [n for n in have.names if n not in want.names]
        if unknown:
            raise ValueError(f"fields that the target does not have: {unknown}")
        fields = [
            (align(column.getField(f.name), have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: align(x, have.elementType, want.elementType))
    return column.cast(want)


def is_vector(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.FloatType, T.DoubleType))
