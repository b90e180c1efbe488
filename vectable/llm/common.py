"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

# Words are runs of anything but space and \t \n \v \f \r, which is what bytes.split() takes as white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
ROWS_AT_ONCE = 256


def as_bytes(text: str) -> Column:
    """The text column as UTF-8 bytes; NULL is empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def as_text(text: str) -> Column:
    """The text column; NULL is empty."""
    return F.coalesce(F.col(text), F.lit(""))


def fold_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def values(column: pa.Array) -> Iterator:
    """Python values of an Arrow array, few at a time so that long texts are not all held twice."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(at, ROWS_AT_ONCE).to_pylist()


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs before a big one begins: its cleaner acts on what the driver's
    garbage collection finds, which may not run for half an hour (``spark.cleaner.periodicGC.interval``)."""
    spark.sparkContext._jvm.java.lang.System.gc()


def long_list(rows: list, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column from a list of NumPy arrays or Python lists."""
    import numpy as np

    ends = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = np.concatenate([np.asarray(r, kind.to_pandas_dtype()) for r in rows]) if rows else np.empty(0)
    if ends[-1] >= 2**31:
        raise ValueError("lower spark.sql.execution.arrow.maxRecordsPerBatch: a batch has over 2^31 list entries")
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, kind))
