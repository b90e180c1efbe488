"""Reading and writing document tables, and the size checks behind every broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vectable.table import VectorTable, path_col

# Above either bound a small side is no longer broadcast; Spark then shuffles both sides.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


def corpus_scan(
    spark: SparkSession,
    source: str,
    columns: Sequence[str | Column] | None = None,
    *,
    schema: T.StructType | str | None = None,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Document table from files (any Spark source) or, with ``format="table"``, from the catalog.

    Give ``schema`` to skip schema inference over many files; ``columns`` prunes the scan.
    """
    if format == "table":
        df = spark.table(source)
    else:
        reader = spark.read.format(format).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(source)
    return df if columns is None else df.select(*columns)


def save_snapshot(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    format: str = "parquet",
) -> DataFrame:
    """Write a table to a new directory and return it re-read.

    Updates never overwrite what they read: write the next snapshot beside the current one, then
    switch. With ``partition_by``, a rebalance lets AQE split a value that holds far more rows than
    the others and merge the small ones, so no task writes a whole hot namespace and no directory
    gets a file per task.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode(mode).format(format)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    # Partition values come back typed as written, also where they look like numbers.
    return df.sparkSession.read.schema(df.schema).format(format).load(path)


def save_bucketed(
    df: DataFrame, name: str, table: VectorTable, buckets: int, *, mode: str = "errorifexists"
) -> DataFrame:
    """Save as a catalog table bucketed and sorted by key.

    Upserts and deletes against it shuffle the batch only: the bucketed side keeps its layout.
    """
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *table.key)
    writer.sortBy(*table.key).saveAsTable(name)
    return df.sparkSession.table(name)


def row_bytes(column: Column, dtype: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(dtype, T.StructType):
        size = F.lit(0)
        for field in dtype.fields:
            size = size + row_bytes(column.getField(field.name), field.dataType)
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.NumericType, T.BooleanType)):
        size = F.size(column) * 8
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.VariantType)):
        size = F.length(F.to_json(F.struct(column.alias("v"))))
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0)) + 8


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` is measured to stay within both bounds. Rows are counted first, which reads no
    wide column; only a frame that passes is weighed."""
    rows = df.count()
    if not 0 < rows <= max_rows:
        return rows == 0
    size = F.lit(0)
    for field in df.schema.fields:
        size = size + row_bytes(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.sum(size.cast("bigint"))).first()[0] <= max_bytes


def either_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The deduplicated small side of a join whose other side may have a hot key.

    Broadcast when it fits. Else it is settled, so that the join reads both sides straight from a
    shuffle: only then can AQE split the hot key.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else settle(df)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast when its measured size allows it, else as it is."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; only a local session may make one up."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: later uses read the same rows from the checkpoint folder.

    Written as a Parquet table, so that each later use reads only its columns and Spark knows the
    size. The folder is the caller's to clear when the job is done.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_settled(df: DataFrame) -> None:
    """Delete what ``settle`` wrote for ``df`` itself, once nothing reads it any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if folder.rsplit("/", 1)[-1].startswith("settled-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_settled(spark: SparkSession) -> None:
    """Delete what ``settle`` wrote to the checkpoint folder; call it when no result is read any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "settled-*")) or []:
        files.delete(status.getPath(), True)


def semi_filter(df: DataFrame, field: str, values: DataFrame, *, max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose ``field`` occurs in the one column of ``values``: ``$in`` for a list too big to
    write out."""
    name = values.columns[0]
    listed = values.select(F.col(name).alias("__wanted")).distinct()
    return df.join(either_side(listed, max_broadcast), path_col(field) == F.col("__wanted"), "left_semi")
