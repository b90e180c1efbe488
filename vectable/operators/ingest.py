"""Bulk writes: embed, append, upsert. Each returns the next state of the table as a DataFrame.

Cost model: the stored table is the large side. When the batch is small enough (its rows are
counted), only the batch is moved and the stored table is read in place; otherwise both sides meet
in one shuffle by key, which is unique on both sides and so spreads evenly. A table saved with
``save_bucketed`` is not moved in either case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from vectable.sources.tables import BROADCAST_ROWS, fits_broadcast, settle, small_side
from vectable.table import VectorTable, align, check_range, check_vector, merged_type, path_col

# A model factory runs once per task and returns ``list of texts -> list of vectors``. A factory in an
# installed module may keep its model in a global, which reused Python workers then find loaded.
Embedder = Callable[[Sequence[str]], Sequence[Sequence[float]]]
EmbedderFactory = Callable[[], Embedder]


def embed(text: Column, model: EmbedderFactory) -> Column:
    """Text column to ``array<float>``. A null text gives a null vector; a model that answers with
    the wrong number of vectors fails the job."""

    @F.arrow_udf("array<float>")
    def embedded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = model()
        for texts in batches:
            present = texts.is_valid()
            asked = texts.filter(present).to_pylist()
            vectors = [np.asarray(v, dtype=np.float32) for v in run(asked)] if asked else []
            if len(vectors) != len(asked):
                raise ValueError(f"model gave {len(vectors)} vectors for {len(asked)} texts")
            there = present.to_numpy(zero_copy_only=False)
            sizes = np.zeros(len(texts), dtype=np.int32)
            sizes[there] = [len(v) for v in vectors]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(vectors) if vectors else np.zeros(0, dtype=np.float32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~there))

    # Not deterministic for Spark, which would otherwise run the model again for a filter on the vector.
    return embedded.asNondeterministic()(text)


def embed_corpus(df: DataFrame, table: VectorTable, model: EmbedderFactory) -> DataFrame:
    """Fill the embedding column from the text column."""
    return df.withColumn(table.embedding, embed(path_col(table.text), model))


def embed_query(model: EmbedderFactory, text: str, dims: int | None = None) -> list[float]:
    """One query text to one checked vector."""
    vectors = list(model()([text]))
    if len(vectors) != 1:
        raise ValueError(f"model gave {len(vectors)} vectors for one text")
    return check_vector(vectors[0], dims)


def assign_ids(batch: DataFrame, table: VectorTable, *, given: Sequence[str] = ()) -> DataFrame:
    """Keep a given id, else a new uuid; blank counts as not given.

    ``given`` names columns to try before the id column, first one wins. ``uuid()`` is drawn when
    the plan runs: write the result, or ``settle`` it, before using it twice.
    """
    names = [*given, *([table.id] if table.id in batch.columns else [])]
    texts = [path_col(c).cast("string") for c in names]
    tried = [F.when(F.trim(text) != F.lit(""), text) for text in texts]
    return batch.withColumn(table.id, F.coalesce(*tried, F.uuid()))


def append_documents(current: DataFrame, batch: DataFrame, table: VectorTable) -> DataFrame:
    """Add a batch with ids assigned; nothing is shuffled, columns the batch lacks become NULL."""
    return current.unionByName(assign_ids(batch, table), allowMissingColumns=True)


def latest_per_id(batch: DataFrame, table: VectorTable, order: str | None = "ord") -> DataFrame:
    """One row per key, the one with the highest ``order``.

    Ties, NULL orders (lowest) and ``order=None`` go by a hash of the whole row, so the choice does not
    depend on partitioning. Needed before any upsert, which takes each key once. The rank limit is
    applied before the shuffle, so a key repeated a billion times sends one row per task.
    """
    rest = F.xxhash64(*[_hashable(batch, c) for c in batch.columns])
    first = [] if order is None else [F.col(order).desc_nulls_last()]
    newest = Window.partitionBy(*table.key).orderBy(*first, rest)
    ranked = batch.withColumn("__newest", F.row_number().over(newest))
    return ranked.filter("__newest = 1").drop("__newest")


def _hashable(df: DataFrame, name: str) -> Column:
    column = F.col("`" + name.replace("`", "``") + "`")
    return F.to_json(F.struct(column)) if _unordered(df.schema[name].dataType) else column


def _unordered(dtype: T.DataType) -> bool:
    """Maps and variants, at any depth, have no hash."""
    if isinstance(dtype, T.StructType):
        return any(_unordered(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _unordered(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def once_per_key(batch: DataFrame, table: VectorTable) -> DataFrame:
    """The batch, computed once and written to the checkpoint folder; an error if a key occurs twice.

    Models run and ids are drawn when a plan runs, and an upsert reads its batch several times.
    """
    placed = settle(batch)
    repeated = placed.groupBy(*[path_col(k) for k in table.key]).count().filter("count > 1").head(1)
    if repeated:
        raise ValueError(f"a key occurs twice in the batch, use latest_per_id first: {repeated[0].asDict()}")
    return placed


def drop_known(
    batch: DataFrame,
    known: DataFrame | None = None,
    *,
    on: Column | str = "text",
    duplicate: Column | None = None,
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """Drop rows already stored, before paying for their embeddings.

    ``duplicate`` is a predicate on the batch (NULL keeps the row); ``known`` is a stored table, and
    rows whose ``on`` value has the same MD5 there are dropped. Only 16-byte hashes are compared. When
    those of the batch fit, they go to the stored table, which is then not moved; and each hash
    found is kept once per task, so a text stored a billion times costs one row per task.
    """
    out = batch if duplicate is None else batch.filter(~F.coalesce(duplicate, F.lit(False)))
    if known is None:
        return out
    content = F.col(on) if isinstance(on, str) else on
    digest = F.unhex(F.md5(content)).alias("__hash")
    stored = known.select(digest).filter("__hash IS NOT NULL")
    asked = out.select(digest).filter("__hash IS NOT NULL").distinct()
    small = fits_broadcast(asked, max_broadcast)
    if small:
        stored = stored.join(F.broadcast(asked), "__hash", "left_semi")
    found = stored.distinct()  # no more rows than the batch has, when that is small
    marked = out.withColumn("__hash", digest)
    return marked.join(F.broadcast(found) if small else settle(found), "__hash", "left_anti").drop("__hash")


def upsert_replace(
    current: DataFrame, batch: DataFrame, table: VectorTable, *, max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """Batch rows replace stored rows of the same key whole; other stored rows stay. Struct fields are
    matched by name. The batch is settled, and may have each key once."""
    table.check(current, need=["id"])
    table.check(batch, need=["id"])
    batch = once_per_key(batch, table)
    keys = small_side(batch.select(*table.key), max_broadcast)
    kept = current.join(keys, table.key, "left_anti")
    return kept.select(*current.columns).unionByName(batch, allowMissingColumns=True)


def upsert_merge(
    current: DataFrame,
    batch: DataFrame,
    table: VectorTable,
    columns: Sequence[str] | None = None,
    *,
    keep_text: bool = False,
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """Set ``columns`` (default: text, embedding, metadata as far as the batch has them) on stored
    rows of the same key, keep their other columns, add the new keys. A set column takes the batch
    value even when that is NULL; metadata is replaced whole. With ``keep_text``, a batch row without
    text leaves stored text and metadata alone.

    Struct fields are matched by name: one the batch lacks becomes NULL, one only the batch has is
    added to the table. The batch is settled, and may have each key once.
    """
    table.check(current, need=["id"])
    table.check(batch, need=["id"])
    batch = once_per_key(batch, table)
    if columns is None:
        columns = [c for c in (table.text, table.embedding, table.metadata) if c in batch.columns]
    missing = [c for c in columns if c not in current.columns or c not in batch.columns]
    if missing:
        raise ValueError(f"columns to set are missing from the table or the batch: {missing}")
    for c in columns:
        wide = merged_type(current.schema[c].dataType, batch.schema[c].dataType)
        current = current.withColumn(c, align(F.col(c), current.schema[c].dataType, wide))
        batch = batch.withColumn(c, align(F.col(c), batch.schema[c].dataType, wide))
    bare = F.col(table.text).isNull() if keep_text and table.text in columns else F.lit(False)
    update = batch.select(
        *table.key, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__in_batch"), bare.alias("__bare")
    )

    def merged(c: str) -> Column:
        if c in table.key or c not in columns:
            return F.col(c)
        kept = F.col("__bare") if c in (table.text, table.metadata) else F.lit(False)
        return F.when(F.col("__in_batch") & ~kept, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)

    if fits_broadcast(update, max_broadcast):
        # A full outer join cannot broadcast. Same result in two steps that leave the table in place:
        # update what is stored, then add the batch rows whose key a narrow scan does not find.
        updated = current.join(F.broadcast(update), table.key, "left").select(*[merged(c) for c in current.columns])
        stored = current.select(*table.key).join(F.broadcast(batch.select(*table.key)), table.key, "left_semi")
        fresh = batch.select(*table.key, *columns).join(stored, table.key, "left_anti")
        return updated.unionByName(fresh, allowMissingColumns=True)

    keys = batch.select(*table.key)
    untouched, touched = None, current
    if fits_broadcast(keys, max_broadcast):
        # Wide rows but few keys: only the stored rows the batch touches take part in the shuffle.
        untouched = current.join(F.broadcast(keys), table.key, "left_anti").select(*current.columns)
        touched = current.join(F.broadcast(keys), table.key, "left_semi").select(*current.columns)
    both = touched.join(update, table.key, "full_outer").select(*[merged(c) for c in current.columns])
    return both if untouched is None else untouched.unionByName(both)


def upsert_versioned(
    current: DataFrame, batch: DataFrame, table: VectorTable, version: str, *, mark: str | None = None, max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """Each key keeps the row with its highest ``version`` (NULL is the lowest), stored or from the batch: an older row
    that comes late changes nothing, and batches give the same table in any order and any number of times.

    Rows are replaced whole; columns the batch lacks become NULL. Rows of one key and version go by a hash of the
    row, like those in ``latest_per_id``, and a key may come several times. ``mark`` names a boolean column in which true
    deletes the key as of that version: the mark stays in the table, so that an older row cannot bring the
    key back. ``live`` leaves marked rows out, ``drop_marks`` removes old marks for good.
    """
    table.check(current, need=["id"])
    table.check(batch, need=["id"])
    for name in [version, *([mark] if mark else [])]:
        if name not in current.columns or name not in batch.columns:
            raise ValueError(f"both the table and the batch need the column {name!r}")
    for c in [c for c in current.columns if c in batch.columns]:
        wide = merged_type(current.schema[c].dataType, batch.schema[c].dataType)
        current = current.withColumn(c, align(F.col(c), current.schema[c].dataType, wide))
        batch = batch.withColumn(c, align(F.col(c), batch.schema[c].dataType, wide))
    shaped = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(current.schema[c].dataType).alias(c) for c in current.columns])
    placed = settle(shaped)
    # Winners are found by key, version and a hash of the row; whole rows move only where one of them wins.
    same = F.xxhash64(*[_hashable(current, c) for c in current.columns])
    each = placed.select(*table.key, version, same.alias("__own")).groupBy(*table.key, version, "__own").agg(F.count("*").alias("__copies"))
    order = Window.partitionBy(*table.key).orderBy(F.col(version).desc_nulls_last(), "__own")
    newest = settle(each.withColumn("__newest", F.row_number().over(order)).filter("__newest = 1").drop("__newest"))
    stored = current.select(*table.key, F.col(version).alias("__version"), same.alias("__row"), F.lit(True).alias("__stored"))
    keys = newest.select(*table.key)
    if fits_broadcast(keys, max_broadcast):
        stored = stored.join(F.broadcast(keys), table.key, "left_semi")
    met = newest.join(stored, table.key, "left")
    later = F.col(version).isNotNull() & (F.col("__version").isNull() | (F.col(version) > F.col("__version")))
    even = F.col(version).eqNullSafe(F.col("__version")) & (F.col("__own") < F.col("__row"))
    won = settle(met.filter(F.col("__stored").isNull() | later | even).select(*table.key, "__own", "__copies"))
    repeated = won.filter("__copies > 1").head(1)
    won = small_side(won.drop("__copies"), max_broadcast)
    chosen = won.select(*[F.col(k).alias(f"__won_{k}") for k in table.key], F.col("__own").alias("__won"))
    mine = [F.col(k).eqNullSafe(F.col(f"__won_{k}")) for k in table.key]
    wins = placed.join(chosen, [*mine, same == F.col("__won")], "left_semi")
    wins = latest_per_id(wins, table, version) if repeated else wins
    kept = current.join(won.drop("__own"), table.key, "left_anti")
    return kept.select(*current.columns).unionByName(wins)


def live(df: DataFrame, mark: str) -> DataFrame:
    """The rows that are not deleted, without the mark."""
    return df.filter(~F.coalesce(F.col(mark), F.lit(False))).drop(mark)


def drop_marks(df: DataFrame, mark: str, version: str, before: object) -> DataFrame:
    """Forget deletes older than ``before``; no row older than that may still arrive."""
    return df.filter(~F.coalesce(F.col(mark) & (F.col(version) < F.lit(before)), F.lit(False)))


def upsert_embeddings(
    current: DataFrame, batch: DataFrame, table: VectorTable, *, max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """Refresh vectors only: text and metadata stay; a new id gets NULL text."""
    return upsert_merge(current, batch, table, [table.embedding], max_broadcast=max_broadcast)


def upsert_buckets(
    spark: SparkSession, path: str, batch: DataFrame, table: VectorTable, buckets: int, *, merge: bool = False
) -> DataFrame:
    """Upsert a batch into the Parquet table at ``path``, rewriting only the key buckets it touches.

    The table is laid out by ``bucket_of``; a small batch then costs its buckets, not the table.
    Spark writes the new buckets aside and swaps them in when the job ends, so a failed job changes
    nothing; readers that run during the swap may see some buckets old and some new. Only for upserts:
    a delete can empty a bucket, which this way would leave untouched.
    """
    placed = settle(batch.withColumn("bucket", bucket_of(table, buckets)))
    touched = [row["bucket"] for row in placed.select("bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return spark.read.parquet(path)
    current = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
    new = placed.drop("bucket")
    current = current.drop("bucket")
    after = upsert_merge(current, new, table, keep_text=True) if merge else upsert_replace(current, new, table)
    after = after.withColumn("bucket", bucket_of(table, buckets))
    writer = after.hint("rebalance", F.col("bucket")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return spark.read.parquet(path)


def bucket_of(table: VectorTable, buckets: int) -> Column:
    """Bucket number of a row: even whatever the ids look like, since keys are unique."""
    return F.pmod(F.xxhash64(*[path_col(c) for c in table.key]), F.lit(check_range("buckets", buckets, 1))).cast("int")
