"""Documents that arrive as a stream: the same upsert, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from vectable.operators.ingest import EmbedderFactory, assign_ids, embed_corpus, latest_per_id, upsert_buckets
from vectable.operators.validate import validate_rows, validate_vectors
from vectable.sources.buckets import BucketTable
from vectable.sources.tables import settle
from vectable.table import VectorTable


def upsert_stream(
    stream: DataFrame,
    path: str,
    table: VectorTable,
    buckets: int,
    checkpoint: str,
    rejects: str,
    *,
    model: EmbedderFactory | None = None,
    order: str | None = None,
    merge: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert a stream into the bucketed table at ``path``. Unusable rows go to the Parquet table at
    ``rejects``: key, reason, and the epoch, whose folder a replay writes again.

    A replayed micro-batch upserts the same keys again and so changes nothing, provided the rows
    bring their ids. ``order`` keeps the newest row of a key within a micro-batch.
    """

    def put(batch: DataFrame, epoch: int) -> None:
        ready = assign_ids(batch, table)
        if model is not None:
            ready = embed_corpus(ready, table, model)
        rows = validate_rows(settle(ready), table)
        vectors = validate_vectors(rows.valid, table)
        refused = rows.rejects.unionByName(vectors.rejects)
        refused.write.mode("overwrite").parquet(f"{rejects}/epoch={epoch}")
        ready = latest_per_id(vectors.valid, table, order).drop(*([] if order is None else [order]))
        upsert_buckets(batch.sparkSession, path, ready, table, buckets, merge=merge)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def upsert_versioned_stream(
    stream: DataFrame,
    path: str,
    table: VectorTable,
    checkpoint: str,
    rejects: str,
    *,
    version: str,
    mark: str | None = None,
    model: EmbedderFactory | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert a stream into the ``BucketTable`` at ``path``, newest version of a key first whatever order rows arrive in,
    within a micro-batch or across them. Rows marked as deleted need a key and a version only.

    Each micro-batch appears to readers whole, and a replayed one changes nothing, so the stream has the result of one
    upsert of all rows. Rows need ids of their own. Unusable rows go to ``rejects`` as in ``upsert_stream``; a reject
    does not hide an older row.
    """

    def put(batch: DataFrame, epoch: int) -> None:
        gone = F.coalesce(F.col(mark), F.lit(False)) if mark else F.lit(False)
        ready = batch.filter(~gone)
        if model is not None:
            ready = embed_corpus(ready, table, model)
        rows = validate_rows(settle(ready), table)
        vectors = validate_vectors(rows.valid, table)
        refused = rows.rejects.unionByName(vectors.rejects)
        refused.write.mode("overwrite").parquet(f"{rejects}/epoch={epoch}")
        good = vectors.valid
        if mark:
            named = F.trim(F.col(table.id).cast("string")) != F.lit("")
            good = good.unionByName(batch.filter(gone & named), allowMissingColumns=True)
        BucketTable(batch.sparkSession, path, table).upsert_versioned(good, version, mark=mark)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
