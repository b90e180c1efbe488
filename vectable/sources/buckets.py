"""A table in key buckets whose changes appear all at once.

Rows lie in folders by ``bucket_of``. A change writes the buckets it touches beside the current ones, as a new
generation, and then publishes a new version: one small file that names the generation of every bucket. Readers follow the
newest version file, so they see a change whole or not at all; a job that dies before it publishes has
changed nothing. A bucket that a change empties is in no generation any more.

Two writers that started from one version cannot both publish the next: the second one fails and may try again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vectable.functions.predicates import Filter
from vectable.operators import delete
from vectable.operators.fetch import listed_keys
from vectable.operators.ingest import bucket_of, upsert_merge, upsert_replace, upsert_versioned
from vectable.sources.tables import settle
from vectable.table import VectorTable, check_range


class Conflict(RuntimeError):
    """Another writer published first."""


class BucketTable:
    """The table at ``path``. ``data/<generation>/bucket=<n>`` holds rows, ``versions/<number>.json`` what is current."""

    def __init__(self, spark: SparkSession, path: str, table: VectorTable) -> None:
        self.spark, self.path, self.table = spark, path.rstrip("/"), table
        self._files = spark._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    @classmethod
    def create(cls, df: DataFrame, path: str, table: VectorTable, buckets: int) -> BucketTable:
        """Write ``df`` as the first version; an error if there is a table already."""
        made = cls(df.sparkSession, path, table)
        if made.version() >= 0:
            raise ValueError(f"there is a table at {path}")
        found = made._write(df, check_range("buckets", buckets, 1))
        made._publish(-1, {"buckets": buckets, "schema": df.schema.jsonValue(), "key": table.key, "generations": found})
        return made

    # ---- reading ------------------------------------------------------------------------------------

    def version(self) -> int:
        """Number of the newest version, -1 where there is no table."""
        return max((int(name.removesuffix(".json")) for name in self._names(f"{self.path}/versions") if name.endswith(".json") and not name.startswith(".")), default=-1)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an older one that is still kept."""
        number = self.version() if version is None else version
        return self._rows(self._state(number))

    def _state(self, number: int) -> dict:
        if number < 0:
            raise ValueError(f"no table at {self.path}")
        return json.loads(self._text(f"{self.path}/versions/{number:012d}.json"))

    def _rows(self, state: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        chosen = state["generations"].items() if buckets is None else [(b, state["generations"][b]) for b in buckets if b in state["generations"]]
        folders = [f"{self.path}/data/{generation}/bucket={bucket}" for bucket, generation in chosen]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # ---- changes ------------------------------------------------------------------------------------

    def upsert(self, batch: DataFrame, *, merge: bool = False) -> int:
        """Upsert by replacing (or merging) rows; returns the new version."""
        placed = settle(batch)
        after = (lambda rows: upsert_merge(rows, placed, self.table, keep_text=True)) if merge else (lambda rows: upsert_replace(rows, placed, self.table))
        return self._change(self._touched(placed), after)

    def upsert_versioned(self, batch: DataFrame, version: str, *, mark: str | None = None) -> int:
        """Newest wins, whatever order batches come in; see ``ingest.upsert_versioned``."""
        placed = settle(batch)
        return self._change(self._touched(placed), lambda rows: upsert_versioned(rows, placed, self.table, version, mark=mark))

    def delete_by_ids(self, ids: DataFrame) -> int:
        """Delete listed ids (or keys); returns how many rows went."""
        keys = settle(listed_keys(ids, self.table))
        touched = self._touched(keys) if set(self.table.key) <= set(keys.columns) else None  # an id alone may be in any bucket
        return self._delete(lambda rows: delete.delete_by_ids(rows, keys, self.table), touched)

    def delete_by_filter(self, condition: Filter) -> int:
        return self._delete(lambda rows: delete.delete_by_filter(rows, condition, self.table))

    def delete_in_namespace(self, ids: DataFrame | None, *, namespace: str | None = None, condition: Filter = None) -> int:
        return self._delete(lambda rows: delete.delete_in_namespace(rows, ids, self.table, namespace=namespace, condition=condition))

    def delete_all(self, *, namespace: str | None = None, condition: Filter = None) -> int:
        return self._delete(lambda rows: delete.delete_all(rows, self.table, namespace=namespace, condition=condition))

    def _delete(self, split: Callable[[DataFrame], delete.Deleted], touched: list[str] | None = None) -> int:
        """A narrow pass finds the buckets with rows to delete; only those are written again."""
        number = self.version()
        state = self._state(number)
        gone = split(self._rows(state, touched)).gone
        counts = gone.groupBy(self._bucket(state).alias("bucket")).count().collect()  # at most one row per bucket
        if counts:
            self._change([str(r["bucket"]) for r in counts], lambda rows: split(rows).kept, number)
        return sum(r["count"] for r in counts)

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` versions and the rows that only they name, and what failed jobs left. Run it
        when no job writes, and no reader uses an older version."""
        check_range("keep", keep, 1)
        last = self.version()
        first = max(0, last - keep + 1)
        kept = {g for n in range(first, last + 1) if self._exists(f"{self.path}/versions/{n:012d}.json") for g in self._state(n)["generations"].values()}
        for name in self._names(f"{self.path}/versions"):
            if name.startswith(".") or int(name.removesuffix(".json")) < first:
                self._remove(f"{self.path}/versions/{name}")
        live = self._state(last)["generations"]
        for generation in self._names(f"{self.path}/data"):
            if generation not in kept:
                self._remove(f"{self.path}/data/{generation}")
            elif keep == 1:
                for folder in self._names(f"{self.path}/data/{generation}"):
                    if folder.startswith("bucket=") and live.get(folder.removeprefix("bucket=")) != generation:
                        self._remove(f"{self.path}/data/{generation}/{folder}")

    def _bucket(self, state: dict) -> Column:
        if state["key"] != self.table.key:
            raise ValueError(f"the table at {self.path} has the key {state['key']}")
        return bucket_of(self.table, state["buckets"])

    def _touched(self, rows: DataFrame) -> list[str]:
        state = self._state(self.version())
        return [str(r["bucket"]) for r in rows.select(self._bucket(state).alias("bucket")).distinct().collect()]

    def _change(self, touched: list[str], after: Callable[[DataFrame], DataFrame], number: int | None = None) -> int:
        number = self.version() if number is None else number
        if not touched:
            return number
        state = self._state(number)
        self._bucket(state)
        out = after(self._rows(state, touched))
        found = self._write(out, state["buckets"])
        left = {b: g for b, g in state["generations"].items() if b not in touched}
        return self._publish(number, state | {"schema": out.schema.jsonValue(), "generations": left | found})

    # ---- files --------------------------------------------------------------------------------------

    def _write(self, df: DataFrame, buckets: int) -> dict[str, str]:
        """Rows as a new generation; the buckets that have any."""
        generation = uuid.uuid4().hex
        folder = f"{self.path}/data/{generation}"
        placed = df.withColumn("bucket", bucket_of(self.table, buckets))
        placed.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(folder)
        return {name.removeprefix("bucket="): generation for name in self._names(folder) if name.startswith("bucket=")}

    def _publish(self, before: int, state: dict) -> int:
        """Put the next version file in place in one step, which fails if there is one."""
        number = before + 1
        aside, place = (self._files.Path(f"{self.path}/versions/{n}") for n in (f".{uuid.uuid4().hex}", f"{number:012d}.json"))
        system = aside.getFileSystem(self._conf)
        out = system.create(aside, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        context = self._files.FileContext.getFileContext(aside.toUri(), self._conf) if aside.toUri().getScheme() else self._files.FileContext.getFileContext(self._conf)
        never = self.spark.sparkContext._gateway.new_array(getattr(self._files, "Options$Rename"), 0)
        try:
            context.rename(system.makeQualified(aside), system.makeQualified(place), never)
        except Exception as error:
            system.delete(aside, False)
            if "FileAlreadyExists" in str(error) or "already exist" in str(error):
                raise Conflict(f"version {number} of {self.path} was published by another writer") from None
            raise
        return number

    def _system(self, path: str):
        at = self._files.Path(path)
        return at, at.getFileSystem(self._conf)

    def _exists(self, path: str) -> bool:
        at, system = self._system(path)
        return system.exists(at)

    def _names(self, path: str) -> list[str]:
        at, system = self._system(path)
        return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []

    def _remove(self, path: str) -> None:
        at, system = self._system(path)
        system.delete(at, True)

    def _text(self, path: str) -> str:
        at, system = self._system(path)
        stream = system.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
