"""Substring deduplication by super-k-mers.

A window is ``WINDOW`` consecutive words. Its minimiser is the first of its ``GRAM``-word runs with the
smallest hash; equal windows have equal minimisers. Consecutive windows of a text with one minimiser
travel as one packed string, which repeats only WINDOW - 1 words, to the bucket of the minimiser. There
the windows of each minimiser are sorted and compared word for word, so hashes only decide where windows meet.

A task sends a packed string once however often it has met it: the copies in its larger documents are
known to be covered at once. A passage in a third of all texts thus reaches its bucket once per chunk of
``CHUNK`` bytes, like partial sums of an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from vectable.llm.common import as_bytes, long_list, values

WINDOW = 13
GRAM = 3
CHUNK = 9 << 20
BUCKETS_PER_PARTITION = 4

ROWS = "bucket int, key bigint, twin int, spans array<int>, packed binary"
COVER = "key bigint, twin int, spans array<int>"


def minimisers(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the word hashes: place and hash of its minimiser."""
    mixed = np.zeros(len(hashes) - gram + 1, np.uint64)
    for i in range(gram):
        mixed = (mixed ^ hashes[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    views = np.lib.stride_tricks.sliding_window_view(mixed, window - gram + 1)
    place = np.arange(len(views)) + views.argmin(axis=1)
    return place, mixed[place]


class Chunk:
    """Some texts on their way to the buckets."""

    def __init__(self, buckets: int, window: int, gram: int):
        self.buckets, self.window, self.gram = buckets, window, gram
        self.docs: list[tuple[int, int, list[bytes]]] = []
        self.size = 0

    def add(self, key: int, twin: int, text: bytes) -> None:
        words = text.split()
        self.size += len(text)
        if len(words) >= self.window:
            self.docs.append((key, twin, words))

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        # Smallest keys first: whoever has a packed string first is the one to ask for.
        docs = sorted(self.docs, key=lambda d: d[0])
        words = [w for d in docs for w in d[2]]
        counts = np.array([len(d[2]) for d in docs])
        owner = np.repeat(np.arange(len(docs)), counts)
        firsts = np.cumsum(counts) - counts
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        joined = b" ".join(words)
        hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
        del words
        place, low = minimisers(hashes, self.window, self.gram)
        inside = owner[: len(place)] == owner[self.window - 1 :]
        new = inside.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
        start = np.flatnonzero(new)
        # A run ends before the next run, or where windows would leave the text.
        last = np.minimum(np.append(start[1:], len(place)), (firsts + counts)[owner[start]] - self.window + 1) - 1 + self.window - 1
        left = np.where(start > 0, ends[start - 1] + 1, 0)
        seen: dict[bytes, int] = {}
        strings, sent, covered = [], [], []
        owners = owner[start]
        for at, (i, j, doc) in enumerate(zip(left.tolist(), ends[last].tolist(), owners.tolist())):
            string, key = joined[i:j], docs[doc][0]
            if seen.setdefault(string, key) == key:
                strings.append(string)
                sent.append(at)
            else:
                covered.append(at)
        local = start - firsts[owners]
        yield from self._covered(docs, owners[covered], local[covered], (last - start + 1)[covered])
        sent = np.array(sent)
        yield from self._packed(docs, owners[sent], local[sent], low[start[sent]], strings)

    def _covered(self, docs: list, owners: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(owners):
            return
        cuts = np.append(np.flatnonzero(np.append(True, owners[1:] != owners[:-1])), len(owners))
        held = [docs[o] for o in owners[cuts[:-1]]]
        spans = [np.stack([starts[a:b], starts[a:b] + sizes[a:b]], axis=1).ravel() for a, b in pairwise(cuts)]
        n = len(held)
        yield pa.RecordBatch.from_arrays([
            pa.array([d[0] % self.buckets for d in held], pa.int32()), pa.array([d[0] for d in held], pa.int64()),
            pa.array([d[1] for d in held], pa.int32()), long_list(spans, pa.int32()), pa.nulls(n, pa.binary()),
        ], ["bucket", "key", "twin", "spans", "packed"])

    def _packed(self, docs: list, owners: np.ndarray, starts: np.ndarray, low: np.ndarray, strings: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys = np.array([d[0] for d in docs], np.int64)[owners]
        twins = np.array([d[1] for d in docs], np.int32)[owners]
        bucket = (low >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)), len(order))
        packer = zstandard.ZstdCompressor(level=6)
        packed = [
            packer.compress(pack(low[o].astype(np.uint32), keys[o], twins[o], starts[o].astype(np.int32), [strings[i] for i in o.tolist()]))
            for o in (order[a:b] for a, b in pairwise(cuts))
        ]
        n = len(packed)
        yield pa.RecordBatch.from_arrays([
            pa.array(bucket[order[cuts[:-1]]].astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
            pa.nulls(n, pa.list_(pa.int32())), pa.array(packed, pa.binary()),
        ], ["bucket", "key", "twin", "spans", "packed"])


def pack(low: np.ndarray, keys: np.ndarray, twins: np.ndarray, starts: np.ndarray, strings: list[bytes]) -> bytes:
    """Columns of one bucket as bytes; words hold no line feed, so it parts the strings."""
    steps = np.diff(keys, prepend=0)
    return b"".join([np.int64(len(low)).tobytes(), low.tobytes(), steps.tobytes(), twins.tobytes(), starts.tobytes(), b"\n".join(strings)])


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in (np.uint32, np.int64, np.int32, np.int32):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out[0], np.cumsum(out[1]), out[2], out[3], data[at:].split(b"\n")


def covered_windows(keys: list[int], strings: list[bytes], window: int = WINDOW) -> list[list[int]]:
    """For each packed string of one minimiser: which of its windows also start under a smaller key."""
    smallest: dict[bytes, int] = {}
    for key, string in zip(keys, strings):
        smallest[string] = min(key, smallest.get(string, key))
    words = {string: string.split(b" ") for string in smallest}
    if len(smallest) > 1:
        entries = [
            (b" ".join(parts[i : i + window]), smallest[string], string, i)
            for string, parts in words.items() for i in range(len(parts) - window + 1)
        ]
        entries.sort()
    found: dict[bytes, list[int]] = {string: [] for string in smallest}
    if len(smallest) > 1:
        for _, same in groupby(entries, key=lambda e: e[0]):
            first = next(same)[1]
            for _, key, string, i in same:
                if key > first:
                    found[string].append(i)
    whole = {string: list(range(len(parts) - window + 1)) for string, parts in words.items()}
    return [whole[s] if key > smallest[s] else found[s] for key, s in zip(keys, strings)]


def _bucket_rows(packed: list[bytes], window: int) -> Iterator[pa.RecordBatch]:
    """Covered spans that one bucket finds."""
    unpacker = zstandard.ZstdDecompressor()
    columns = list(zip(*(unpack(unpacker.decompress(p)) for p in packed)))
    low, keys, twins, starts = (np.concatenate(c) for c in columns[:4])
    strings = [s for part in columns[4] for s in part]
    order = np.argsort(low, kind="stable")
    cuts = np.append(np.flatnonzero(np.append(True, np.diff(low[order].astype(np.int64)) != 0)), len(order))
    spans: dict[tuple[int, int], list[int]] = {}
    for a, b in pairwise(cuts.tolist()):
        if b - a < 2:
            continue
        rows = order[a:b].tolist()
        own = keys[rows].tolist()
        if min(own) == max(own):
            continue
        for row, key, windows in zip(rows, own, covered_windows(own, [strings[r] for r in rows], window)):
            if windows:
                first, out = int(starts[row]), spans.setdefault((key, int(twins[row])), [])
                cut = [0, *(n for n, (x, y) in enumerate(pairwise(windows), 1) if y != x + 1), len(windows)]
                for c, d in pairwise(cut):
                    out += [first + windows[c], first + windows[d - 1] + window]
    if spans:
        yield pa.RecordBatch.from_arrays([
            pa.array([k for k, _ in spans], pa.int64()), pa.array([t for _, t in spans], pa.int32()),
            long_list(list(spans.values()), pa.int32()),
        ], ["key", "twin", "spans"])


def covered_spans(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, buckets: int | None = None) -> DataFrame:
    """key, twin, spans: word spans of ``docs`` (key bigint, twin int, text binary) covered by windows that
    also start under a smaller key. spans is flat: start, end, start, end. Spans may overlap."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or parts * BUCKETS_PER_PARTITION

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(buckets, window, gram)
        for batch in batches:
            for key, twin, text in zip(values(batch.column(0)), values(batch.column(1)), values(batch.column(2))):
                chunk.add(key, twin, text)
                if chunk.size >= CHUNK:
                    yield from chunk.rows()
                    chunk = Chunk(buckets, window, gram)
        yield from chunk.rows()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        at = None
        for batch in batches:
            known = batch.filter(batch.column(4).is_null())
            if len(known):
                yield known.select(["key", "twin", "spans"])
            for row in range(len(batch)):
                if not batch.column(4)[row].is_valid:
                    continue
                if batch.column(0)[row].as_py() != at:
                    if len(held) > 0:
                        yield from _bucket_rows(held, window)
                    held, at = [], batch.column(0)[row].as_py()
                held.append(batch.column(4)[row].as_py())
        if held:
            yield from _bucket_rows(held, window)

    dealt = docs.mapInArrow(deal, ROWS).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(meet, COVER)


def cut_words(words: list[bytes], spans: list[int] | None) -> tuple[list[bytes], int]:
    """The words outside all spans, and how many are inside."""
    if not spans:
        return words, 0
    edge = np.zeros(len(words) + 1, np.int64)
    flat = np.array(spans)
    np.add.at(edge, flat[::2], 1)
    np.add.at(edge, flat[1::2], -1)
    inside = np.cumsum(edge[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~inside).tolist()], int(inside.sum())


CUT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType()),
])
CUT_ARROW = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


@F.arrow_udf(CUT)
def cut_text(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, covers in batches:
        rows = []
        for text, spans in zip(values(texts), values(covers)):
            words = text.split()
            kept, removed = cut_words(words, spans)
            rows.append((len(words), removed, b" ".join(kept)))
        yield pa.array([dict(zip(CUT.names, r)) for r in rows], CUT_ARROW)


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_removed, kept (the other words, joined by one space).

    A word goes when a window over it also starts under a smaller key; all windows are judged on the
    input. One row per input row. Rows with one key never remove words of each other, nor do a text's
    own repeats; a NULL key is neither smaller nor larger than any, so its text stays whole. A NULL or
    empty text has no words. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), as_bytes(text).alias("text"))
    rows = rows.withColumn("twin", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    spans = covered_spans(rows.filter("key IS NOT NULL").select("key", "twin", "text"), window=window)
    cover = spans.groupBy(F.col("key").alias("k"), F.col("twin").alias("t")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    joined = rows.join(cover, (F.col("key") == F.col("k")) & (F.col("twin") == F.col("t")), "left")
    out = joined.select(F.col("key").alias(key), cut_text("text", "spans").alias("__c")).select(key, "__c.*")
    return out.withColumn("kept", F.decode("kept", "UTF-8"))
