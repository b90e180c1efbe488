"""Near duplicates by SimHash fingerprints, searched in a hierarchical index in Gray order.

Fingerprints of one group are sorted by their rank in the Gray sequence, so that neighbours differ in
few bits. Runs of neighbours make a node, runs of nodes a node above; a node keeps the bits in which
all its fingerprints agree and that no node above keeps already. Going down, a query adds up its
differences to these bits and drops a whole node as soon as they exceed the distance.

Two fingerprints within two bits agree in at least two of four blocks of 16 bits. Six tables, one for
each two blocks, deal out the fingerprints by these 32 bits; a group over ``GROUP`` is dealt again by thirds
of its other 32 bits, one of which agrees too. What is left of a fingerprint then has 22 bits at most, which
bounds a group. Groups give trees of links, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vectable.llm.common import as_bytes, values
from vectable.llm.graph import connected
from vectable.sources.tables import settle

SHINGLE = 3
SEED = 42
DISTANCE = 2
GROUP = 50_000
FANOUT = 8
SHINGLES_AT_ONCE = 1 << 16


def simhash(text: bytes) -> int:
    """64-bit fingerprint; bit i is set when over half of the shingle hashes have it set."""
    words = text.lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(SHINGLE))) if len(words) >= SHINGLE else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array(np.array([simhash(text) for text in values(batch)], np.uint64).view(np.int64))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over distinct 64-bit codes."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.fanout = fanout
        common, either = [self.codes], [self.codes]
        while len(common[-1]) > 1:
            starts = np.arange(0, len(common[-1]), fanout)
            common.append(np.bitwise_and.reduceat(common[-1], starts))
            either.append(np.bitwise_or.reduceat(either[-1], starts))
        shared = [~(c ^ e) for c, e in zip(common, either)]
        # From the root down: the bits that a node has of its own, and which bits these are.
        self.levels = []
        for depth in range(len(common) - 1, -1, -1):
            own = shared[depth]
            if depth + 1 < len(common):
                own = own & ~np.repeat(shared[depth + 1], fanout)[: len(own)]
            self.levels.append((common[depth], own))

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of (query, code) pairs within ``distance``."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        far = np.zeros(len(queries), np.uint8)
        for depth, (bits, own) in enumerate(self.levels):
            if depth:
                query, far = np.repeat(query, self.fanout), np.repeat(far, self.fanout)
                node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                there = node < len(bits)
                query, node, far = query[there], node[there], far[there]
            far = far + np.bitwise_count((queries[query] ^ bits[node]) & own[node])
            near = far <= distance
            query, node, far = query[near], node[near], far[near]
        return query, node


def hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of each pair; ``parent`` holds the smallest place of each tree before and after."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent != (up := parent[parent])).any():
            parent[:] = up


def group_links(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group's codes: each code that is not the first of its component, and that first one."""
    index = GrayIndex(codes)
    parent = np.arange(len(codes))
    step = max(1, (1 << 21) // len(codes))
    for at in range(0, len(codes), step):
        query, found = index.search(index.codes[at : at + step], distance)
        hook(parent, query + at, found)
    hung = np.flatnonzero(parent != np.arange(len(codes)))
    return index.codes[hung], index.codes[parent[hung]]


def _bits(low: int, width: int) -> Column:
    return F.shiftrightunsigned("code", low).bitwiseAND(F.lit((1 << width) - 1))


def _dealt(codes: DataFrame) -> DataFrame:
    """code, table, block, part: one row for each group that a code belongs to and that has others."""
    tables, parts = [], []
    for n, (i, j) in enumerate(combinations(range(4), 2)):
        tables.append(F.struct(F.lit(n).alias("table"), F.shiftleft(_bits(16 * i, 16), 16).bitwiseOR(_bits(16 * j, 16)).alias("block")))
        k, m = sorted({0, 1, 2, 3} - {i, j})
        rest = F.shiftleft(_bits(16 * k, 16), 16).bitwiseOR(_bits(16 * m, 16))
        thirds = [F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << width) - 1)) for low, width in ((0, 10), (10, 11), (21, 11))]
        parts.append(F.array(*[F.lit(t << 11).cast("bigint").bitwiseOR(x) for t, x in enumerate(thirds, 1)]))
    keyed = codes.select("code", F.explode(F.array(*tables)).alias("g")).select("code", "g.*")
    sizes = keyed.groupBy(F.col("table").alias("t"), F.col("block").alias("b")).agg(F.count("*").alias("size")).filter("size > 1")
    held = keyed.join(sizes, (F.col("table") == F.col("t")) & (F.col("block") == F.col("b")))
    split = F.element_at(F.array(*parts), F.col("table") + 1)
    part = F.when(F.col("size") > GROUP, split).otherwise(F.array(F.lit(0).cast("bigint")))
    return held.select("code", "table", "block", F.explode(part).alias("part"))


def near_links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect the distinct codes of column ``code`` wherever two are within ``distance``."""
    if not 0 <= distance <= 2:
        raise ValueError("the tables hold for a distance of at most two bits")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(group: list[np.ndarray]) -> pa.RecordBatch:
            ends = group_links(np.concatenate(group).view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)) for e in ends], ["a", "b"])

        group: list[np.ndarray] = []
        last = None
        for batch in batches:
            code, *keys = (batch.column(i).to_numpy() for i in range(4))
            keys = np.stack(keys).astype(np.int64)
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(code)]):
                if stop == start:
                    continue
                if last is not None and (keys[:, start] == last).all():
                    group.append(code[start:stop])
                    continue
                if sum(map(len, group)) > 1:
                    yield linked(group)
                group, last = [code[start:stop]], keys[:, start]
        if sum(map(len, group)) > 1:
            yield linked(group)

    group = ["table", "block", "part"]
    return _dealt(codes).repartition(*group).sortWithinPartitions(*group).mapInArrow(search, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs``: key, fingerprint (16 hex digits), component_id (the smallest key reachable by
    links of at most ``distance`` differing bits, its own included).

    One row per input row. Equal fingerprints always link; texts without words, NULL ones too, have
    fingerprint zero and link like others. A NULL key is never the smallest: its component_id is NULL
    only if no other key is reached. An empty table gives an empty result. Other columns of ``docs``
    are not read.
    """
    rows = settle(docs.select(F.col(key).alias("key"), fingerprint(as_bytes(text)).alias("code")))
    codes = settle(rows.groupBy("code").agg(F.min("key").alias("first")))
    roots = connected(near_links(codes.select("code"), distance))
    rooted = codes.join(roots, F.col("code") == F.col("node"), "left").select("code", "first", F.coalesce("root", "code").alias("root"))
    smallest = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    classes = settle(rooted.join(smallest, F.col("root") == F.col("r")).select(F.col("code").alias("c"), "component_id"))
    out = rows.join(classes, F.col("code") == F.col("c"))
    return out.select(F.col("key").alias(key), F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``docs`` without the documents whose key is not the smallest of its component; rows without a key stay."""
    classes = near_duplicates(docs.select(key, text), key=key, text=text, distance=distance)
    gone = classes.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("__gone"), "left_anti")
