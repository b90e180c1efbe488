"""The trie of all conversations: one node per distinct sequence of first turns, with what shares it.

Conversations are dealt by ranges of (sequence of turns, id) into shards, so a conversation that very
many ids share is cut into several shards like any other run of rows. A shard codes its turns as dense
integers, puts its distinct sequences into a ternary search tree, the middle one first and then the
middles of both halves, and walks the tree once without recursion; the nodes come out in the order of
the sequences, and a pass back over them adds up members, leaves and savings.

Nodes on the path of a shard's first or last sequence may go on in the next shard. Their parts, a few
per shard, meet in one more pass in the same order, which holds one path of open nodes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vectable.sources.tables import settle, small_side

TURN_BYTES = 16  # of the digest that stands for a turn's role and text
SHARD_TURNS = 1_000_000  # turns in a shard, about

PART = (
    "open boolean, shard int, place bigint, parent bigint, depth bigint, turn binary, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, size bigint, n_ends bigint, ends string"
)
MERGED = (
    "shard int, place bigint, node bigint, parent bigint, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends string"
)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and ``seq``, an array of (turn, digest, size) in the order of the turns: NULL turns first, equal
    ones by digest. NULL roles and texts are empty; rows without conv_id take no part. The digest is the
    first 16 bytes of a SHA-256, ``size`` the UTF-8 bytes of the text. A conversation is one row here: its
    digests, about 60 bytes a turn and no texts, have to fit in a task."""
    said, spoken = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, spoken)  # no two turns run together alike
    digest = F.substring(F.sha2(whole, 256), 1, 2 * TURN_BYTES)
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(spoken).alias("size")).alias("said"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("seq"))


def regrown(convs: DataFrame, head: int, own: Column, base: Column) -> DataFrame:
    """Conversations whose first turns come from another one: the first ``own`` turns (at most ``head``) of
    conversation ``base``, then the conversation's own after its first ``own``."""
    heads = convs.select(F.col("conv_id").alias("__base"), F.slice("seq", 1, head).alias("__head"))
    met = convs.withColumns({"__own": own.cast("int"), "__at": base}).join(heads, F.col("__at") == F.col("__base"), "left")
    first = F.slice(F.coalesce("__head", F.slice("seq", 1, 0)), F.lit(1), F.col("__own"))
    rest = F.slice("seq", F.col("__own") + 1, F.greatest(F.size("seq") - F.col("__own"), F.lit(0)))
    return met.select("conv_id", F.concat(first, rest).alias("seq"))


def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, seq as from ``sequences``; ids are distinct).

    conv_id is the node's smallest member and names it together with depth; parent_conv_id is the parent's
    (NULL for the root). n_convs counts members, n_children distinct next turns, n_leaves the childless
    nodes of its subtree (itself included), saved_tokens adds (n_convs - 1) times the bytes of the last text
    over its subtree, and ends_sha256 is the hash of the members that end here, ascending, joined by commas.
    No conversations: no rows.
    """
    rows = settle(
        convs.select(
            F.unhex(F.array_join(F.transform("seq", lambda s: s["digest"]), "")).alias("seq"),
            F.transform("seq", lambda s: s["size"]).cast("array<bigint>").alias("sizes"), "conv_id",
        )
    )
    spark = convs.sparkSession
    turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    dealt = rows.repartitionByRange(shards, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = settle(dealt.select(F.spark_partition_id().alias("shard"), "seq", "sizes", "conv_id").mapInArrow(_shard, PART))

    edge = parts.filter("open").drop("open", "parent", "parent_conv_id").repartition(1).sortWithinPartitions("shard", "place")
    merged = settle(edge.mapInArrow(_merge, MERGED))
    nodes, places = merged.filter("shard IS NULL"), merged.filter("shard IS NOT NULL")
    names = nodes.select(F.col("node").alias("__node"), F.col("conv_id").alias("parent_conv_id"))
    shared = nodes.join(names, F.col("parent") == F.col("__node"), "left").withColumnRenamed("ends", "ends_sha256").select(*NODE)

    # A node whose parent is open has its parent's place instead of its name; there are few such places.
    named = places.join(nodes.select("node", F.col("conv_id").alias("__name")), "node").select(
        F.col("shard").alias("__shard"), F.col("place").alias("__place"), "__name"
    )
    inner = parts.filter("NOT open")
    met = inner.join(small_side(settle(named)), (F.col("shard") == F.col("__shard")) & (F.col("parent") == F.col("__place")), "left")
    inner = met.withColumn("parent_conv_id", F.coalesce("__name", "parent_conv_id")).withColumnRenamed("ends", "ends_sha256")
    return inner.select(*NODE).unionByName(shared)


class Tree:
    """Ternary search tree over sequences of integer codes; nodes are positions in lists."""

    def __init__(self) -> None:
        self.code: list[int] = []
        self.less: list[int] = []
        self.more: list[int] = []
        self.below: list[int] = []  # first node of the next turn's tree
        self.top = -1

    def _new(self, code: int) -> int:
        self.code.append(code)
        self.less.append(-1)
        self.more.append(-1)
        self.below.append(-1)
        return len(self.code) - 1

    def insert(self, codes: list[int]) -> int:
        """The node of the last code, -1 for an empty sequence."""
        at, links, holder = self.top, None, -1
        last = -1
        for code in codes:
            while at >= 0 and self.code[at] != code:
                links, holder = (self.less, at) if code < self.code[at] else (self.more, at)
                at = links[at]
            if at < 0:
                at = self._new(code)
                if links is None:
                    self.top = at
                else:
                    links[holder] = at
            last, links, holder, at = at, self.below, at, self.below[at]
        return last

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, parent's place, depth) in the order of the sequences, places counted from 1."""
        waiting, place = [(self.top, 0, 1, False)], 0
        while waiting:
            node, parent, depth, own = waiting.pop()
            if node < 0:
                continue
            if own:
                place += 1
                yield node, parent, depth
                waiting.append((self.below[node], place, depth + 1, False))
            else:
                waiting += [(self.more[node], parent, depth, False), (node, parent, depth, True), (self.less[node], parent, depth, False)]


def middles(n: int) -> Iterator[int]:
    """0..n-1, the middle of every range before the middles of its halves."""
    waiting = [(0, n)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            waiting += [(mid + 1, high), (low, mid)]


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard, whose rows come in the order of (seq, conv_id)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    shard, ids = rows.column("shard")[0].as_py(), rows.column("conv_id").to_numpy()
    distinct, starts, sizes, before = [], [], [], None
    at = 0
    for chunk in rows.column("seq").chunks:
        for value in chunk:
            seq = value.as_buffer()
            if before is None or not seq.equals(before):
                distinct.append(seq.to_pybytes())
                starts.append(at)
                before = seq
            at += 1
    sizes = rows.column("sizes").take(pa.array(starts)).to_pylist()
    ends = [*starts[1:], at]
    cut = [[s[i : i + TURN_BYTES] for i in range(0, len(s), TURN_BYTES)] for s in distinct]
    names = sorted({turn for turns in cut for turn in turns})
    codes = {turn: code for code, turn in enumerate(names)}
    tree, ending = Tree(), {}
    for i in middles(len(cut)):
        ending[tree.insert([codes[turn] for turn in cut[i]])] = i

    node_at, parent, depth = [-1], [-1], [0]
    for node, above, deep in tree.walk():
        node_at.append(node)
        parent.append(above)
        depth.append(deep)
    n = len(node_at)
    of = [ending.get(node, -1) for node in node_at]  # the sequence that ends at a node
    size = [0] + [-1] * (n - 1)
    for place, i in enumerate(of):
        if i >= 0:  # a sequence gives the sizes of its whole path; each node above is met once
            up, deep = place, depth[place]
            while size[up] < 0:
                size[up] = sizes[i][deep - 1]
                up, deep = parent[up], deep - 1

    is_open = [False] * n
    for place in range(len(cut[0]) + 1):  # the first sequence is the first path
        is_open[place] = True
    up = n - 1  # the last sequence ends at the last node
    while up >= 0:
        is_open[up] = True
        up = parent[up]

    members, low = [0] * n, [None] * n
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for place in range(n - 1, -1, -1):
        i = of[place]
        if i >= 0:
            members[place] += ends[i] - starts[i]
            first = int(ids[starts[i]])
            low[place] = first if low[place] is None or first < low[place] else low[place]
        up = parent[place]
        if not is_open[place]:
            leaves[place] += not children[place]
            saved[place] += (members[place] - 1) * size[place]
            children[up] += 1
            leaves[up] += leaves[place]
            saved[up] += saved[place]
        if up >= 0:
            members[up] += members[place]
            low[up] = low[place] if low[up] is None or low[place] < low[up] else low[up]

    none = hashlib.sha256(b"").hexdigest()
    schema = _arrow(PART)
    for begin in range(0, n, 50_000):
        span = range(begin, min(n, begin + 50_000))
        shown, counts = [], []
        for place in span:
            i = of[place]
            text = _joined(ids[starts[i] : ends[i]]) if i >= 0 else ""
            counts.append(ends[i] - starts[i] if i >= 0 else 0)
            shown.append(text if is_open[place] else hashlib.sha256(text.encode()).hexdigest() if text else none)
        take = lambda values: [values[place] for place in span]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(column, field.type)
                for column, field in zip(
                    [
                        take(is_open), [shard] * len(span), list(span), take(parent), take(depth),
                        [names[tree.code[node_at[place]]] if place else b"" for place in span], take(low),
                        [low[parent[place]] if place and not is_open[parent[place]] else None for place in span], take(members), take(children),
                        take(leaves), take(saved), take(size), counts, shown,
                    ],
                    schema,
                )
            ],
            schema=schema,
        )


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


class _Open:
    """A node whose rows may go on."""

    def __init__(self, node: int, parent: int | None, row: dict) -> None:
        self.node, self.parent, self.turn, self.depth, self.size = node, parent, row["turn"], row["depth"], row["size"]
        self.low: int | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.hash, self.any = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        self.members += row["n_convs"]
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved_tokens"]
        self.low = row["conv_id"] if self.low is None else min(self.low, row["conv_id"])
        if row["n_ends"]:
            self.hash.update(("," if self.any else "").encode() + row["ends"].encode())
            self.any = True


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of open nodes in the order of (shard, place), which is the order of the whole trie: a node with
    the depth and turn of an open one is that one, any other closes all that are as deep or deeper."""
    schema, path, count = _arrow(MERGED), [], 0

    def close(down_to: int) -> list[tuple]:
        closed = []
        while len(path) > down_to:
            done = path.pop()
            done.leaves += not done.children
            done.saved += (done.members - 1) * done.size
            if path:
                path[-1].children += 1
                path[-1].leaves += done.leaves
                path[-1].saved += done.saved
            closed.append((None, None, done.node, done.parent, done.depth, done.low, done.members, done.children, done.leaves, done.saved, done.hash.hexdigest()))
        return closed

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for held in batches:
        out = []
        for at in range(0, held.num_rows, 1_000):
            for row in held.slice(at, 1_000).to_pylist():
                depth = row["depth"]
                if len(path) <= depth or path[depth].turn != row["turn"]:
                    out += close(depth)
                    path.append(_Open(count, path[-1].node if path else None, row))
                    count += 1
                path[depth].add(row)
                out.append((row["shard"], row["place"], path[depth].node, *[None] * 8))
        if out:
            yield batch(out)
    if path:
        yield batch(close(0))
