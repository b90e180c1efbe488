"""The conversation trie against sets of prefixes built in Python."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest
from pyspark.sql import types as T

from checks.compare import canonical
from vectable.llm.queries import ORACLE, trie_rows
from vectable.llm.turn_trie import Tree, middles, prefix_trie, sequences

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("seq", T.StringType()), T.StructField("depth", T.LongType()),
    T.StructField("shard", T.StringType()), T.StructField("said", T.LongType()),
])


def own_turns(rows):
    found = {}
    for r in rows:
        if r[0] is not None:
            found.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def plain(built):
    members = {}
    for conv, seq in built.items():
        for depth in range(len(seq) + 1):
            members.setdefault(tuple(seq[:depth]), []).append(conv)
    below = {}
    for path in members:
        if path:
            below.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[p] for p in below.get(path, [])) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * size + sum(saved[p] for p in below.get(path, []))
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(below.get(path, [])), leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


def rebuilt(rows):
    own = own_turns(rows)
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "x", 2) for r in rows], SCHEMA)


def test_given_conversations(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, trie_rows(turns).collect())) == plain(rebuilt(rows))


def test_sql_twin(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    twin = con.sql(ORACLE["op13_conversation_trie"]).df()
    assert canonical(trie_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet")).toPandas()) == canonical(twin)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "without an id"), (10, None, None, None), (10, 1, "user", ""), (10, 1, "user", ""), (10, 2, "", "user"),
        (11, 0, "user", "a" * 300_000), (12, None, "x", "é😀"), (12, None, "x", "b"), (-3, 1, "user", "hi"), (-3, 2, "bot", "there"), (0, 1, "user", "hi"),
        (3, 1, "user", "hi"), (3, 2, "bot", "there"), (2**62, 1, "user", "hi"), (4, 1, "a", "bc"), (5, 1, "ab", "c"),
    ]
    assert sorted(map(tuple, trie_rows(frame(spark, rows)).collect())) == plain(rebuilt(rows))


def test_empty_table(spark):
    assert trie_rows(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_copies_shared_heads_and_shards(spark, seed):
    """Hot conversations cut into many shards, prefixes that are conversations themselves, turns of no text."""
    rng, rows = random.Random(seed), []
    for c in range(400):
        kind = c % 4
        turns = ["a", "b"] if kind == 0 else [rng.choice("abc") for _ in range(rng.randrange(1, 6))] if kind < 3 else ["a"] + [str(rng.random())]
        rows += [(c, i, "user", "" if t == "c" else t) for i, t in enumerate(turns)]
    turns = frame(spark, rows)
    got = prefix_trie(sequences(turns), shard_turns=50).collect()
    assert sorted(map(tuple, got)) == plain(own_turns(rows))


def test_a_conversation_shared_by_most_is_dealt_to_many_shards(spark):
    rows = [(c, t, "user", "same") for c in range(2_000) for t in range(2)]
    nodes = prefix_trie(sequences(frame(spark, rows)), shard_turns=500)
    assert sorted(map(tuple, nodes.collect())) == plain(own_turns(rows))


def test_tree_is_balanced_by_middles():
    tree, order = Tree(), list(middles(1_000))
    assert sorted(order) == list(range(1_000))
    for code in order:
        tree.insert([code])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.less[node]), height(tree.more[node]))

    assert height(tree.top) == 10
    assert [tree.code[node] for node, _, _ in tree.walk()] == list(range(1_000))


def test_walk_of_a_very_long_sequence_does_not_recurse():
    tree = Tree()
    tree.insert([1] * 50_000)
    assert [depth for _, _, depth in tree.walk()][-1] == 50_000
