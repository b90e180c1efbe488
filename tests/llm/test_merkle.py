"""The manifest against a plain tree built in Python, on given and on odd tables."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

from checks.compare import canonical
from vectable.llm import merkle
from vectable.llm.queries import ORACLE, merkle_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    shown = [row[f] + more if f == "n_chars" and row[f] is not None else row[f] for f in FIELDS]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in shown])


def climb(nodes):
    """The root, and for every node the (sibling, is it on the left) of each level."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, place in enumerate(at):
            beside = place ^ 1
            paths[i].append((nodes[beside] if beside < len(nodes) else "", place % 2 == 1))
            at[i] = place // 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        known = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)), i) for i, r in enumerate(groups[name]))
        members = [groups[name][i] for _, i in known]
        trees.append((members, *climb([leaf(r) for r in members])))
    if not trees:
        return []
    root, over = climb([subroot for _, subroot, _ in trees])
    out = []
    for (members, subroot, paths), above in zip(trees, over):
        for row, path in zip(members, paths):
            path = path + above
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            found = leaf(row, int(tampered))
            for beside, left in path:
                found = digest(beside, found) if left else digest(found, beside)
            out.append((row["doc_id"], leaf(row), subroot, root, digest(*[b for b, _ in path]), found, found == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = ordered(merkle_rows(docs).collect())
    assert got == ordered(plain([r.asDict() for r in docs.collect()]))
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_sql_twin(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    twin = con.sql(ORACLE["op12_merkle_manifest"]).df()
    assert canonical(merkle_rows(spark.read.parquet(f"{sf_dir}/documents.parquet")).toPandas()) == canonical(twin)


@pytest.fixture
def narrow_blocks(monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2)  # blocks of four leaves, so that small tables need several rounds


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()), T.StructField("hash", T.StringType()),
    T.StructField("grp", T.IntegerType()), T.StructField("block", T.StringType()),
])


def odd(rows):
    return [(*r, "x", 1, "y") for r in rows]


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 5, 16, 17, 37])
def test_group_sizes_over_several_rounds(spark, narrow_blocks, size):
    rows = odd([(i, "s", "de", i, f"t{i}") for i in range(size)] + [(100 + i, "s", f"l{i}", 1, "t") for i in range(6)] * bool(size))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert ordered(merkle_rows(docs).collect()) == ordered(plain([r.asDict() for r in docs.collect()]))


def test_odd_rows(spark, narrow_blocks):
    rows = odd([
        (7, None, None, None, None), (7, None, None, None, None), (None, "s", "en", 3, "abc"), (None, "s", "en", 3, "abd"),
        (1, "", "", 0, ""), (2, "-", "é", 2**63 - 1, "😀" * 3), (3, "1:x", "z", 1, "x" * 300_000), (5, "s", "en", 1, "a"), (5, "s", "en", 1, "a"),
        (-4, "s", "en", 1, "a"), (5, "s", "en", 1, "b"),
    ])
    docs = spark.createDataFrame(rows, SCHEMA)
    got = ordered(merkle_rows(docs).collect())
    assert len(got) == len(rows)
    assert got == ordered(plain([r.asDict() for r in docs.collect()]))


def test_a_hot_group_and_many_small_ones(spark):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id"))).alias("lang"),
        F.col("id").alias("n_chars"), F.lit("t").alias("text"),
    )
    assert ordered(merkle_rows(docs).collect()) == ordered(plain([r.asDict() for r in docs.collect()]))


def test_one_exchange_and_one_sort_for_all_levels(spark, plan_of):
    nodes = spark.createDataFrame([], "grp string, rank bigint, levels int, hash string, item struct<key:bigint>")
    plan = plan_of(merkle._blocks(nodes)).split("\n\n\n")[0]
    assert plan.count("SortAggregate") == 2 * merkle.BLOCK_BITS
    assert plan.count("Exchange") == 1 and plan.count("- Sort ") + plan.count("* Sort ") == 1
    assert "Join" not in plan
