"""Random filters, pages and batches against plain Python."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from vectable.functions.predicates import to_column
from vectable.operators import ingest, search
from vectable.table import VectorTable

TABLE = VectorTable()
ROWS = [(str(i), (random.Random(i).choice([None, "x", "y", "xy"]), random.Random(i + 99).choice([None, 0, 1, 2, 3]))) for i in range(40)]
FAST = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

leaf = st.one_of(
    st.tuples(st.just("s"), st.sampled_from(["$eq", "$ne", "$contains"]), st.sampled_from(["x", "y", "xy"])),
    st.tuples(st.just("n"), st.sampled_from(["$eq", "$ne", "$gt", "$gte", "$lt", "$lte"]), st.integers(0, 3)),
    st.tuples(st.just("n"), st.sampled_from(["$in", "$nin"]), st.lists(st.one_of(st.none(), st.integers(0, 3)), max_size=3)),
).map(lambda t: {t[0]: {t[1]: t[2]}})
filters = st.recursive(
    leaf,
    lambda inner: st.one_of(
        st.tuples(st.sampled_from(["$and", "$or", "$nor"]), st.lists(inner, min_size=1, max_size=3)).map(lambda t: {t[0]: t[1]}),
        inner.map(lambda f: {"$not": f}),
    ),
    max_leaves=6,
)


def holds(condition, row):
    """The rules in plain Python: positive is false on a missing value, negative is the complement."""
    for key, value in condition.items():
        if key in ("$and", "$or", "$nor"):
            found = [holds(f, row) for f in value]
            ok = all(found) if key == "$and" else any(found) if key == "$or" else not any(found)
        elif key == "$not":
            ok = not holds(value, row)
        else:
            ok = all(leaf_holds(op, row[key], operand) for op, operand in value.items())
        if not ok:
            return False
    return True


def leaf_holds(op, value, operand):
    if op == "$ne":
        return not leaf_holds("$eq", value, operand)
    if op == "$nin":
        return not leaf_holds("$in", value, operand)
    if op == "$in":
        return value in operand
    if value is None:
        return False
    return {
        "$eq": lambda: value == operand, "$contains": lambda: operand in value, "$gt": lambda: value > operand,
        "$gte": lambda: value >= operand, "$lt": lambda: value < operand, "$lte": lambda: value <= operand,
    }[op]()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id string, metadata struct<s string, n int>").coalesce(1).cache()


@FAST
@given(st.lists(filters, min_size=8, max_size=8))
def test_filters(table, conditions):
    flags = table.select("id", *[to_column(table, TABLE, c).alias(f"c{i}") for i, c in enumerate(conditions)]).collect()
    for row, (_, (s, n)) in zip(flags, ROWS):
        for i, condition in enumerate(conditions):
            assert bool(row[f"c{i}"]) == holds(condition, {"s": s, "n": n}), condition


@FAST
@given(st.lists(st.integers(0, 20), max_size=12), st.integers(1, 5), st.integers(0, 5), st.one_of(st.none(), st.integers(0, 20)))
def test_pages(spark, scores, top, skip, minimum):
    scores = sorted(scores, reverse=True)[: top + skip]
    hits = spark.createDataFrame([(1, i + 1, str(i), float(s)) for i, s in enumerate(scores)], "query_id int, rank int, id string, score double")
    left = [str(i) for i, s in enumerate(scores) if minimum is None or s >= minimum][skip : skip + top]
    got = search.page(hits.coalesce(1), top, skip, minimum).orderBy("rank").collect()
    assert [(r["rank"], r.id) for r in got] == [(i + 1, x) for i, x in enumerate(left)]


@settings(FAST, max_examples=6)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9)), st.lists(st.tuples(st.sampled_from("abcdefgh"), st.integers(10, 19)), max_size=8), st.sampled_from([0, 100]))
def test_upserts(spark, current, batch, limit):
    stored = spark.createDataFrame([(k, str(v)) for k, v in current.items()], "id string, text string").coalesce(1)
    news = spark.createDataFrame([(k, str(v), i) for i, (k, v) in enumerate(batch)], "id string, text string, ord int").coalesce(1)
    news = ingest.latest_per_id(news, TABLE).drop("ord")
    want = {**{k: str(v) for k, v in current.items()}, **{k: str(v) for k, v in batch}}
    for put in (ingest.upsert_replace, ingest.upsert_merge):
        out = put(stored, news, TABLE, max_broadcast=limit).collect()
        assert {r.id: r.text for r in out} == want and len(out) == len(want)
