"""SimHash groups and substring dedup against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from vectable.llm import queries, substring_dedup
from vectable.llm.graph import connected
from vectable.llm.simhash import GrayIndex, _dealt, gray_rank, group_links, keep_first, near_duplicates, near_links
from vectable.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_code(text):
    words = WORD.findall(text.translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(pairs):
    """{(id, text): (code, component)} by comparing all fingerprints."""
    codes = [plain_code(t or "") for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    array = np.array(codes, np.uint64)
    for i in range(len(pairs)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 2):
            root[find(int(j))] = find(i)
    low = {}
    for i, (key, _) in enumerate(pairs):
        if key is not None:
            low[find(i)] = min(key, low.get(find(i), key))
    return sorted((str(key), f"{codes[i]:016x}", str(low.get(find(i)))) for i, (key, _) in enumerate(pairs))


def classes(df):
    return sorted((str(r[0]), r[1], str(r[2])) for r in df.collect())


def test_groups_equal_brute_force(spark, sf_dir, real_docs):
    assert classes(queries.op2_simhash(spark, sf_dir)) == plain_classes(list(real_docs.items()))


def test_groups_of_odd_rows(odd_docs, odd_rows):
    assert classes(near_duplicates(odd_docs)) == plain_classes(odd_rows)
    assert near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def codes():
    draw = np.random.default_rng(5)
    out = set()
    for base in draw.integers(0, 2**64, 40, dtype=np.uint64):
        for _ in range(12):
            flips = draw.choice(64, draw.integers(0, 6), replace=False)
            out.add(int(base) ^ sum(1 << int(b) for b in flips))
    return np.array(sorted(out), np.uint64)


def test_gray_ranks_follow_the_gray_sequence():
    n = np.arange(1000, dtype=np.uint64)
    assert (gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("distance", [0, 1, 2, 5])
@pytest.mark.parametrize("fanout", [2, 8])
def test_index_finds_all_within_the_distance(codes, distance, fanout):
    index = GrayIndex(codes, fanout)
    query, found = index.search(codes, distance)
    got = set(zip(codes[query].tolist(), index.codes[found].tolist()))
    near = np.bitwise_count(codes[:, None] ^ codes) <= distance
    assert got == {(int(codes[i]), int(codes[j])) for i, j in zip(*np.nonzero(near))}


def test_links_of_a_group_are_a_forest(codes):
    a, b = group_links(codes, 2)
    assert len(set(a.tolist())) == len(a) and not set(a.tolist()) & set(b.tolist())


def test_split_groups_lose_no_link(spark, codes, monkeypatch):
    from vectable.llm import simhash

    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code bigint")

    def parts():
        return {frozenset(g) for g in _components(near_links(frame).collect())}

    whole = parts()
    monkeypatch.setattr(simhash, "GROUP", 1)
    assert _dealt(frame).filter("part > 0").count() > 0
    assert parts() == whole and len(whole) > 5


def _components(links):
    groups = {}
    for a, b in links:
        merged = groups.get(a, {a}) | groups.get(b, {b})
        for x in merged:
            groups[x] = merged
    return groups.values()


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 103), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    got = dict(connected(spark.createDataFrame(chain, "x bigint, y bigint")).collect())
    want = {i: 0 for i in range(1, 41)} | {101: 100, 102: 100, 103: 100} | {200 + i: 200 for i in range(1, 50)}
    assert got == want
    assert connected(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_first_of_each_group_stays(odd_docs):
    kept = keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 3 in ids and 4 not in ids and None in ids and ids.count(2) == 0


def plain_cut(pairs, window=13):
    words = [WORD.findall(t or "") for _, t in pairs]
    first = {}
    for (key, _), row in zip(pairs, words):
        for i in range(len(row) - window + 1 if key is not None else 0):
            w = tuple(row[i : i + window])
            first[w] = min(key, first.get(w, key))
    out = []
    for (key, _), row in zip(pairs, words):
        gone = set()
        for i in range(len(row) - window + 1 if key is not None else 0):
            if first[tuple(row[i : i + window])] < key:
                gone |= set(range(i, i + window))
        out.append((str(key), len(row), len(gone), " ".join(w for i, w in enumerate(row) if i not in gone)))
    return sorted(out)


def test_repeats_equal_brute_force(spark, sf_dir, real_docs):
    want = [(int(k), n, gone, hashlib.sha256(t.encode()).hexdigest()) for k, n, gone, t in plain_cut(list(real_docs.items()))]
    assert sorted(tuple(r) for r in queries.op8_substring_dedup(spark, sf_dir).collect()) == sorted(want)


def test_repeats_of_odd_rows(make_docs, odd_docs, odd_rows):
    def got(docs):
        return sorted((str(r[0]), r[1], r[2], r[3]) for r in remove_repeats(docs).collect())

    assert got(odd_docs) == plain_cut(odd_rows)
    assert remove_repeats(odd_docs.limit(0)).count() == 0
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(5, f"a b {passage} c {passage}"), (4, f"{passage} d"), (9, passage[3:]), (9, f"{passage} e"), (7, f"{passage}\n{passage}")]
    rows += [(20 + i, f"{i} {passage} x y z" * 3) for i in range(30)]
    assert got(make_docs(rows)) == plain_cut(rows)


@pytest.mark.parametrize("chunk", [1, 500, 1 << 20])
def test_chunks_do_not_matter(make_docs, monkeypatch, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    draw = np.random.default_rng(1)
    rows = [(int(i), " ".join(draw.choice(list("abc"), 60))) for i in draw.permutation(40)]
    got = sorted((str(r[0]), r[1], r[2], r[3]) for r in remove_repeats(make_docs(rows)).collect())
    assert got == plain_cut(rows)
