"""Quality rules against a plain count, and the distances against their formula."""

import math
import re
from collections import Counter

import numpy as np

from vectable.llm import queries
from vectable.llm.quality import Limits, js_distance, keep_good, language_references, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed,
    )


def fields(r):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])


def test_base_counts(spark, sf_dir, real_docs):
    rows = queries.op7_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(real_docs)
    for r in rows:
        assert fields(r) == plain(real_docs[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


def test_odd_rows(odd_docs, odd_rows):
    got = sorted((str(r["doc_id"]), *fields(r)) for r in quality(odd_docs).collect())
    assert got == sorted((str(i), *plain(t or "")) for i, t in odd_rows)
    assert quality(odd_docs.limit(0)).count() == 0


def test_distance_is_jensen_shannon():
    assert js_distance(np.array([1.0, 0]), np.array([0, 3.0])) == 1
    assert js_distance(np.array([2.0, 2]), np.array([5, 5.0])) == 0
    p, q = (0.25, 0.75), (0.5, 0.5)
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = math.sqrt(sum(a * math.log2(a / c) for x in (p, q) for a, c in zip(x, m)) / 2)
    assert math.isclose(js_distance(np.array(p), np.array(q)), want)


def prose(n, seed=0):
    draw = np.random.default_rng(seed)
    return " ".join(draw.choice(["the", "of", "and", "to", *[f"w{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]], n)) + "."


def test_divergent_texts_go_and_clean_ones_stay(make_docs):
    rows = [(i, prose(200, i)) for i in range(60)]
    noise = " ".join(f"w{chr(97 + i % 26)}{i}***" for i in range(200))
    got = {r["doc_id"]: r for r in quality(make_docs([*rows, (100, noise), (101, prose(200, 7).upper())])).collect()}
    assert all(got[i]["kept"] for i in range(60))
    assert not got[100]["kept"] and not got[100]["base_failed"] and got[100]["class_distance"] > 0.3
    assert not got[101]["kept"]


def test_short_texts_are_not_judged_by_distance(make_docs):
    docs = make_docs([(i, prose(200, i)) for i in range(20)] + [(50, "*** " * 30 + prose(50, 3))])
    r = quality(docs, limits=Limits(min_chars=10_000, min_words=10_000)).filter("doc_id = 50").first()
    assert r["class_distance"] is None and r["word_distance"] is None and r["kept"] == (not r["base_failed"])


def test_references_count_every_text(make_docs):
    found = language_references(make_docs([(1, "The the cat"), (2, "dog 7"), (3, None)]))
    assert set(found) == {"en"}
    assert found["en"].words.keys() == {b"the", b"cat", b"dog", b"7"}
    assert found["en"].shares.sum() == 5 and found["en"].shares[found["en"].words[b"the"]] == 2
    assert found["en"].classes.sum() == len("The the catdog 7")


def test_filter_keeps_rows_whole(make_docs):
    docs = make_docs([(i, prose(200, i)) for i in range(20)] + [(90, "short"), (91, None)])
    out = keep_good(docs)
    assert out.schema == docs.schema
    assert sorted(out.collect()) == sorted(docs.filter("doc_id < 90").collect())


def test_rare_language_of_another_script_is_not_judged_by_the_others(make_docs):
    from pyspark.sql import functions as F

    cyrillic = " ".join(f"сл{chr(0x430 + i % 30)}{chr(0x430 + i * 7 % 30)}во{i % 61}" for i in range(200))
    docs = make_docs([*((i, prose(6000, i)) for i in range(120)), (900, cyrillic), *((910 + i, cyrillic[i:]) for i in range(3))])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 900, "xx").when(F.col("doc_id") > 900, "ru").otherwise("en"))
    got = {r["doc_id"]: r for r in quality(docs).filter("doc_id >= 900").collect()}
    assert set(got) == {900, 910, 911, 912} and all(r["kept"] for r in got.values())
    assert got[900]["class_distance"] is None and got[910]["class_distance"] < 0.1
    assert keep_good(docs).filter("doc_id >= 900").count() == 4


def test_small_languages_have_no_reference_whatever_their_name(make_docs):
    from pyspark.sql import functions as F

    cyrillic = " ".join(f"сл{chr(0x430 + i % 30)}{chr(0x430 + i * 7 % 30)}во{i % 61}" for i in range(200))
    docs = make_docs([*((i, prose(6000, i)) for i in range(60)), (900, cyrillic)]).withColumn("lang", F.when(F.col("doc_id") == 900, "").otherwise("en"))
    row = quality(docs).filter("doc_id = 900").first()
    assert row["class_distance"] is None and row["kept"]
    alone = quality(docs.filter("doc_id = 900")).first()  # the same verdict in a table where it has all the words
    assert alone["class_distance"] is None and alone["kept"]
