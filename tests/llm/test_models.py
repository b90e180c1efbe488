"""HTML extraction and language model: exactness of the parts, accuracy on held-out data."""

import itertools
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vectable.llm import queries
from vectable.llm.elias_fano import EliasFano, map_bytes, map_file, to_bytes
from vectable.llm.html_blocks import Block, blocks, labelled_pages, text_features
from vectable.llm.html_extract import Field, _marginals, extract, main_text, train, trained_field
from vectable.llm.ngram_lm import ANY, RARE, START, TOLD, Dealing, Vocabulary, _uncrushed, _unpacked, held_out, noted, noted_words, rare_id, score_texts, sent_tokens, told_counts
from vectable.llm.ngram_trie import Trie, build, quantise
from vectable.sources.tables import checkpoint_dir

# --- pages


@pytest.fixture(scope="module")
def field():
    return trained_field()


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_leaves():
    page = "<p>a &amp; <b>b</b>c\n\t d<br>e<p>f<ul><li>g<li>h <a href=x>i</a></ul><script>'<p>x</p>'</script>j<!-- <p>k --><div>l"
    assert texts(page) == ["a & bc d e", "f", "g", "h i", "j", "l"]
    found = blocks('<div class="Site-Footer x"><nav><a href="/">one two</a> tail</nav></div>')
    assert found[0].path == ("in:div", "name:site", "name:footer", "in:nav", "in:a")[:4]
    assert found[0].tag == "nav" and found[0].linked == pytest.approx(7 / 12)


@pytest.mark.parametrize("page", ["", "plain", "<", "a < b > c", "<p", "</p></div>", "<p class='x>y</p>", "<script>never closed", "<!-- open", "<td>x</table>y", "&#0;&bogus;&lt;p&gt;", "<div>" * 3000 + "x"])
def test_broken_pages(page):
    for text in texts(page):
        assert text == " ".join(text.split()) and text


def test_marginals_and_viterbi_against_all_labelings(field):
    draw = np.random.default_rng(2)
    own, step = draw.normal(size=(3, 5)), draw.normal(size=(2, 2))
    there = np.arange(5) < np.array([[5], [3], [1]])
    chance, pairs = _marginals(own, step, there)
    want, want_pairs = np.zeros((3, 5)), np.zeros((2, 2))
    for p, n in enumerate((5, 3, 1)):
        def score(y):
            return sum(own[p, i] for i in range(n) if y[i]) + sum(step[y[i], y[i + 1]] for i in range(n - 1))
        every = list(itertools.product((0, 1), repeat=n))
        whole = sum(math.exp(score(y)) for y in every)
        for y in every:
            share = math.exp(score(y)) / whole
            for i in range(n):
                want[p, i] += share * y[i]
            for i in range(n - 1):
                want_pairs[y[i], y[i + 1]] += share
    assert np.allclose(chance[there], want[there]) and np.allclose(pairs, want_pairs)
    page = [Block((f"f{i}",), "p", "x", 0.0) for i in range(6)]
    model = Field({f"f{i}": float(w) for i, w in enumerate(draw.normal(size=6))}, 0.1, step.tolist())
    best = max(itertools.product((0, 1), repeat=6), key=lambda y: sum(model.score(b) for b, l in zip(page, y) if l) + sum(step[a, b] for a, b in zip(y, y[1:])))
    assert model.decode(page) == list(best) and model.decode([]) == []


def test_held_out_accuracy(field):
    counts = Counter()
    for found, labels in labelled_pages(150, seed=77):
        counts.update(zip(field.decode(found), labels))
    assert 2 * counts[1, 1] / (2 * counts[1, 1] + counts[0, 1] + counts[1, 0]) > 0.97


def test_training_learns_a_rule():
    pages = [([Block(("in:p",) if y else ("in:nav",), "p", "word", 0.0) for y in labels], list(labels)) for labels in itertools.product((0, 1), repeat=4)]
    model = train(pages, rounds=60)
    assert all(model.decode(found) == labels for found, labels in pages)
    assert "words:2" in text_features(pages[0][0][0])


def test_article_of_every_page(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op4_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>.*?</article>", pages[r["page_id"]], re.S)[0]
        assert r["text"] == " ".join(texts(article)) and r["n_chars"] == len(r["text"])


def test_odd_pages(spark, field):
    long = "<article>" + "<p>A sentence of some words, and then more of them.</p>" * 5000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some words, said here. And more of it.</p></article>"), (3, "u", long), (3, "u", long)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = extract(pages, field=field)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {r["page_id"]: r["text"] for r in got.collect()}
    assert by[1] == by[2] == "" and by[None].startswith("Some words") and len(by[3].split()) == 50_000
    assert got.count() == 5 and extract(pages.limit(0), field=field).count() == 0
    assert main_text("", field) == ""


# --- language model


@pytest.mark.parametrize("top", [2, 50, 10**6, 2**44])
def test_elias_fano(tmp_path, top):
    draw = np.random.default_rng(top)
    values = np.unique(draw.integers(0, top, 3000))
    (tmp_path / "x").write_bytes(to_bytes(EliasFano.of(values).arrays()))
    sequence = EliasFano.from_arrays(map_file(str(tmp_path / "x")))
    assert (sequence.get(np.arange(len(values))) == values).all()
    asked = np.append(draw.integers(0, top + 9, 5000), values)
    place = {int(v): i for i, v in enumerate(values)}
    assert (sequence.find(asked) == [place.get(int(v), -1) for v in asked]).all()


def test_elias_fano_of_crowded_values():
    values = np.unique(np.concatenate([np.arange(50_000) * 2, (1 << 40) + np.arange(3)]))
    asked = np.concatenate([values, values + 1, values[:100] - 1 + (1 << 41)])
    got = EliasFano.of(values).find(asked)
    place = {int(v): i for i, v in enumerate(values)}
    assert got.tolist() == [place.get(int(v), -1) for v in asked]
    assert EliasFano.of(values).find(asked[:500]).tolist() == got[:500].tolist()


def test_quantised_values_are_close():
    values = np.random.default_rng(0).normal(size=5000)
    codes, table = quantise(values)
    assert codes.dtype == np.uint8 and np.abs(table[codes] - values).mean() < 0.02
    assert (table[quantise(np.array([1.5, 1.5]))[0]] is not None) and len(quantise(np.array([]))[0]) == 0


def test_packed_numbers_of_every_width():
    draw = np.random.default_rng(3)
    for width in range(1, 40):
        values = np.sort(draw.integers(0, (1 << width) * 50, 50))
        sequence = EliasFano.from_arrays(map_bytes(to_bytes(EliasFano.of(values).arrays())))
        assert (sequence.get(np.arange(50)) == values).all()


def test_trie_gives_distributions():
    draw = np.random.default_rng(1)
    line = draw.choice([3, 4, 5, 6, 7], 4000, p=[0.4, 0.3, 0.15, 0.1, 0.05])
    line[1::2] = line[:-1:2] % 5 + 3
    pairs, threes = Counter(zip(line.tolist(), line[1:].tolist())), Counter(zip(*(line[i:].tolist() for i in range(3))))
    ones = np.bincount(line, minlength=9) / len(line)
    codes = sorted((b * 9 + c, n) for (b, c), n in pairs.items() if n > 5)
    place = {code: i for i, (code, _) in enumerate(codes)}
    kept = sorted((place[b * 9 + c], a, n) for (a, b, c), n in threes.items() if b * 9 + c in place and n > 5)
    trie = Trie(map_bytes(build(9, *np.array(codes).T, *np.array(kept).T, ones)))
    for a, b in itertools.product([0, 3, 4, 5, 6, 7], [3, 4, 5, 6, 7, 8]):
        c = np.arange(3, 8)
        rank, lower = trie.pairs(np.full(5, b), c, np.log10(ones[c]))
        assert (10**lower).sum() == pytest.approx(1, abs=0.05)
        assert (10 ** trie.triples(np.full(5, a), np.full(5, b), rank, lower)).sum() == pytest.approx(1, abs=0.05)


def plain_base(pairs):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold)) + [None] for _, t in pairs]
    out = [k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in pairs]
    seen = Counter(w for row, o in zip(tokens, out) if not o for w in row)
    whole, distinct = seen.total(), len(seen)
    return sorted(
        (str(k), o, len(row), sum(seen[w] > 0 for w in row), whole, round(sum(math.log10((seen[w] + 1) / (whole + distinct + 1)) for w in row), 5))
        for (k, _), row, o in zip(pairs, tokens, out)
    )


def base(df):
    return sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 5)) for r in df.collect())


def test_base_scores(spark, sf_dir, real_docs):
    rows = queries.op10_ngram_lm(spark, sf_dir)
    assert base(rows) == plain_base(list(real_docs.items()))
    unseen = rows.filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert unseen["sum(score)"] > unseen["sum(base_score)"]


def test_scores_of_odd_rows(odd_docs, odd_rows, make_docs):
    got = score_texts(odd_docs)
    assert base(got) == plain_base(odd_rows)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got.collect())
    assert score_texts(odd_docs.limit(0)).count() == 0
    alone = [(k, "only held out rows here") for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    assert base(score_texts(make_docs(alone))) == plain_base(alone)


def plain_scores(texts, train):
    """Scores by the definition: absolute discounting, back-off to pairs and words."""
    lines = {k: ["<", *t.split(), ">"] for k, t in texts.items()}
    threes = Counter(x for k in train for x in zip(lines[k], lines[k][1:], lines[k][2:]))
    twos = Counter(x for k in train for x in zip(lines[k], lines[k][1:]))
    ones = Counter(w for k in train for w in lines[k][1:])
    whole = ones.total() + len(ones) + 1

    def first(c):
        return (ones[c] + 1) / whole

    after1, after2 = {}, {}
    for (b, c), n in twos.items():
        after1.setdefault(b, {})[c] = n
    for (a, b, c), n in threes.items():
        after2.setdefault((a, b), {})[c] = n

    def two(b, c):
        seen = after1.get(b, {})
        if c in seen or not seen:
            return (seen[c] - 0.75) / sum(seen.values()) if seen else first(c)
        return 0.75 * len(seen) / sum(seen.values()) / (1 - sum(map(first, seen))) * first(c)

    def three(a, b, c):
        seen = after2.get((a, b), {})
        if c in seen or not seen:
            return (seen[c] - 0.75) / sum(seen.values()) if seen else two(b, c)
        free, rest = 0.75 * len(seen) / sum(seen.values()), 1 - sum(two(b, x) for x in seen)
        return max(free, 1e-9) / max(rest, 1e-9) * two(b, c)

    return {k: math.log10(two("<", x[1])) + sum(math.log10(three(*t)) for t in zip(x, x[1:], x[2:])) for k, x in lines.items()}


def test_scores_use_every_word_and_every_ngram(make_docs):
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in range(400)}
    train, held = [k for k in out if not out[k]], [k for k in out if out[k]]
    draw = np.random.default_rng(5)
    texts = {k: " ".join(draw.choice([f"w{i}" for i in range(12)] + [f"once{k}"], 30)) for k in train}
    texts |= {k: " ".join(draw.choice([f"w{i}" for i in range(12)] + ["never"], 20)) for k in held}
    rows = [*texts.items(), (held[0], texts[held[0]])]
    want = plain_scores(texts, train)
    got = score_texts(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        # Probabilities of one byte are close, not equal.
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=0.02)


@pytest.mark.parametrize("shard_tokens", [40, 400, 10**6])
def test_scores_with_hot_words_and_contexts(make_docs, shard_tokens):
    """All texts start alike, one word is a third of all and follows itself; shards of any size say the same."""
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in range(150)}
    draw = np.random.default_rng(6)
    texts = {}
    for k in out:
        words = np.where(draw.random(25) < 0.4, "hot", draw.choice([f"w{i}" for i in range(30)], 25))
        texts[k] = " ".join(["all", "start", "alike", *words, f"own{k}", f"own{k}"])
    want = plain_scores(texts, [k for k in out if not out[k]])
    rows = score_texts(make_docs(list(texts.items())), shard_tokens=shard_tokens)
    assert base(rows) == plain_base(list(texts.items()))
    for r in rows.collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=0.02)


def test_no_task_meets_more_than_its_share(make_docs, spark):
    texts = [(k, "all start alike " + "hot " * 20 + f"w{k % 7} hot w{k % 5}") for k in range(300)]
    rows = make_docs(texts).repartition(4).select(F.col("doc_id").alias("key"), held_out("doc_id").alias("held_out"), F.encode("text", "utf-8").alias("text"))
    n = Counter(w for k, t in texts if zlib.crc32(str(k).encode()) % 7 != 2 for w in t.encode().split())
    words, ends = sorted(n), sum(zlib.crc32(str(k).encode()) % 7 != 2 for k, _ in texts)
    counts = np.array([0, 0, ends, 0, *(n[w] for w in words)])
    followed = np.where(np.arange(len(counts)) == 1, ends, np.where(np.arange(len(counts)) == 2, 0, counts))
    deal = Dealing(counts, followed, 16, 100, 1.0)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(words))
    hot = noted(rows, vocabulary, spark.sparkContext.broadcast(deal), 100).selectExpr("inline(triples)")
    contexts = hot.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 100").collect()
    assert contexts
    deal.set_contexts([r["a"] * len(counts) + r["b"] for r in contexts], [r["n"] for r in contexts])
    sent = sent_tokens(rows, vocabulary, spark.sparkContext.broadcast(deal)).filter("keys IS NULL").select("shard", "data").collect()
    loads = Counter()
    for r in sent:
        loads[r["shard"]] += len(_unpacked(r["data"])[2])
    assert sum(loads.values()) == sum(len(t.split()) + 1 for _, t in texts)
    assert max(loads.values()) < 3 * sum(loads.values()) / 16


def test_counts_are_told_whole_and_packed(make_docs, spark):
    """Each shard of a spread word is told the whole count of each pair that it meets, in rows that do not grow with the tokens."""
    draw = np.random.default_rng(8)
    texts = [(k, "all start " + " ".join(draw.choice([f"w{i}" for i in range(9)], 20)) + f" own{k} w1 own{k}") for k in range(300)]
    train = [["<", *t.split(), ">"] for k, t in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    twos, n = Counter(x for line in train for x in zip(line, line[1:])), Counter(w for line in train for w in line)
    words = sorted(w for w in n if w not in "<>" and not w.startswith("own"))
    ids = {"<": 1, ">": 2} | {w: 4 + i for i, w in enumerate(words)}
    rare = {w: i for w, i in spark.createDataFrame([(w,) for k, t in texts for w in {*t.split()} - ids.keys()], "w string").select("w", rare_id("w")).collect()}
    name = {i: w for w, i in (ids | rare).items()}
    counts = np.array([0, 0, len(train), 0, *(n[w] for w in words)])
    followed = np.where(np.arange(len(counts)) == START, len(train), np.where(np.arange(len(counts)) == 2, 0, counts))
    whole, rows = float(n.total()), []
    for times in (1, 4):
        docs = make_docs(texts * times).repartition(4).select(F.col("doc_id").alias("key"), held_out("doc_id").alias("held_out"), F.encode("text", "utf-8").alias("text"))
        deal = Dealing(counts * times, followed * times, 16, 100 * times, 1.0)
        vocabulary, dealing = spark.sparkContext.broadcast(Vocabulary([w.encode() for w in words])), spark.sparkContext.broadcast(deal)
        seen = noted(docs, vocabulary, dealing, 100 * times).persist()
        hot = seen.selectExpr("inline(triples)").groupBy("a", "b").agg(F.sum("n").alias("n")).filter(f"n > {50 * times}").collect()
        deal = Dealing(counts * times, followed * times, 16, 100 * times, 1.0)
        deal.set_contexts([r["a"] * len(counts) + r["b"] for r in hot], [r["n"] for r in hot])
        dealing = spark.sparkContext.broadcast(deal)
        once = spark.createDataFrame([(i, n[w] * times) for w, i in rare.items()], "id bigint, n bigint")
        notes = seen.filter("data IS NOT NULL").select("shard", "data").unionByName(noted_words(once, 16))
        got = told_counts(notes, spark.sparkContext.broadcast(counts * times), dealing, whole).collect()
        rows.append(len(got))
        told = {(r["shard"], *map(int, x[:4])): int(x[4]) for r in got if r["data"] for x in _uncrushed(r["data"], TOLD)}
        of = {(r["shard"], *map(int, x[1:3])): int(x[3]) for r in got if r["data"] for x in _uncrushed(r["data"], TOLD) if x[0] == ANY}
        assert of and all(twos[name[b], name[c]] * times == k for (_, b, c), k in of.items())
        assert all(m == (n[name[c]] * times if c >= RARE else 0) for (_, a, _, c, _), m in told.items() if a in (0, ANY))
        met = 0
        for r in sent_tokens(docs, vocabulary, dealing).filter("keys IS NULL").collect():
            hashes, places, _ = _unpacked(r["data"])
            _, b, c = np.where(places < len(counts), places, np.append(hashes, 0)[np.maximum(places - len(counts), 0)]).reshape(3, -1).tolist()
            for x, y in zip(b, c):
                if deal.of(np.array([x]))[1][0] > 1 and twos[name[x], name[y]]:
                    assert (r["shard"], x, y) in of
                    met += 1
                elif y >= RARE and n[name[y]]:
                    assert (r["shard"], 0, 0, y, 0) in told or (r["shard"], ANY, x, y, 0) in told
        sums = Counter()
        for r in got:
            for x in r["sums"] or []:
                sums[x["b"], "n"] += x["n"]
                sums[x["b"], "m"] += x["m"]
        for b in {b for _, b, _ in of}:
            follow = [k for (x, _), k in twos.items() if x == name[b]]
            assert (sums[b, "n"], sums[b, "m"]) == (sum(follow) * times, len(follow))
        assert hot and met > 3000 * times
        seen.unpersist()
    assert rows[1] <= rows[0] * 1.1 and rows[0] <= 16 * 16 + 16


def test_counts_of_spread_words_are_not_kept_as_rows(make_docs, spark):
    """What is written down between jobs are packed tables, far fewer rows than tokens."""
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("settled-*"))
    draw = np.random.default_rng(9)
    texts = [(k, " ".join(draw.choice([f"w{i}" for i in range(40)], 100))) for k in range(200)]
    assert score_texts(make_docs(texts), shard_tokens=400).count() == 200
    rows = sum(pq.read_metadata(part).num_rows for made in set(folder.glob("settled-*")) - before for part in made.glob("*.parquet"))
    assert 0 < rows < 200 * 100 / 4


def test_scores_with_text_keys(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", None), (None, "one")], "doc_id string, text string")
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in score_texts(docs).collect()} == {("a", 3, 3, 6), ("b", 1, 1, 6), (None, 2, 2, 6)}


def test_hidden_elements_end_with_their_parent():
    assert texts("<p>so <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> holds</p>") == ["so x = 2 holds"]
    assert texts("<p>see <object data=x>the drawing</object> here</p>") == ["see the drawing here"]
    assert texts("<p>an <svg><title>icon</title><path d='M0'/></svg> here</p><p>b</p>") == ["an here", "b"]
    for tag in ("svg", "template", "noscript", "iframe"):
        assert texts(f"<div><p>a <{tag}>gone<p>gone</p></div><p>stays</p>") == ["a", "stays"]
    assert texts("<p>a<script>b<p>c</p>") == ["a"]  # as in browsers
    long = Block(("in:p",), "p", "1" * 100 + " word" * 200, 0.0)
    assert "digits" not in text_features(long)
