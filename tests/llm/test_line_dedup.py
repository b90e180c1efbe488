"""Line dedup against a plain alignment of every document with every earlier one."""

import random
from collections import Counter

import pytest

from vectable.llm import queries
from vectable.llm.line_dedup import aligned_lines, dedup_lines, longest_rise, runs


def word_lines(text):
    return [(n, line) for n, line in enumerate((text or "").split("\n")) if line.encode().split()]


def size(line):
    return len(line.encode().split())


def shared(later, earlier):
    """All lines of ``later`` inside a block of ten words or more that ``earlier`` has too: by trying every pair of places."""
    a, b = word_lines(earlier), word_lines(later)
    found = set()
    places = {}
    for j, (_, line) in enumerate(a):
        places.setdefault(line, []).append(j)
    for i, (_, line) in enumerate(b):
        for j in places.get(line, ()):
            if i and j and b[i - 1][1] == a[j - 1][1]:
                continue  # part of a block that was met before
            length = 0
            while i + length < len(b) and j + length < len(a) and b[i + length][1] == a[j + length][1]:
                length += 1
            if sum(size(x) for _, x in b[i : i + length]) >= 10:
                found |= {n for n, _ in b[i : i + length]}
    return found


def removed(out_text, text):
    """Which lines with words went, by matching what is left from the front."""
    left, gone = (out_text or "").split("\n"), set()
    at = 0
    for n, line in enumerate((text or "").split("\n")):
        if at < len(left) and left[at] == line:
            at += 1
        elif line.encode().split():
            gone.add(n)
    return gone


def measure(pairs, out):
    """(lines found, lines to find, lines cut that no earlier document has in a block)."""
    texts = {k: t for k, t in out}
    hit = want = wrong = 0
    rows = sorted((k, t or "") for k, t in pairs)
    for i, (k, text) in enumerate(rows):
        due = set()
        for other, earlier in rows[:i]:
            if other < k:
                due |= shared(text, earlier)
        lines = text.split("\n")
        gone, left = removed(texts[k], text), Counter(x for x in (texts[k] or "").split("\n"))
        cut = Counter(lines[n] for n in range(len(lines)) if lines[n].encode().split()) - left
        due_lines = Counter(lines[n] for n in due)
        hit += sum((cut & due_lines).values())
        want += sum(due_lines.values())
        wrong += sum((cut - due_lines).values())
        assert len(gone) >= 0
    return hit, want, wrong


def cut_texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_whole_table_against_every_earlier_document(spark, sf_dir, real_docs):
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    hit, want, wrong = measure(list(real_docs.items()), cut_texts(out))
    assert want > 0 and hit >= 0.97 * want and wrong == 0
    rows = out.select("n_removed").collect()
    assert queries.op6_line_dedup(spark, sf_dir).agg({"n_removed": "sum"}).first()[0] == sum(r["n_removed"] for r in rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(make_docs, seed):
    draw = random.Random(seed)
    lines = [f"this is line {i} of a few" for i in range(12)] + ["", "short", "five words are just enough", "a b c d e", "three word line"]
    blocks = [[draw.choice(lines) for _ in range(draw.randrange(2, 6))] for _ in range(8)]
    rows = [(k, "\n".join(sum(draw.choices(blocks, k=draw.randrange(4)), [f"own words of document {k}"]))) for k in range(60)]
    hit, want, wrong = measure(rows, cut_texts(dedup_lines(make_docs(rows))))
    assert want > 100 and hit >= 0.9 * want and wrong == 0


def result(make_docs, rows):
    return {r["doc_id"]: r for r in dedup_lines(make_docs(rows)).collect()}


def test_a_list_of_short_lines_goes(make_docs):
    text = "\n".join(f"item number {i} here" for i in range(40))
    got = result(make_docs, [(1, text), (2, "before it\n" + text + "\nafter it")])
    assert got[2]["text"] == "before it\nafter it" and got[2]["n_removed"] == 40 and got[1]["text"] == text


def test_lines_with_different_first_holders_go_together(make_docs):
    one, two = "the first of two lines here", "the second of two lines here"
    got = result(make_docs, [(1, one), (2, two), (3, f"{one}\n{two}"), (4, f"{one}\n{two}")])
    assert got[4]["text"] == "" and got[3]["n_removed"] == 0


def test_a_copy_goes_with_its_heading_and_blank_lines(make_docs):
    text = "Title\n\nthe body of the text has more than ten words in it\n\nEnd\n"
    got = result(make_docs, [(1, text), (2, text), (3, "\n\n" + text)])
    assert got[2]["text"] == "" and got[3]["text"] == "" and got[1]["text"] == text


def test_a_run_at_the_end_of_a_block(make_docs):
    block = "a line that has ten words or even more of them\ntail"
    got = result(make_docs, [(1, f"{block}\nother end"), (2, f"{block}\nnot the same")])
    assert got[2]["text"] == "not the same"


def test_less_than_a_block_stays(make_docs):
    got = result(make_docs, [(1, "nine words are in this line and no more"), (2, "nine words are in this line and no more")])
    assert got[2]["n_removed"] == 0


def test_odd_rows(odd_docs, odd_rows):
    out = dedup_lines(odd_docs)
    assert set(odd_docs.columns) < set(out.columns)
    found = {(r["doc_id"], r["n_removed"]) for r in out.collect()}
    assert (1, 0) in found and (2, 1) in found and (2, 0) in found and (None, 0) in found
    assert out.count() == len(odd_rows)
    assert dedup_lines(odd_docs.limit(0)).count() == 0
    for name in ("row", "cut", "spans", "hash", "n_lines"):  # names used inside
        clash = dedup_lines(odd_docs.withColumnRenamed("key", name))
        assert {(r["doc_id"], r["n_removed"]) for r in clash.collect()} == found
        assert (name in clash.columns) and (name == "n_lines" or {r[name] for r in clash.collect()} == {"x"})


def test_runs_cover_every_block():
    draw = random.Random(1)
    for _ in range(200):
        sizes = [draw.randrange(0, 14) for _ in range(draw.randrange(1, 12))]
        text = "\n".join(" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate(sizes))
        found = runs(text.encode())
        lines = [i for i, n in enumerate(sizes) if n]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(sizes[i] for i in lines[a : b + 1]) < 10:
                    continue
                inside = set()
                for _, _, _, _, line, end in found:
                    own = [i for i in lines if line <= i < end]
                    if own[0] >= lines[a] and own[-1] <= lines[b]:
                        inside |= set(own)
                assert inside == set(lines[a : b + 1])


def test_alignment_rises_in_both():
    def match(place, place_a, line):
        return {"place": place, "line": line, "end": line + 2, "place_a": place_a}

    assert aligned_lines([match(0, 10, 0), match(2, 12, 1)]) == [0, 3]
    assert aligned_lines([match(0, 10, 0), match(2, 6, 1), match(4, 8, 5)]) == [1, 3, 5, 7]
    assert aligned_lines([]) == []
    assert longest_rise([3, 1, 2, 5, 4]) == [1, 2, 4]


def test_python_runs_once(make_docs, plan_of):
    out = dedup_lines(make_docs([(1, "a"), (2, "b")]))
    left = out.filter("n_removed = 0 OR text <> ''")
    assert plan_of(left).split("(1)")[0].count("ArrowEvalPython") == 1
