"""Token counts and byte-level BPE against the tokenizer libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from vectable.llm import queries
from vectable.llm.byte_bpe import LONGEST_CACHED, PieceCache, PrefixBpe, PrefixTable, coder, decoder, encode_texts, read_ranks
from vectable.llm.common import ROWS_AT_ONCE
from vectable.llm.token_counts import PieceLengths, TokenCounter, count_tokens, frequent_pieces

JSON, RANKS = queries.JSON_TOKENIZER, queries.RANKS


@pytest.fixture(scope="module")
def bpe():
    return PrefixBpe(read_ranks(RANKS))


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_tokenizer(spark, sf_dir, real_docs):
    tokenizer = Tokenizer.from_file(JSON)
    rows = queries.op5_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(real_docs)
    for r in rows:
        n = len(tokenizer.encode(real_docs[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(real_docs[r["doc_id"]].encode()), n, n > 512)


def test_counts_of_odd_rows(odd_docs, odd_rows):
    tokenizer = Tokenizer.from_file(JSON)
    want = sorted((str(i), len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows)
    got = count_tokens(odd_docs, JSON)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == want
    assert count_tokens(odd_docs.limit(0), JSON).count() == 0


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", "x  <|endoftext|> \n y", "<|endoftext|><|endoftext|>", "<|endoftext|"])
def test_special_strings_count_as_the_library_does(text):
    counter = TokenCounter(JSON, {})
    assert counter(text) == len(Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids)


def test_lookup_starts_again_when_full():
    asked = []
    lengths = PieceLengths(lambda piece: asked.append(piece) or len(piece), {"often": 5}, 2)
    assert [lengths[p] for p in ("often", "a", "bb", "ccc", "a", "often")] == [5, 1, 2, 3, 1, 5]
    assert asked == ["a", "bb", "ccc", "a"]


def test_frequent_pieces_are_bounded(make_docs):
    docs = make_docs([(1, "b b b a a c"), (2, "z" * 70_000)])
    assert frequent_pieces(docs, JSON, size=2) == {" b": 1, " a": 1}
    assert frequent_pieces(docs, JSON, weight=3) == {" b": 1}


def test_encoding_equals_the_library(spark, sf_dir, real_docs, library):
    rows = queries.op9_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(real_docs)
    for r in rows:
        text = real_docs[r["doc_id"]]
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encoding_of_odd_rows(odd_docs, odd_rows, library):
    got = encode_texts(odd_docs, RANKS, public_tokenizers.PATTERN)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd_rows)
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in got.collect()) == want
    assert encode_texts(odd_docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoder(spark):
    rows = spark.createDataFrame([(1, [262, 3797]), (2, []), (3, None)], "k int, ids array<int>")
    got = {r["k"]: r["d"] for r in rows.select("k", decoder(RANKS)("ids").alias("d")).collect()}
    token = {v: k for k, v in read_ranks(RANKS).items()}
    assert got[1] == token[262] + token[3797] and got[2] == b"" and got[3] is None


def test_prefix_table_holds_the_encoding_of_every_prefix(bpe, library):
    data = "the unbelievable thththonont naïve 東京 aaaaaaaaaaaa".encode()
    table = PrefixTable(bpe, data)
    for end in range(len(data) + 1):
        assert bpe.walk(table.last[:end]) == library._encode_single_piece(data[:end]) if end else True


def test_appends_and_edits_are_exact(bpe):
    draw = random.Random(3)
    table = PrefixTable(bpe, b" the quick brown fox" * 40)
    for _ in range(60):
        start = draw.randrange(len(table.data) + 1)
        stop = min(len(table.data), start + draw.randrange(8))
        made = table.edit(start, stop, draw.choice([b"", b"e", b" over", b"\xff\x00", b"aaaa"]))
        assert table.ids() == PrefixTable(bpe, table.data).ids()
        assert made <= len(table.data) - start
        table.append(draw.choice([b"", b"s", b" and"]))
        assert table.ids() == PrefixTable(bpe, table.data).ids()
    assert table.edit(0, 0, b"x") < len(table.data)


def test_cache_keeps_what_is_in_use(bpe):
    cache = PieceCache(bpe, 2)
    pieces = regex.findall(public_tokenizers.PATTERN, "one two one three one two four")
    assert [cache[p] for p in pieces] == [tuple(bpe.encode(p.encode())) for p in pieces]
    assert len(cache) <= 2


def test_vocabulary_without_a_byte_fails(bpe):
    with pytest.raises(ValueError, match="no token"):
        PrefixBpe({b"a": 0}).encode(b"ab")


def test_a_task_holds_ids_of_few_rows(spark, library):
    texts = [f"text {i} of a batch" for i in range(1_000)]
    parts = list(coder(RANKS, public_tokenizers.PATTERN).func(iter([pa.array(texts), pa.array([], pa.string())])))
    assert max(len(p) for p in parts) <= ROWS_AT_ONCE
    assert [r["ids"] for p in parts for r in p.to_pylist()] == [library.encode(t) for t in texts]


def test_rows_keep_their_ids_beyond_a_part_of_a_batch(spark, library):
    rows = [(i, f"text {i} of a batch") for i in range(3 * ROWS_AT_ONCE + 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: (list(r["ids"]), bytes(r["decoded"])) for r in encode_texts(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {i: (library.encode(t), t.encode()) for i, t in rows}


def test_long_pieces_are_not_kept(bpe):
    cache = PieceCache(bpe)
    long = "x" * (LONGEST_CACHED + 1)
    assert cache[long] == tuple(bpe.encode(long.encode())) and cache["x"] and list(cache) == ["x"]
