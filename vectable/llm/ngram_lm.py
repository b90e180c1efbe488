"""Scores of a language model that learns from the table it scores.

The model is a back-off trigram model over all words and all n-grams of the training texts, with absolute discounting.
Texts are read in slices. Every token goes, packed with its two predecessors, to the shard of its middle word: all pairs
(b, c) and triples (a, b, c) of a word b meet there, so a shard counts them, builds an Elias-Fano trie with its back-off
weights in a memory map, asks it for every n-gram it was sent and answers each slice with one packed row. The answers
of a slice are added up in its own group. Nothing of the model is gathered, and shards grow in number, not in size:

* Words with at least ``KNOWN_SHARE`` of all tokens (1 / KNOWN_SHARE at most) are broadcast with their counts. The counts of
  the others come to the shards that need them by a join; those words are too rare to be hot.
* A word b with over half of a shard's tokens (and, where even rare words may have so many, every rare one) is spread
  over several shards by a. Its pairs are then counted before, summed by task first; a shard is told the pairs that it meets,
  and one row with what the back-off weight needs of all others, so copies never outnumber the tokens.
* A context (a, b) that has so many tokens itself is spread evenly over as many of these shards as its tokens need; they are
  told all its counted triples, and their pairs. A text's first token has no a, so it is spread evenly as well.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vectable.llm.common import as_bytes, release_shuffles, values
from vectable.llm.elias_fano import map_bytes
from vectable.llm.ngram_trie import Trie, build
from vectable.sources.tables import drop_settled, settle

KNOWN_SHARE = 2.0**-20
WORDS_HELD = 250_000
TOKENS_AT_ONCE = 500_000
TOKENS_A_SHARD = 500_000
ROWS_PACKED = 500_000

# Ids of no word, of a text's start, of its end, and of any word; frequent words follow, and the others are hashes.
NONE, START, END, ANY, WORDS = 0, 1, 2, 3, 4
RARE = 1 << 61
EVERY = -1  # the part of a pair that all shards of its word may meet
MASS = 60  # probabilities are summed in units of 2^-MASS


class Vocabulary(dict):
    """Ids of words: those of frequent ones, and new ones from ``size`` on for others, kept in ``rare`` until it is cleared."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(WORDS, WORDS + len(words))))
        self.size = WORDS + len(words)
        self.rare: dict[bytes, int] = {}

    def __reduce__(self):
        return Vocabulary, (list(self),)

    def __missing__(self, word: bytes) -> int:
        return self.rare.setdefault(word, self.size + len(self.rare))


def _hashes(words: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) >> 2 | RARE for w in words), np.int64, len(words))


def rare_id(word: str) -> Column:
    """The id of a word that is not frequent, as in ``_hashes``."""
    return F.shiftrightunsigned(F.xxhash64(F.col(word)), 2).bitwiseOR(F.lit(RARE))


def held_out(key: str) -> Column:
    """Rows that do not train: crc32 of the key's text leaves 2 when divided by 7. False for a NULL key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary, A-Z in lower case), n of the column ``text``; tasks add up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in values(batch.column(0)):
                seen.update(text.lower().split())
                if len(seen) > WORDS_HELD:
                    yield rows()
        yield rows()

    return texts.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def triples(texts: list[bytes], ids: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """a, b, c of every predicted token (words and ends), and its text. a is NONE for a text's first token."""
    words = [text.lower().split() for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 2)
    line = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    inside = np.ones(len(line), bool)
    inside[ends - 1] = inside[ends - sizes - 2] = False
    line[inside] = np.fromiter((i for row in words for i in map(ids.__getitem__, row)), np.int64, int(sizes.sum()))
    line[ends - 1], line[ends - sizes - 2] = END, START
    at = np.flatnonzero(line != START)
    first = line[at - 1] == START
    return np.where(first, NONE, line[at - 2]), line[at - 1], line[at], np.repeat(np.arange(len(sizes)), sizes + 1)


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with a bounded amount of text."""
    for batch in batches:
        lengths = np.cumsum(np.array(pa.compute.binary_length(batch.column(column)).to_pylist(), np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(lengths // (6 * TOKENS_AT_ONCE))) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                part = batch.slice(a, b - a)
                yield part, part.column(column).to_pylist()


def _planes(numbers: np.ndarray) -> bytes:
    # Bytes of equal weight side by side are smaller when compressed.
    return np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(4, -1).T).view(np.uint32).ravel()


def _squeeze(*parts: bytes) -> bytes:
    data = b"".join(parts)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _expand(blob: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True), np.uint8)


def _packed(ids: np.ndarray, marks: np.ndarray, size: int, hashes: np.ndarray) -> bytes:
    """Tokens of one slice for one shard. ``ids``: a, b and c one after the other; ``marks``: rising, see ``_unpacked``."""
    other = ids >= size
    rare = np.zeros(0, np.int64)
    if other.any():
        found, place = np.unique(ids[other], return_inverse=True)
        rare, ids = hashes[found - size], ids.copy()
        ids[other] = size + place
    n = len(marks)
    middles, b = np.unique(ids[n : 2 * n], return_inverse=True)  # a shard has few
    sizes = np.array([len(rare), n, len(middles)], np.int64)
    parts = np.concatenate([ids[:n], b, ids[2 * n :], np.diff(middles, prepend=0), np.diff(marks, prepend=0)])
    return _squeeze(sizes.tobytes(), np.ascontiguousarray(rare.view(np.uint8).reshape(-1, 8).T).tobytes(), _planes(parts))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of rare words; ids of a, b and c (frequent ones as they are, then places of hashes); and of each token twice
    the place of its text in the slice, plus one if the text is held out."""
    data = _expand(blob)
    rare, n, middles = data[:24].view(np.int64).tolist()
    at = 24 + 8 * rare
    hashes = np.ascontiguousarray(data[24:at].reshape(8, -1).T).view(np.int64).ravel()
    numbers = _from_planes(data[at:]).astype(np.int64)
    ids, middles, marks = np.split(numbers, [3 * n, 3 * n + middles])
    ids[n : 2 * n] = np.cumsum(middles)[ids[n : 2 * n]]
    return hashes, ids, np.cumsum(marks)


class Dealing:
    """Which shard has which token. A word's tokens begin at its ``base`` shard and are spread over ``splits`` shards; a rare
    word begins where its hash says. ``followed``: how often each frequent word is followed by a token; ``total``: all tokens, if
    more than frequent words train."""

    def __init__(self, counts: np.ndarray, followed: np.ndarray, shards: int, hot: int, rare_most: float, total: int = 0):
        self.total = total or int(counts.sum())
        self.shards, self.counts, self.followed = shards, counts, followed
        self.splits = np.minimum(shards, followed // hot + 1)
        self.base = (np.arange(len(counts), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(31)).astype(np.int64) % shards
        self.rare_splits = min(shards, int(rare_most // hot) + 1)
        self.hot = hot
        self.contexts = self.parts = np.zeros(0, np.int64)  # sorted codes a * size + b of hot contexts, and their shards

    def set_contexts(self, codes: list[int], tokens: list[int]) -> None:
        order = np.argsort(np.array(codes, np.int64))
        self.contexts, self.parts = np.array(codes, np.int64)[order], np.array(tokens, np.int64)[order] // self.hot + 1

    def spread(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Base and splits of all frequent words and then of rare ones."""
        return np.append(self.base, (hashes >> 20) % self.shards), np.append(self.splits, np.full(len(hashes), self.rare_splits))

    def of(self, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Base and splits of words, rare ones by their hash."""
        base, splits = self.spread(named)
        return tuple(np.where(named < RARE, x[np.where(named < RARE, named, 0)], x[len(self.base) :]) for x in (base, splits))

    def part(self, a: np.ndarray, splits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which of the shards of b a token goes to if its context is not hot."""
        salt = np.append(np.arange(len(self.counts)), hashes)[a].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)
        return salt.astype(np.int64) % splits

    def place(self, a: np.ndarray, b: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Shard of each token."""
        size = len(self.counts)
        base, splits = (x[b] for x in self.spread(hashes))
        more = np.flatnonzero(splits > 1)
        if not len(more):
            return base
        x, y, splits = a[more], b[more], splits[more]
        parts = np.where(x == NONE, splits, 1)
        if len(self.contexts):
            code = np.where((x < size) & (y < size), x * size + y, -1)
            at = np.searchsorted(self.contexts, code).clip(max=len(self.contexts) - 1)
            parts = np.where(self.contexts[at] == code, np.minimum(self.parts[at], splits), parts)
        base[more] += (self.part(x, splits, hashes) + more % parts) % splits
        return base % self.shards


# What is told about n-grams travels in packed tables of numbers. Columns of a note: its kind, x, b, c and n; x is the part of b's
# shards that meets a pair (b, c), the a of a triple, or the shard that wants to know the count n of a rare word c.
PAIR, TRIPLE, WANT, WORD = range(4)
NOTE = 5
TOLD = 6  # a, b, c, n, m, mass; see ``answers``


def _crushed(table: np.ndarray) -> bytes:
    """Rows of numbers, bytes of equal weight of each column side by side."""
    columns = np.ascontiguousarray(table.T).view(np.uint8).reshape(table.shape[1], -1, 8)
    return _squeeze(np.ascontiguousarray(columns.transpose(0, 2, 1)).tobytes())


def _uncrushed(blob: bytes, columns: int) -> np.ndarray:
    data = _expand(blob).reshape(columns, 8, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(data).view(np.int64).reshape(columns, -1).T


def _dealt(table: np.ndarray, shard: np.ndarray) -> list[pa.Array]:
    """Shards, and for each its rows of ``table`` in one blob."""
    order = np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")
    shards, starts = np.unique(shard[order], return_index=True)
    return [pa.array(shards, pa.int32()), pa.array([_crushed(x) for x in np.split(table[order], starts[1:])] if len(shards) else [], pa.binary())]


def _note_shard(notes: np.ndarray, shards: int) -> np.ndarray:
    """Where notes meet: those of a rare c with its count, others of a pair (b, c) with each other."""
    b, c = notes[:, 2].astype(np.uint64), notes[:, 3].astype(np.uint64)
    mixed = (b * np.uint64(0x9E3779B97F4A7C15) ^ c * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    return np.where(c >= RARE, c >> np.uint64(20), mixed).astype(np.int64) % shards


def _summed(notes: np.ndarray) -> np.ndarray:
    """Notes sorted by kind, b, c and x, equal ones as one with all their n."""
    notes = notes[np.lexsort((notes[:, 1], notes[:, 3], notes[:, 2], notes[:, 0]))]
    new = np.flatnonzero(np.append(True, (np.diff(notes[:, :4], axis=0) != 0).any(axis=1))) if len(notes) else np.zeros(0, np.int64)
    out = notes[new]
    out[:, 4] = np.add.reduceat(notes[:, 4], new) if len(new) else out[:, 4]
    return out


def _sums(keys: np.ndarray, *counted: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys, and sums of what is counted for each."""
    order = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.diff(keys[order], prepend=-1))
    return keys[order][new], *(np.add.reduceat(x[order], new) if len(new) else x[:0] for x in counted)


def noted(rows: DataFrame, vocabulary, dealing, bound: float) -> DataFrame:
    """What shards need beside their tokens, of ``rows`` (key, held_out, text), summed over some slices of a task. ``data``, by the
    shard where notes meet: rare words c wanted by the shard of a b that has only one; counts of the pairs of b that has more, by the
    part of its shards that meets them; and of triples whose contexts may have over ``bound`` tokens. What only held-out texts
    have is noted with a count of 0. Beside these, in a row of its own, ``triples``: how many each such context a, b has, where
    that is at least half of the bound's share of all tokens; so at most half of the bound is missing in the sum."""

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, deal = vocabulary.value, dealing.value
        size = ids.size
        common: dict[int, list] = {PAIR: [], TRIPLE: []}  # codes of frequent words only, and n
        others: list[np.ndarray] = []
        contexts: list[tuple[np.ndarray, np.ndarray]] = []
        trained = 0

        def held() -> int:
            return sum(map(len, others)) + sum(len(x) for kind in common.values() for x, _ in kind)

        def found() -> Iterator[pa.RecordBatch]:
            tables = list(others)
            for kind, codes in common.items():
                if codes:
                    code, n = _sums(*map(np.concatenate, zip(*codes)))
                    pair, c = np.divmod(code, size)
                    x, b = np.divmod(pair, size)
                    tables.append(np.column_stack([np.full(len(code), kind), x - (kind == PAIR), b, c, n]))
                codes.clear()
            others.clear()
            notes = np.concatenate(tables or [np.zeros((0, NOTE), np.int64)])
            shards, data = _dealt(notes, _note_shard(notes, deal.shards))
            yield pa.RecordBatch.from_arrays([shards, data, pa.nulls(len(shards), counted)], schema.names)
            code, n = _sums(*map(np.concatenate, zip(*contexts))) if contexts else (np.zeros(0, np.int64),) * 2
            contexts.clear()
            listed = n * 2 * deal.total >= bound * trained
            columns = (*np.divmod(code[listed], size), n[listed])
            triples = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], fields=list(counted.value_type))
            one = pa.ListArray.from_arrays(pa.array([0, len(triples)], pa.int32()), triples)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), one.cast(counted)], schema.names)

        for rows, texts in _slices(batches, 2):
            a, b, c, owner = triples(texts, ids)
            hashes = _hashes(ids.rare)
            ids.rare.clear()
            named, width = np.append(np.arange(size), hashes), size + len(hashes)
            base, splits = deal.spread(hashes)
            able = np.append(deal.followed > bound, np.zeros(len(hashes), bool))
            train = ~rows.column(1).to_numpy(zero_copy_only=False)[owner]
            trained += int(train.sum())
            alone = np.flatnonzero((c >= size) & (splits[b] == 1))
            shard, wanted = np.divmod(np.unique(base[b[alone]] * width + c[alone]), width)
            others.append(np.column_stack([np.full(len(shard), WANT), shard, np.zeros_like(shard), named[wanted], np.zeros_like(shard)]))
            more = np.flatnonzero(splits[b] > 1)
            part = np.where(a[more] == NONE, EVERY, deal.part(a[more], splits[b[more]], hashes))
            threes = more[able[a[more]] & able[b[more]]]
            for kind, at, lead in ((PAIR, more, part + 1), (TRIPLE, threes, a[threes])):
                code = np.sort(((lead * width + b[at]) * width + c[at]) * 2 + train[at])  # one sort of numbers alone
                new = np.flatnonzero(np.diff(code >> 1, prepend=-1))
                n = np.add.reduceat(code & 1, new) if len(new) else new
                pair, z = np.divmod(code[new] >> 1, width)
                x, y = np.divmod(pair, width)
                if kind == TRIPLE:
                    contexts.append(_sums(x * size + y, n))
                few = (y >= size) | (z >= size)
                common[kind].append((((x * size + y) * size + z)[~few], n[~few]))
                others.append(np.column_stack([np.full(few.sum(), kind), x[few] - (kind == PAIR), named[y[few]], named[z[few]], n[few]]))
            if held() > ROWS_PACKED:
                yield from found()
                trained = 0
        yield from found()

    counted = pa.list_(pa.struct([(name, pa.int64()) for name in "abn"]))
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("data", T.BinaryType()),
        T.StructField("triples", T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in "abn"]))),
    ])
    return rows.select("key", "held_out", "text").mapInArrow(note, schema)


def noted_words(rare: DataFrame, shards: int) -> DataFrame:
    """Counts n of rare words ``id``, packed as notes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            notes = np.concatenate(held)
            held.clear()
            return pa.RecordBatch.from_arrays(_dealt(notes, _note_shard(notes, shards)), ["shard", "data"])

        for batch in batches:
            c, n = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            held.append(np.column_stack([np.full(len(c), WORD), np.zeros_like(c), np.zeros_like(c), c, n]))
            if sum(map(len, held)) > ROWS_PACKED:
                yield rows()
        if held:
            yield rows()

    return rare.select("id", "n").mapInArrow(pack, "shard int, data binary")


def told_counts(notes: DataFrame, unigrams, dealing, whole: float) -> DataFrame:
    """``data``, for each shard what it needs of ``notes`` (shard, data): a, b, c and n of triples of hot contexts, ANY, b, c, n and the
    count m of a rare c of pairs, and c and m of other wanted words. Beside these, in a row of its own, ``sums``: of each spread
    word b how many tokens and different successors were noted here, and the probability that these have by themselves."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, deal = unigrams.value, dealing.value
        size = len(counts)
        held: list[np.ndarray] = []
        least = ROWS_PACKED
        for batch in batches:
            for blob in batch.column("data").to_pylist():
                held.append(_uncrushed(blob, NOTE))
                if sum(map(len, held)) > 2 * least:
                    held[:] = [_summed(np.concatenate(held))]
                    least = max(ROWS_PACKED, len(held[0]))
        if not held:
            return
        notes = _summed(np.concatenate(held))
        held.clear()
        ends = np.searchsorted(notes[:, 0], np.arange(PAIR, WORD + 2))
        pairs, threes, wants, words = (notes[i:j] for i, j in zip(ends, ends[1:]))

        def rare_count(c: np.ndarray) -> np.ndarray:
            if not len(words):
                return np.zeros(len(c), np.int64)
            at = np.searchsorted(words[:, 3], c).clip(max=len(words) - 1)
            return np.where(words[at, 3] == c, words[at, 4], 0)

        def spread_out(at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Each of ``at`` so many times, and which time it is."""
            return np.repeat(at, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)

        code = threes[:, 1] * size + threes[:, 2]
        if len(deal.contexts):
            context = np.searchsorted(deal.contexts, code).clip(max=len(deal.contexts) - 1)
            hot = deal.contexts[context] == code
            threes, context = threes[hot], context[hot]
        else:
            threes, context = threes[:0], code[:0]
        base, splits = deal.of(threes[:, 2])
        own = deal.part(threes[:, 1], splits, np.zeros(0, np.int64))
        at, nth = spread_out(np.arange(len(threes)), np.minimum(deal.parts[context], splits))
        part = (own[at] + nth) % splits[at]
        zero = np.zeros(len(at), np.int64)
        told = [np.column_stack([(base[at] + part) % deal.shards, threes[at, 1], threes[at, 2], threes[at, 3], threes[at, 4], zero, zero])]
        met = np.column_stack([np.full(len(at), PAIR), part, threes[at, 2], threes[at, 3], zero])

        pairs = _summed(np.concatenate([pairs, met]))
        b, c = pairs[:, 2], pairs[:, 3]
        new = np.flatnonzero(np.append(True, (np.diff(b) != 0) | (np.diff(c) != 0))) if len(pairs) else np.zeros(0, np.int64)
        n = np.add.reduceat(pairs[:, 4], new) if len(new) else new
        m = rare_count(c[new])
        own_b, own_c = b[new], c[new]
        seen = n > 0
        alone = np.where(own_c < RARE, counts[np.where(own_c < RARE, own_c, 0)], m)
        first = ((alone + 1) / whole * 2.0**MASS).astype(np.int64)
        sums = _sums(own_b[seen], n[seen], np.ones(seen.sum(), np.int64), first[seen])

        pair = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(pairs))))
        base, splits = deal.of(b)
        every = pairs[:, 1] == EVERY
        times = np.where(every, splits, 1) * ((n > 0) | (m > 0))[pair]
        at, nth = spread_out(np.arange(len(pairs)), times)
        part = np.where(every[at], nth, pairs[at, 1])
        zero = np.zeros(len(at), np.int64)
        told.append(np.column_stack([(base[at] + part) % deal.shards, np.full(len(at), ANY), b[at], c[at], n[pair[at]], m[pair[at]], zero]))

        m = rare_count(wants[:, 3])
        wants, m = wants[m > 0], m[m > 0]
        zero = np.zeros(len(wants), np.int64)
        told.append(np.column_stack([wants[:, 1], zero, zero, wants[:, 3], zero, m, zero]))
        told = np.concatenate(told)
        shards, data = _dealt(told[:, 1:], told[:, 0])
        yield pa.RecordBatch.from_arrays([shards, data, pa.nulls(len(shards), summed)], schema.names)
        one = pa.ListArray.from_arrays(pa.array([0, len(sums[0])], pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in sums], fields=list(summed.value_type)))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), one.cast(summed)], schema.names)

    names = ("b", "n", "m", "mass")
    summed = pa.list_(pa.struct([(name, pa.int64()) for name in names]))
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("data", T.BinaryType()),
        T.StructField("sums", T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in names]))),
    ])
    return notes.repartitionById(dealing.value.shards, F.col("shard")).mapInArrow(tell, schema)


def sent_tokens(rows: DataFrame, vocabulary, dealing) -> DataFrame:
    """All tokens of ``rows`` (key, held_out, text), by slice and shard; and once for each slice, with ``keys``, the keys of
    its texts and what their frequent words say, which goes to any shard."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, deal = vocabulary.value, dealing.value
        size, task = ids.size, TaskContext.get().partitionId() << 32
        logs, known = np.log10(deal.counts + 1.0), deal.counts > 0
        for number, (part, texts) in enumerate(_slices(batches, 2)):
            a, b, c, owner = triples(texts, ids)
            hashes = _hashes(ids.rare)
            ids.rare.clear()
            held = part.column(1).to_numpy(zero_copy_only=False)
            shard = deal.place(a, b, hashes)
            order = np.argsort(shard.astype(np.uint16) if deal.shards <= 1 << 16 else shard, kind="stable")
            shards, starts = np.unique(shard[order], return_index=True)
            marks = owner << 1 | held[owner]
            blobs = [_packed(np.concatenate([a[o], b[o], c[o]]), marks[o], size, hashes) for o in np.split(order, starts[1:])]
            frequent = np.flatnonzero(c < size)
            own, of = c[frequent], owner[frequent]
            home = [held.astype(np.uint8), np.bincount(owner, minlength=len(texts)), np.bincount(of, known[own], len(texts)).astype(np.int64), np.bincount(of, logs[own], len(texts))]
            rest = len(shards)
            ends = pa.array([0, *[len(part)] * (1 + rest)], pa.int32())
            keys = pa.ListArray.from_arrays(ends, part.column(0), mask=pa.array([False] + [True] * rest))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append((task + number) % deal.shards, shards), pa.int32()), pa.array(np.full(1 + rest, task | number)),
                pa.array([_squeeze(*(x.tobytes() for x in home)), *blobs], pa.binary()), keys,
            ], ["shard", "slice", "data", "keys"])

    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("slice", T.LongType()), T.StructField("data", T.BinaryType()),
        T.StructField("keys", T.ArrayType(rows.schema["key"].dataType)),
    ])
    return rows.select("key", "held_out", "text").mapInArrow(send, schema)


def followers(sums: DataFrame, dealing) -> DataFrame:
    """``data``, for each shard of a spread word: b, n, m, mass, its tokens, its different successors, and the probability that
    these have by themselves, from parts of these sums."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = dealing.value
        for batch in batches:
            b, n, m, mass = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            base, splits = deal.of(b)
            at = np.repeat(np.arange(len(b)), splits)
            part = np.arange(len(at)) - np.repeat(np.cumsum(splits) - splits, splits)
            zero = np.zeros(len(at), np.int64)
            told = np.column_stack([zero, b[at], zero, n[at], m[at], mass[at]])
            yield pa.RecordBatch.from_arrays(_dealt(told, (base[at] + part) % deal.shards), ["shard", "data"])

    added = sums.groupBy("b").agg(*(F.sum(x).alias(x) for x in ("n", "m", "mass")))
    return added.mapInArrow(tell, "shard int, data binary")


def answers(received: DataFrame, shards: int, unigrams, whole: float) -> DataFrame:
    """slice, data, keys: what each shard says about the texts of a slice, and the rows with keys as they came.
    ``received``: shard and, from ``sent_tokens``, slice, data and keys; or only data, from ``told_counts``: a, b, c, n of counted n-grams
    of hot words and contexts, or only c, both with m, the count of a rare c; or, with a mass, what ``followers`` says of b."""
    schema = received.select("slice", "data", "keys").schema

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = unigrams.value
        size = len(counts)
        slices, parts, given = [], [], [np.zeros((0, TOLD), np.int64)]
        for batch in batches:
            of_slice, home = batch.column("slice").is_valid(), batch.column("keys").is_valid()
            yield batch.filter(home).select(schema.names)
            there = batch.filter(pa.compute.and_not(of_slice, home))
            slices += there.column("slice").to_pylist()
            parts += map(_unpacked, there.column("data").to_pylist())
            given += [_uncrushed(x, TOLD) for x in batch.filter(pa.compute.invert(of_slice)).column("data").to_pylist()]
        if not parts:
            return
        told = np.concatenate(given)
        del given
        of_all = told[told[:, 5] > 0]
        rare = np.unique(np.concatenate([told[:, :3][told[:, :3] >= RARE], *(r for r, _, _ in parts)]))

        def local(named: np.ndarray) -> np.ndarray:
            return np.where(named >= RARE, size + np.searchsorted(rare, named), named)

        ids = []
        for hashes, places, _ in parts:
            other = np.flatnonzero(places >= size)
            places[other] = size + np.searchsorted(rare, hashes)[places[other] - size]
            ids.append(places.reshape(3, -1))
        a, b, c = np.concatenate(ids, axis=1)
        part = np.repeat(np.arange(len(parts)), [x.shape[1] for x in ids])
        marks = np.concatenate([m for _, _, m in parts])
        del ids, parts
        text, train = marks >> 1, marks & 1 == 0
        width = size + len(rare)
        times = np.append(counts, np.zeros(len(rare), np.int64))
        told = told[told[:, 5] == 0]
        counted = told[told[:, 4] > 0]
        times[local(counted[:, 2])] = counted[:, 4]
        first = (times + 1) / whole

        told = told[told[:, 1] > 0]
        x, y, z, n = local(told[:, 0]), local(told[:, 1]), local(told[:, 2]), told[:, 3]
        of_word = x == ANY
        pairs, pair = np.unique(np.append(b * width + c, y * width + z), return_inverse=True)
        own, extra = pair[: len(a)], pair[len(a) :]
        times2 = np.bincount(own[train], minlength=len(pairs))
        times2[extra[of_word]] = n[of_word]
        codes, code = np.unique(np.append(own * width + a, extra[~of_word] * width + x[~of_word]), return_inverse=True)
        times3 = np.bincount(code[: len(a)][train], minlength=len(codes))
        times3[code[len(a) :]] = n[~of_word]

        known2 = times2 > 0
        pair_of, lead = np.divmod(codes, width)
        known3 = (times3 > 0) & (lead != NONE)
        place = np.cumsum(known2) - 1
        spread = (local(of_all[:, 1]), of_all[:, 3], of_all[:, 4], of_all[:, 5] / 2.0**MASS)
        trie = Trie(map_bytes(build(width, pairs[known2], times2[known2], place[pair_of[known3]], lead[known3], times3[known3], first, spread)))
        middle, last = np.divmod(pairs, width)
        rank, lower = trie.pairs(middle, last, np.log10(first)[last])
        chance = trie.triples(lead, middle[pair_of], rank[pair_of], lower[pair_of])[code[: len(a)]]

        def by_text(at: np.ndarray, *summed: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
            """Sums over the tokens ``at`` of one text and part: where each part begins, texts, sums."""
            new = np.flatnonzero(np.append(True, (np.diff(text[at]) != 0) | (np.diff(part[at]) != 0))) if len(at) else at
            sums = [np.add.reduceat(s, new) if len(at) else s for s in summed]
            return np.searchsorted(part[at][new], np.arange(len(slices) + 1)), text[at][new], sums

        bounds, texts, (scores,) = by_text(np.arange(len(a)), chance)
        some = np.flatnonzero(c >= size)
        rare_bounds, rare_texts, (logs, known) = by_text(some, np.log10(times[c[some]] + 1.0), (times[c[some]] > 0).astype(np.int64))
        scores, known = scores.astype(np.float32), known.astype(np.uint32)
        said = []
        for i in range(len(slices)):
            s, r = slice(*bounds[i : i + 2]), slice(*rare_bounds[i : i + 2])
            sizes = np.array([s.stop - s.start, r.stop - r.start], np.int64)
            said.append(_squeeze(
                sizes.tobytes(), _planes(np.diff(texts[s], prepend=0)), scores[s].tobytes(),
                _planes(np.diff(rare_texts[r], prepend=0)), known[r].tobytes(), logs[r].tobytes(),
            ))
        yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int64()), pa.array(said, pa.binary()), pa.nulls(len(said), batch.column("keys").type)], schema.names)

    return received.repartitionById(shards, F.col("shard")).mapInArrow(meet, schema)


def _said(blob: bytes) -> tuple[np.ndarray, ...]:
    data = _expand(blob)
    n, r = data[:16].view(np.int64).tolist()
    ends = np.cumsum([16, 4 * n, 4 * n, 4 * r, 4 * r, 8 * r])
    texts, scores, rare, known, logs = (data[i:j] for i, j in zip(ends, ends[1:]))
    return (
        np.cumsum(_from_planes(texts).astype(np.int64)), np.frombuffer(scores.tobytes(), np.float32),
        np.cumsum(_from_planes(rare).astype(np.int64)), np.frombuffer(known.tobytes(), np.uint32), np.frombuffer(logs.tobytes(), np.float64),
    )


def _added(said: DataFrame, total: int, whole: float, key: str) -> DataFrame:
    """Per text its counts and scores: each slice adds up what the shards said about its texts."""
    out = T.StructType([
        T.StructField(key, said.schema["keys"].dataType.elementType), T.StructField("held_out", T.BooleanType()),
        *(T.StructField(name, T.LongType()) for name in ("n_tokens", "n_known", "train_tokens")),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def add(group: pa.Table) -> pa.Table:
        is_home = pa.compute.is_valid(group.column("keys"))
        home = group.filter(is_home)
        keys = pa.compute.list_flatten(home.column("keys")).combine_chunks()
        n = len(keys)
        data = _expand(home.column("data")[0].as_py())
        held, rest = data[:n].astype(bool), np.frombuffer(data[n:].tobytes(), np.int64)
        tokens, known, logs = rest[:n], rest[n : 2 * n].copy(), rest[2 * n :].view(np.float64).copy()
        score = np.zeros(n)
        for blob in group.filter(pa.compute.invert(is_home)).column("data").to_pylist():
            texts, scores, rare, rare_known, rare_logs = _said(blob)
            score[texts] += scores
            known[rare] += rare_known
            logs[rare] += rare_logs
        return pa.table(
            [keys, pa.array(held), pa.array(tokens), pa.array(known), pa.array(np.full(n, total)), pa.array(logs - tokens * np.log10(whole)), pa.array(score)],
            names=out.names,
        )

    return said.groupBy("slice").applyInArrow(add, out)


def score_texts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shard_tokens: int = TOKENS_A_SHARD) -> DataFrame:
    """Per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    All rows but the held-out ones train, repeated ones as often as they occur. A token is a word with A-Z
    in lower case, or the end of a text; a NULL or empty text is one end. Keys may have any type; a NULL key trains and is not
    held out. base_score: sum of log10((c + 1) / (N + V + 1)). Without training rows all counts are
    zero, and score is base_score. An empty table gives an empty result. Other columns are not read. Rare words are
    told apart by 61 bits of a hash. ``shard_tokens``: about how many tokens meet in one task.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), as_bytes(text).alias("text"))
    training = rows.filter("NOT held_out")
    counts = settle(word_counts(training))
    ends = training.count()
    of_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total = of_words + ends
    whole = float(total + distinct + (ends > 0) + 1)
    least = max(1, KNOWN_SHARE * total)
    frequent = counts.filter(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])  # small ids are packed better
    n = np.array([0, 0, ends, 0, *frequent["n"].to_pylist()], np.int64)
    followed = n.copy()
    followed[START], followed[END] = ends, 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // shard_tokens + 1)
    hot = max(1, shard_tokens // 2)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(frequent["word"].to_pylist()))
    deal, bound = Dealing(n, followed, shards, hot, least, total), max(hot, least)
    release_shuffles(spark)
    seen = settle(noted(rows, vocabulary, spark.sparkContext.broadcast(deal), bound))
    # 2 / KNOWN_SHARE contexts at most; each has up to half of the bound beside what is listed.
    contexts = seen.selectExpr("inline(triples)").groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") > bound / 2).toArrow()
    deal = Dealing(n, followed, shards, hot, least, total)
    codes = [a * len(n) + b for a, b in zip(contexts["a"].to_pylist(), contexts["b"].to_pylist())]
    deal.set_contexts(codes, [x + int(bound / 2) for x in contexts["n"].to_pylist()])
    unigrams, dealing = spark.sparkContext.broadcast(n), spark.sparkContext.broadcast(deal)

    rare = counts.filter(F.col("n") < least).select(rare_id("word").alias("id"), "n")
    notes = seen.filter("data IS NOT NULL").select("shard", "data").unionByName(noted_words(rare, shards))
    told = settle(told_counts(notes, unigrams, dealing, whole))
    for used in (seen, counts):
        drop_settled(used)
    release_shuffles(spark)
    received = sent_tokens(rows, vocabulary, dealing)
    for more in (told.filter("data IS NOT NULL").select("shard", "data"), followers(told.selectExpr("inline(sums)"), dealing)):
        received = received.unionByName(more, allowMissingColumns=True)
    return _added(answers(received, shards, unigrams, whole), total, whole, key)
