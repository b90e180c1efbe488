"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of every byte prefix is unique, and so is its last token. A table with the last
token of each prefix is therefore a whole encoding: walk back from the end. A token may end a prefix
when the prefix before it has an encoding whose last token stays apart from it, that is, when the
merges over both tokens' bytes give back those two tokens. Appending bytes only adds entries, and an
edit changes entries near it: once as many entries as the longest token has bytes agree with the old
ones, all later ones do.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from vectable.llm.common import ROWS_AT_ONCE, as_text, long_list, values

PIECES_CACHED = 150_000
LONGEST_CACHED = 100  # characters; a longer piece hardly comes again
PAIRS_CACHED = 300_000
HEAD = 6
HEADS_CACHED = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


class PrefixBpe:
    """Encodes byte strings with the ranks of a byte-level vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        # By the last two bytes of a token: the lengths that tokens with this ending have.
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            ends.setdefault(token[-2:], set()).add(len(token))
        self.single = {token for token in ranks if len(token) == 1}
        ones = {end: found | ({1} if end[-1:] in self.single else set()) for end, found in ends.items()}
        self.lengths = {end: tuple(sorted(found)) for end, found in ones.items()}
        # The tables of the first HEAD bytes, which many strings share.
        self.heads: dict[bytes, list[int]] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """The encoding by its definition: join the leftmost neighbours of lowest rank until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            found = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not found:
                return parts
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart side by side. left -1: whether right is its own encoding."""
        pair = (left + 1 << 32) + right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIRS_CACHED:
                self.pairs.clear()
            tokens = [self.token[t] for t in (left, right) if t >= 0]
            known = self.pairs[pair] = self.merged(b"".join(tokens)) == tokens
        return known

    def fill(self, data: bytes, last: list[int], stop: int) -> None:
        """Add to ``last`` the last token of each longer prefix of ``data``, up to ``stop`` bytes."""
        ranks, lengths, pairs, stays = self.ranks.get, self.lengths.get, self.pairs.get, self.stays
        for end in range(len(last) + 1, stop + 1):
            for size in lengths(data[end - 2 : end] if end > 1 else data[:1], (1,)):
                if size > end:
                    continue
                rank = ranks(data[end - size : end])
                if rank is None:
                    continue
                left = last[end - size - 1] if size < end else -1
                known = pairs((left + 1 << 32) + rank)
                if stays(left, rank) if known is None else known:
                    last.append(rank)
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")

    def walk(self, last: list[int]) -> list[int]:
        """The encoding that the table of last tokens holds."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.token[last[at - 1]])
        out.reverse()
        return out

    def encode(self, data: bytes) -> list[int]:
        if data in self.ranks and self.stays(-1, self.ranks[data]):
            return [self.ranks[data]]
        head = data[:HEAD]
        last = self.heads.get(head)
        if last is None:
            if len(self.heads) >= HEADS_CACHED:
                self.heads.clear()
            last = self.heads[head] = []
            self.fill(data, last, len(head))
        last = last.copy()
        self.fill(data, last, len(data))
        return self.walk(last)


class PrefixTable:
    """A byte string with the last token of each prefix; appends and edits keep the encoding exact."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.fill(self.data, self.last, len(self.data))

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace data[start:stop]; returns the number of table entries computed."""
        old, moved, longest = self.last, len(new) - (stop - start), self.bpe.longest
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = last = old[:start]
        edited = start + len(new)
        while len(last) < len(self.data):
            self.bpe.fill(self.data, last, min(len(self.data), len(last) + longest))
            behind = len(last) - longest
            if behind >= edited and last[behind:] == old[behind - moved : len(last) - moved]:
                break
        made = len(last) - start
        last += old[len(last) - moved :] if len(last) < len(self.data) else []
        return made

    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)


class PieceCache(dict):
    """Pre-token -> ids; encodes on a miss. When full it becomes the old generation, from which
    pieces still in use come back unencoded."""

    def __init__(self, bpe: PrefixBpe, limit: int = PIECES_CACHED):
        super().__init__()
        self.bpe, self.limit, self.old = bpe, limit, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(piece) > LONGEST_CACHED:
            return tuple(self.bpe.encode(piece.encode()))
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(piece)
        self[piece] = ids = tuple(self.bpe.encode(piece.encode())) if ids is None else ids
        return ids


@lru_cache(maxsize=2)
def worker_cache(path: str, cached: int) -> PieceCache:
    """One per Python worker, so that the tasks a worker runs share what it has encoded."""
    return PieceCache(PrefixBpe(read_ranks(path)), cached)


def encoded(texts: pa.Array, cache: PieceCache, pieces: Callable) -> pa.ListArray:
    """Token ids of each text, each of its ``pieces`` encoded separately."""
    rows = [np.fromiter(chain.from_iterable(map(cache.__getitem__, pieces(text))), np.int32) for text in values(texts)]
    return long_list(rows, pa.int32())


def decoded(ids: pa.ListArray, token: dict[int, bytes]) -> pa.Array:
    """The bytes of each list of token ids. Unknown ids raise KeyError; NULL gives NULL."""
    flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
    rows = (b"".join(map(token.__getitem__, flat[a:b].tolist())) for a, b in zip(ends, ends[1:]))
    return pa.array([row if there else None for row, there in zip(rows, ids.is_valid().to_pylist())], pa.binary())


def decoder(path: str) -> Callable:
    """Column function: the bytes of token ids."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = worker_cache(path, PIECES_CACHED).bpe.token
        for batch in batches:
            yield decoded(batch, token)

    return decode


def coder(path: str, pattern: str, cached: int = PIECES_CACHED) -> Callable:
    """Column function: ids of a text, and the bytes that these ids decode to. One function for both, as
    each has Python workers of its own, with their own caches."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache, pieces = worker_cache(path, cached), regex.compile(pattern).findall
        for batch in batches:
            for at in range(0, max(1, len(batch)), ROWS_AT_ONCE):  # a whole batch of ids and bytes would be many times its texts
                ids = encoded(batch.slice(at, ROWS_AT_ONCE), cache, pieces)
                yield pa.StructArray.from_arrays([ids, decoded(ids, cache.bpe.token)], ["ids", "decoded"])

    return encode


def encode_texts(docs: DataFrame, path: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, ids (array<int>), decoded (binary, the ids turned back into bytes).

    One row per input row, repeated and NULL keys included. A NULL or empty text has no ids and no
    bytes. An empty table gives an empty result; other columns of ``docs`` are not read.
    """
    return docs.select(F.col(key), coder(path, pattern)(as_text(text)).alias("__c")).select(key, "__c.*")
