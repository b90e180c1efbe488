"""Token counts by a two-tier lookup of pre-token lengths, without any shuffle.

Tier one is a bounded table of frequent pre-tokens and their numbers of tokens, made from a bounded
sample of rows and broadcast. Tier two is a cache in each Python worker, filled by the tokenizer
when a pre-token is met first. The table only saves work: counts are the tokenizer's own whatever it
holds.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from vectable.llm.common import as_text, values

# The pre-token pattern of byte-level tokenizer files with "use_regex" (fixed value).
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SAMPLE_ROWS = 2_000
SAMPLE_TEXT = 1 << 16
FREQUENT = 32_768
FREQUENT_BYTES = 1 << 20
CACHED = 300_000


class PieceLengths(dict):
    """Pre-token -> number of tokens; asks the tokenizer on a miss. Starts again from the frequent
    ones when it holds ``cached`` entries more than those."""

    def __init__(self, measure: Callable[[str], int], frequent: dict[str, int], cached: int = CACHED):
        super().__init__(frequent)
        self.measure, self.cached = measure, cached
        self.prefer(frequent)

    def prefer(self, frequent: dict[str, int]) -> None:
        """Set the pieces that are never forgotten."""
        self.frequent, self.limit = frequent, len(frequent) + self.cached
        self.update(frequent)

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.limit:
            self.clear()
            self.update(self.frequent)
        self[piece] = n = self.measure(piece)
        return n


class TokenCounter:
    """Counts tokens of whole texts for a byte-level tokenizer file."""

    def __init__(self, path: str, frequent: dict[str, int], cached: int = CACHED):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space"):
            raise ValueError("pre-token lookup needs a byte-level tokenizer without normalizer or prefix space")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take neighbouring text are not supported")
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.lengths = PieceLengths(lambda piece: len(tokenizer.encode(piece, add_special_tokens=False).ids), frequent, cached)
        self.pieces = regex.compile(PRE_TOKEN).findall
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def __call__(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        # A special string inside a text is one token and ends the text before it.
        return len(parts) - 1 + sum(sum(map(self.lengths.__getitem__, self.pieces(part))) for part in parts)


def frequent_pieces(
    docs: DataFrame, path: str, text: str = "text", *, rows: int = SAMPLE_ROWS, size: int = FREQUENT, weight: int = FREQUENT_BYTES
) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in the first ``rows`` texts of at most ``SAMPLE_TEXT`` bytes: at
    most ``size`` of them with at most ``weight`` UTF-8 bytes, so sample and broadcast are bounded."""
    counter, seen = TokenCounter(path, {}), Counter()
    for row in docs.select(F.col(text).alias("text")).filter(F.octet_length("text") <= SAMPLE_TEXT).take(rows):
        seen.update(counter.pieces(row["text"]))
    kept, used = {}, 0
    for piece, _ in seen.most_common(size):
        used += len(piece.encode())
        if used > weight:
            break
        kept[piece] = counter.lengths[piece]
    return kept


@lru_cache(maxsize=2)
def worker_counter(path: str, cached: int) -> TokenCounter:
    """One per Python worker, so that the tasks a worker runs share what it has encoded."""
    return TokenCounter(path, {}, cached)


def token_count(path: str, frequent: dict[str, int], spark, cached: int = CACHED) -> Callable[[Column], Column]:
    """Column function: number of tokens of a text."""
    shared = spark.sparkContext.broadcast(frequent)

    @F.arrow_udf("bigint")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = worker_counter(path, cached)
        counter.lengths.prefer(shared.value)
        for batch in batches:
            yield pa.array([counter(value) for value in values(batch)], pa.int64())

    return n_tokens


def count_tokens(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", limit: int = 512, frequent: dict[str, int] | None = None
) -> DataFrame:
    """Per row of ``docs``: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    One row per input row, repeated and NULL keys included. A NULL or empty text has no bytes and no
    tokens. An empty table gives an empty result. Other columns of ``docs`` are not read. Special
    strings inside a text count as their one token, which is the tokenizer's default.
    """
    frequent = frequent_pieces(docs, path, text) if frequent is None else frequent
    count = token_count(path, frequent, docs.sparkSession)
    rows = docs.select(F.col(key), as_text(text).alias("__text"))
    counted = rows.select(F.col(key), F.octet_length("__text").cast("bigint").alias("n_bytes"), count("__text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
