"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

Each block is article or not. Features are the tags and names above it and a few properties of its text;
neighbouring labels are scored together. The field is trained on labelled pages by gradient ascent on the
conditional likelihood, with exact marginals by forward-backward, and decoded by Viterbi. Training takes a
bounded number of made pages of many layouts (``PAGES``), so it costs the same whatever the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vectable.llm.common import as_text, values
from vectable.llm.html_blocks import Block, blocks, labelled_pages, text_features

PAGES = 500
ROUNDS = 250
SEED = 11


@dataclass
class Field:
    """weights: feature -> score for "article"; step[a][b]: score of label b after label a."""

    weights: dict[str, float]
    bias: float
    step: list[list[float]]

    def __post_init__(self) -> None:
        self.above: dict[tuple[str, ...], float] = {}

    def score(self, block: Block) -> float:
        above = self.above.get(block.path)
        if above is None:
            if len(self.above) > 100_000:
                self.above.clear()
            above = self.above[block.path] = sum(self.weights.get(f, 0.0) for f in block.path)
        return self.bias + above + sum(self.weights.get(f, 0.0) for f in text_features(block))

    def decode(self, page: list[Block]) -> list[int]:
        """The most likely labels of a page's blocks; "not article" wins ties."""
        (aa, ab), (ba, bb) = self.step
        low, high = 0.0, 0.0
        back: list[tuple[int, int]] = []
        for n, block in enumerate(page):
            own = self.score(block)
            if not n:
                high = own
                continue
            to_low = (low + aa, 0) if low + aa >= high + ba else (high + ba, 1)
            to_high = (low + ab, 0) if low + ab >= high + bb else (high + bb, 1)
            back.append((to_low[1], to_high[1]))
            low, high = to_low[0], to_high[0] + own
        labels = [int(high > low)] if page else []
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = ROUNDS, rate: float = 0.1, ridge: float = 1e-3) -> Field:
    """Fit a field to labelled pages: all of them in each of ``rounds`` steps of Adam."""
    pages = [p for p in pages if p[0]]
    index: dict[str, int] = {}
    rows, columns, place = [], [], 0
    longest = max(len(b) for b, _ in pages)
    there = np.zeros((len(pages), longest), bool)
    gold = np.zeros((len(pages), longest), np.int64)
    for p, (found, labels) in enumerate(pages):
        there[p, : len(found)], gold[p, : len(found)] = True, labels
        for block in found:
            for feature in {*block.path, *text_features(block)}:
                rows.append(place)
                columns.append(index.setdefault(feature, len(index)))
            place += 1
    rows, columns = np.array(rows), np.array(columns)
    size = len(index)
    theta = np.zeros(size + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    pairs = there[:, 1:]
    want_own = np.append(np.bincount(columns, gold[there][rows], size), gold[there].sum())
    want_step = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)])
    for turn in range(1, rounds + 1):
        own = np.zeros(there.shape)
        own[there] = np.bincount(rows, theta[columns], place) + theta[size]
        chance, step = _marginals(own, theta[size + 1 :].reshape(2, 2), there)
        got_own = np.append(np.bincount(columns, chance[there][rows], size), chance[there].sum())
        slope = np.append(want_own - got_own, (want_step - step).ravel()) / len(pages) - ridge * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta + rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return Field({f: float(theta[i]) for f, i in index.items()}, float(theta[size]), theta[size + 1 :].reshape(2, 2).tolist())


def _marginals(own: np.ndarray, step: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 for each block, and the expected number of each pair of labels."""
    pages, longest = own.shape
    emit = np.stack([np.zeros_like(own), own], axis=2)
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = emit[:, 0]
    for t in range(1, longest):
        new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1) + emit[:, t]
        ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        new = np.logaddexp.reduce(step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where(there[:, t + 1, None], new, 0.0)
    whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
    chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole[:, None])
    joint = ahead[:, :-1, :, None] + step + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
    return chance, np.where(there[:, 1:, None, None], np.exp(joint), 0.0).sum(axis=(0, 1))


@lru_cache(maxsize=1)
def trained_field(pages: int = PAGES, seed: int = SEED) -> Field:
    return train(labelled_pages(pages, seed))


def main_text(page: str, field: Field) -> str:
    found = blocks(page, field.weights)
    return " ".join(block.text for block, label in zip(found, field.decode(found)) if label)


def extract(pages: DataFrame, *, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",), field: Field | None = None) -> DataFrame:
    """Per row of ``pages``: key, the columns ``keep``, text (the main text, empty if none), n_chars.

    Blocks have single spaces inside and are joined by one, in page order. One row per input row,
    repeated and NULL keys included; a NULL or empty page has no text, and plain text without tags is one
    block like others. An empty table gives an empty result. Other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or trained_field())

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page, shared.value) for page in values(batch)], pa.string())

    out = pages.select(key, *keep, text_of(as_text(html)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
