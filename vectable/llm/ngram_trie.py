"""A trigram trie of some words: Elias-Fano levels, context-relative ids and quantised smoothed probabilities.

Level 1 has the words b that the trie is about. Level 2 holds what follows them, pairs (b, c) as b * width + c, which
rises along the level; pointers, rising too, tell where each b begins. Beside it stand the contexts (a, b) as
b * width + a. Level 3 holds triples (a, b, c) as the place of their context times a span, plus the rank of c among the
successors of b in level 2: if (a, b, c) occurs, so does (b, c), and this rank is far smaller than an id.
"""

from __future__ import annotations

import numpy as np

from vectable.llm.elias_fano import EliasFano, to_bytes

DISCOUNT = 0.75
CODES = 255
LEAST = 1e-9


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of one byte and the table of their values: means of bins with equally many different values,
    so that few values are exact and rare ones keep bins of their own."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.float32)
    edges = np.unique(np.quantile(np.unique(values), np.linspace(0, 1, CODES + 1)[1:-1]))
    codes = np.searchsorted(edges, values, side="right")
    count = np.bincount(codes, minlength=len(edges) + 1)
    total = np.bincount(codes, values, len(edges) + 1)
    return codes.astype(np.uint8), np.where(count > 0, total / np.maximum(count, 1), 0).astype(np.float32)


def _back_off(times: np.ndarray, different: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """log10 of the weight of each context: the mass that its discounts leave, over the mass that the lower order
    has beside its successors."""
    return np.log10(np.maximum(DISCOUNT * different / times, LEAST) / np.maximum(1 - lower, LEAST))


def build(
    width: int, pairs: np.ndarray, times: np.ndarray, pair: np.ndarray, a: np.ndarray, n: np.ndarray, first: np.ndarray,
    spread: tuple[np.ndarray, ...] = (),
) -> bytes:
    """The trie as bytes. Ids are under ``width``.

    ``pairs``: sorted distinct codes b * width + c of all that follows each b, and ``times`` they occur. Triples are the
    place of their (b, c) in ``pairs``, their ``a`` and how often they occur (``n``), sorted by place and a.
    ``first``: the probability of each id by itself. ``spread``: words b of which only some pairs are here, and over all their pairs
    how many tokens, different successors and what sum of ``first`` they have.
    """
    b, c = np.divmod(pairs, max(width, 1))
    roots = np.union1d(b, spread[0]).astype(np.int64) if spread else np.unique(b)
    start = np.append(np.searchsorted(b, roots), len(pairs))
    followers = np.diff(start)
    root = np.repeat(np.arange(len(roots)), followers)
    whole, lower = np.bincount(root, times, len(roots)), np.bincount(root, first[c], len(roots))
    different = followers.copy()
    if spread:
        at = np.searchsorted(roots, spread[0])
        whole[at], different[at], lower[at] = spread[1:]
    own2 = (times - DISCOUNT) / whole[root]
    back1 = _back_off(whole, different, lower)
    contexts, context = np.unique(b[pair] * width + a, return_inverse=True)
    rank = pair - start[root[pair]]
    span = int(rank.max()) + 1 if len(rank) else 1
    given = np.bincount(context, n, len(contexts))
    back2 = _back_off(given, np.bincount(context, minlength=len(contexts)), np.bincount(context, own2[pair], len(contexts)))
    level3 = context * span + rank
    order = np.argsort(level3)
    own3 = (n[order] - DISCOUNT) / given[context[order]]
    arrays = {"shape": np.array([width, span]), "back1": back1.astype(np.float32)}
    levels = {"roots": roots, "start": start, "follows": pairs, "contexts": contexts, "level3": level3[order]}
    for name, sequence in levels.items():
        arrays |= {f"{name}.{k}": v for k, v in EliasFano.of(sequence).arrays().items()}
    for name, values in (("own2", np.log10(own2)), ("back2", back2), ("own3", np.log10(own3))):
        arrays[f"{name}.codes"], arrays[f"{name}.table"] = quantise(values)
    return to_bytes(arrays)


class Trie:
    """Log10 probabilities from mapped arrays."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        def part(name: str) -> dict[str, np.ndarray]:
            return {k.removeprefix(f"{name}."): v for k, v in arrays.items() if k.startswith(f"{name}.")}

        self.width, self.span = (int(x) for x in arrays["shape"])
        self.back1 = arrays["back1"]
        self.roots, self.start, self.follows, self.contexts, self.level3 = (
            EliasFano.from_arrays(part(n)) for n in ("roots", "start", "follows", "contexts", "level3")
        )
        self.own2, self.back2, self.own3 = (part(n) for n in ("own2", "back2", "own3"))

    @staticmethod
    def _value(part: dict[str, np.ndarray], index: np.ndarray) -> np.ndarray:
        return part["table"][part["codes"][index]].astype(np.float64)

    def pairs(self, b: np.ndarray, c: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of c among the successors of b, -1 if it never follows; and log10 P(c | b), where ``first`` is log10 P(c)."""
        root, place = self.roots.find(b), self.follows.find(b * self.width + c)
        out, rank = np.array(first, np.float64), np.full(len(b), -1, np.int64)
        known = np.flatnonzero(root >= 0)
        out[known] += self.back1[root[known]]
        there = np.flatnonzero(place >= 0)
        out[there] = self._value(self.own2, place[there])
        rank[there] = place[there] - self.start.get(root[there]).astype(np.int64)
        return rank, out

    def triples(self, a: np.ndarray, b: np.ndarray, rank: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 P(c | a, b) from what ``pairs`` gives for (b, c)."""
        context = self.contexts.find(b * self.width + a)
        out = np.array(lower, np.float64)
        known = np.flatnonzero(context >= 0)
        out[known] += self._value(self.back2, context[known])
        both = known[rank[known] >= 0]
        found = self.level3.find(context[both] * self.span + rank[both])
        hit = found >= 0
        out[both[hit]] = self._value(self.own3, found[hit])
        return out
