"""A running top-k, used inside tasks on one Arrow batch after another."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vectable.functions.vectors import row_nearness, row_norms, to_matrix
from vectable.table import COSINE, EUCLIDEAN

HAMMING = "HAMMING"  # internal: bits that differ between two packed sketches
_BLOCK = 1_000_000  # scores held at once, as several arrays of doubles
_PAIRS = 200_000  # candidate pairs that wait for a merge
_NUMBERS = 1_000_000  # vector elements of candidate pairs rescored at once, on either side
_EAGER = 20_000  # kept pairs worth an early merge
_ALIKE = 4.0  # longest row over the median one, up to which one margin serves all
WINNER_BYTES = 40  # about what one kept (query, row, nearness) takes


class RunningTopK:
    """Best k corpus rows per query over the batches of one task.

    ``near`` grows with similarity: cosine, dot product, minus the distance, minus the differing
    bits. A single-precision matrix product finds the pairs that may belong in the top k, with a
    margin above its rounding error; those pairs are then scored again in double, row by row, so the
    result is exact and equal vectors tie.
    """

    def __init__(self, metric: str, queries: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        self.metric, self.k, self.queries = metric, k, queries
        self.edge = np.full(len(queries), -np.inf) if floor is None else floor.astype(np.float64)
        self.kept: pa.Table | None = None
        self.new: list[pa.Table] = []
        self.waiting = 0
        self.side = self._side(queries)

    def _side(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows for the product, their scale). Double where single precision could over- or underflow."""
        if self.metric == HAMMING:
            return rows, np.zeros(len(rows))
        norms = row_norms(rows)
        if self.metric == COSINE:
            rows = np.divide(rows, norms[:, None], out=np.zeros_like(rows), where=norms[:, None] > 0)
            norms = np.ones(len(rows))
        moderate = norms[norms > 0]
        single = not len(moderate) or (moderate.min() > 1e-12 and moderate.max() < 1e12)
        return (rows.astype(np.float32) if single else rows), norms

    def offer(self, rows: np.ndarray, ids: pa.Array, which: np.ndarray | None = None) -> None:
        """Compare corpus rows with the queries at positions ``which`` (all by default)."""
        if not len(rows):
            return
        which = np.arange(len(self.queries)) if which is None else which
        rows, ids = self._without_surplus_copies(rows, ids)
        side = self._side(rows)
        step = max(1, _BLOCK // len(rows))
        for start in range(0, len(which), step):
            self._offer_block(rows, side, ids, which[start : start + step])
        if self.waiting >= _EAGER and not np.isfinite(self.edge[which]).all():
            self._merge()  # the sooner a k-th best is known, the fewer pairs are kept

    def _without_surplus_copies(self, rows: np.ndarray, ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Of rows with one and the same vector only the k smallest ids can win; the others need not be
        compared. Rows are matched by a 64-bit mark of their bits, then compared whole."""
        if len(rows) <= self.k:
            return rows, ids
        bits = np.ascontiguousarray(rows).view(np.uint64)
        odd = np.arange(1, 2 * bits.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        marks = (bits * odd).sum(axis=1, dtype=np.uint64)
        order = np.argsort(marks, kind="stable")
        starts = np.flatnonzero(np.r_[True, marks[order[1:]] != marks[order[:-1]]])
        ends = np.r_[starts[1:], len(rows)]
        keep = np.ones(len(rows), dtype=bool)
        for start, end in zip(starts[ends - starts > self.k], ends[ends - starts > self.k]):
            alike = order[start:end]
            alike = alike[(rows[alike] == rows[alike[0]]).all(axis=1)]
            by_id = pc.sort_indices(ids.take(pa.array(alike))).to_numpy()
            keep[alike[by_id[self.k :]]] = False
        if keep.all():
            return rows, ids
        return rows[keep], ids.filter(pa.array(keep))

    def _rough(self, rows: np.ndarray, side: tuple, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rough nearness of queries x rows, error margin per query, or per pair where the rows' lengths differ much)."""
        if self.metric == HAMMING:
            total = np.zeros((len(which), len(rows)), dtype=np.int32)
            for word in range(rows.shape[1]):
                total -= np.bitwise_count(self.queries[which, word][:, None] ^ rows[None, :, word])
            return total, np.zeros((len(which), 1))
        product = self.side[0][which] @ side[0].T
        unit = 2.0 * (rows.shape[1] + 8) * 6e-8  # bound on the relative error of a float32 dot product
        scale, row_scale = self.side[1][which][:, None], side[1][None, :]
        if self.metric == EUCLIDEAN:  # ranks by minus the squared distance
            product = 2.0 * product - (scale**2 + row_scale**2)
        if side[1].max() <= _ALIKE * np.median(side[1]):
            row_scale = side[1].max().reshape(1, 1)
        # else one very long row must not widen the margin of all others
        return product, unit * (scale + row_scale) ** 2 if self.metric == EUCLIDEAN else unit * scale * row_scale

    def _offer_block(self, rows: np.ndarray, side: tuple, ids: pa.Array, which: np.ndarray) -> None:
        rough, margin = self._rough(rows, side, which)
        edge = self.edge[which]
        if self.metric == EUCLIDEAN:
            edge = -(edge**2)
        open_ended = np.flatnonzero(~np.isfinite(edge))
        if rough.shape[1] > self.k and len(open_ended):
            cut = rough.shape[1] - self.k
            least = rough[open_ended] - margin[open_ended]
            edge[open_ended] = np.partition(least, cut, axis=1)[:, cut]
        at, row = np.nonzero(rough + margin >= edge[:, None])
        step = min(_PAIRS, max(1, _NUMBERS // rows.shape[1]))
        for start in range(0, len(at), step):
            q, r = which[at[start : start + step]], row[start : start + step]
            if self.metric == HAMMING:
                near = rough[at[start : start + step], r].astype(np.float64)
            else:
                near = row_nearness(self.metric, rows[r], self.queries[q])
            inside = near >= self.edge[q]
            q, near, r = q[inside], near[inside], r[inside]
            self.new.append(pa.table({"q": pa.array(q, pa.int64()), "near": near, "id": ids.take(pa.array(r))}))
            self.waiting += len(q)
            if self.waiting > max(self.k * len(self.queries), _PAIRS):
                self._merge()

    def _merge(self) -> None:
        parts = ([self.kept] if self.kept is not None else []) + self.new
        self.new, self.waiting = [], 0
        if not parts:
            return
        merged = pa.concat_tables(parts)
        order = pc.sort_indices(merged, sort_keys=[("q", "ascending"), ("near", "descending"), ("id", "ascending")])
        merged = merged.take(order).combine_chunks()
        q = merged.column("q").to_numpy()
        if not len(q):
            return
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        last = np.flatnonzero(place == self.k - 1)
        self.edge[q[last]] = np.maximum(self.edge[q[last]], merged.column("near").to_numpy()[last])
        self.kept = merged.take(pa.array(np.flatnonzero(place < self.k)))

    def winner_ids(self) -> np.ndarray:
        """Ids of the winners, query by query, best first."""
        self._merge()
        return np.zeros(0) if self.kept is None else self.kept.column("id").to_numpy()

    def result(self, query_ids: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The winners as (query id, row id, nearness) batches."""
        self._merge()
        if self.kept is None or not self.kept.num_rows:
            return
        kept = self.kept.combine_chunks()
        columns = [query_ids.take(kept.column("q").combine_chunks()), kept.column("id"), kept.column("near")]
        table = pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
        yield from table.to_batches(max_chunksize=100_000)


def as_matrix(column: pa.Array, metric: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, matrix) of the usable vectors, or packed sketches, in an Arrow list column."""
    if metric != HAMMING:
        return to_matrix(column, width)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    usable = np.flatnonzero(lengths == width)
    words = column.take(pa.array(usable)).flatten().to_numpy(zero_copy_only=False)
    return usable, words.view(np.uint64).reshape(len(usable), width)
