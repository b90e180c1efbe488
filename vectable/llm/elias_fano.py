"""Elias-Fano sequences: sorted integers in little more space than their gaps need, searched in place."""

from __future__ import annotations

import json
import mmap

import numpy as np

_ONE = np.uint64(1)


def _select(word: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth (from 0) set bit of each 64-bit word."""
    word, nth, place = word.copy(), nth.astype(np.int64), np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        beyond = nth >= low
        nth -= np.where(beyond, low, 0)
        word = np.where(beyond, word >> np.uint64(width), word)
        place += np.where(beyond, width, 0)
    return place


def _packed_bits(bits: np.ndarray) -> np.ndarray:
    data = np.packbits(bits, bitorder="little")
    return np.concatenate([data, np.zeros(16 - len(data) % 8, np.uint8)]).view("<u8")


def _packed_numbers(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bits of each value, one after the other, in 64-bit words."""
    out = np.zeros((len(values) * width + 63) // 64 + 2, np.uint64)
    if not width or not len(values):
        return out
    low = values & np.uint64((1 << width) - 1)
    bit = np.arange(len(values)) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[starts]] = np.bitwise_or.reduceat(low << shift, starts)
    over = np.flatnonzero(shift + np.uint64(width) > np.uint64(64))  # at most one value of a word goes on in the next
    out[word[over] + 1] |= low[over] >> (np.uint64(64) - shift[over])
    return out


class EliasFano:
    """``high``: in unary, how many values share each high part; ``low``: the lower bits, packed."""

    def __init__(self, high: np.ndarray, ones: np.ndarray, low: np.ndarray, size: int, width: int):
        self.high, self.ones, self.low, self.size, self.width = high, ones, low, size, width
        self.zeros = np.arange(len(ones)) * 64 - ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        size = len(values)
        width = max(0, int(int(values[-1] + _ONE) // size).bit_length() - 1) if size else 0
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(size)
        bits = np.zeros((int(places[-1]) if size else 0) + 2, np.uint8)
        bits[places] = 1
        high = _packed_bits(bits)
        ones = np.cumsum(np.append(0, np.bitwise_count(high[:-1]).astype(np.int64)))
        return cls(high, ones, _packed_numbers(values, width), size, width)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        bit = index * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        # Shifting in two steps, as a shift by 64 is undefined.
        value |= (self.low[word + 1] << (np.uint64(63) - shift)) << _ONE
        return value & np.uint64((1 << self.width) - 1)

    def _place(self, counts: np.ndarray, nth: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(counts, nth, side="right") - 1
        bits = self.high[word]
        return word * 64 + _select(~bits if flip else bits, nth - counts[word])

    def get(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        high = (self._place(self.ones, index, False) - index).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._low(index)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it is not in the sequence: the successor's place, if equal."""
        values = np.asarray(values, np.uint64)
        out = np.full(len(values), -1, np.int64)
        if not self.size:
            return out
        high = (values >> np.uint64(self.width)).astype(np.int64)
        last = int(self.get(np.array([self.size - 1]))[0])
        query = np.flatnonzero(values <= last)
        high = high[query]
        at = np.zeros(len(query), np.int64)
        behind = high > 0
        if 4 * len(query) > self.size:  # so many that the unary part is better read once
            zeros = np.flatnonzero(np.unpackbits((~self.high).view(np.uint8), bitorder="little"))
            at[behind] = zeros[high[behind] - 1] + 1 - high[behind]
            end = zeros[high] - high
        else:
            at[behind] = self._place(self.zeros, high[behind] - 1, True) + 1 - high[behind]
            end = self._place(self.zeros, high, True) - high
        want = values[query] & np.uint64((1 << self.width) - 1)
        # Values of one high part can be very many, so they are halved, not walked.
        live = np.flatnonzero(at < end)
        while len(live):
            middle = (at[live] + end[live]) >> 1
            low = self._low(middle)
            hit = low == want[live]
            out[query[live[hit]]] = middle[hit]
            less = low < want[live]
            at[live[less]] = middle[less] + 1
            more = ~less & ~hit
            end[live[more]] = middle[more]
            live = live[~hit]
            live = live[at[live] < end[live]]
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        return {"high": self.high, "ones": self.ones, "low": self.low, "shape": np.array([self.size, self.width])}

    @classmethod
    def from_arrays(cls, a: dict[str, np.ndarray]) -> EliasFano:
        return cls(a["high"], a["ones"], a["low"], int(a["shape"][0]), int(a["shape"][1]))


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one file: a header, then each array at a multiple of 64 bytes."""
    parts, listed, at = [], {}, 0
    for name, a in arrays.items():
        data = np.ascontiguousarray(a).tobytes()
        listed[name] = (a.dtype.str, at, len(a))
        parts.append(data + b"\0" * (-len(data) % 64))
        at += len(parts[-1])
    header = json.dumps(listed).encode()
    header += b" " * (-(len(header) + 8) % 64)
    return len(header).to_bytes(8, "little") + header + b"".join(parts)


def map_file(path: str) -> dict[str, np.ndarray]:
    """The arrays of such a file, mapped into memory, not read."""
    return _arrays(np.memmap(path, np.uint8, mode="r"))


def map_bytes(data: bytes) -> dict[str, np.ndarray]:
    """The arrays of such bytes in a memory map without a file: a task needs no folder for what only it reads."""
    held = mmap.mmap(-1, len(data))
    held.write(data)
    return _arrays(np.frombuffer(held, np.uint8))


def _arrays(data: np.ndarray) -> dict[str, np.ndarray]:
    start = 8 + int.from_bytes(data[:8].tobytes(), "little")
    listed = json.loads(data[8:start].tobytes())
    out = {}
    for name, (kind, at, n) in listed.items():
        out[name] = data[start + at : start + at + n * np.dtype(kind).itemsize].view(kind)
    return out
