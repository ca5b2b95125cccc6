"""Elias-Fano sequences and a two-level n-gram trie on them, in one memory-mapped buffer.

A monotone sequence keeps the low bits of its values side by side and the high bits in unary.
A directory of ones per machine word finds the j-th one or zero; access and successor search
are vectorised over many positions.
"""

from __future__ import annotations

import mmap
from dataclasses import dataclass

import numpy as np


def _bits(flags: np.ndarray) -> np.ndarray:
    """Booleans as 64-bit words, least bit first, with a spare word."""
    data = np.packbits(flags, bitorder="little")
    out = np.zeros(len(data) // 8 + 2, np.uint64)
    out.view(np.uint8)[: len(data)] = data
    return out


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of `width` bits side by side."""
    if not width:
        return np.zeros(2, np.uint64)
    at = np.arange(len(values), dtype=np.int64) * width
    out = np.zeros((len(values) * width >> 6) + 2, np.uint64)
    word, off = at >> 6, (at & 63).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    if len(values):
        out[word[first]] = np.bitwise_or.reduceat(values << off, first)
        cross = off + np.uint64(width) > np.uint64(64)
        rest = values[cross] >> (np.uint64(64) - off[cross])
        out[word[cross] + 1] |= rest  # at most one value crosses into a word
    return out


@dataclass
class EliasFano:
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray  # ones before each word of `high`
    width: int
    n: int

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        """From ascending unsigned values."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        highs = (values >> np.uint64(width)).astype(np.int64)
        flags = np.zeros(n + (top >> width) + 2, np.uint8)
        flags[highs + np.arange(n)] = 1
        high = _bits(flags)
        mask = np.uint64((1 << width) - 1)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))[:-1]])
        return cls(_pack(values & mask, width), high, ones, width, n)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones.astype(np.uint64), np.array([self.width, self.n], np.uint64)]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        low, high, ones, shape = arrays
        return cls(low, high, ones.astype(np.int64), int(shape[0]), int(shape[1]))

    def _select(self, j: np.ndarray, zeros: bool) -> np.ndarray:
        """Position of the j-th (from 0) one or zero."""
        before = np.arange(len(self.ones)) * 64 - self.ones if zeros else self.ones
        k = np.searchsorted(before, j, "right") - 1
        word = ~self.high[k] if zeros else self.high[k].copy()
        left = j - before[k]
        place = np.zeros(len(j), np.int64)
        for size in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(word & np.uint64((1 << size) - 1)).astype(np.int64)
            up = left >= count
            left -= np.where(up, count, 0)
            place += np.where(up, size, 0)
            word = np.where(up, word >> np.uint64(size), word)
        return k * 64 + place

    def _low(self, j: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(j), np.uint64)
        at = j * self.width
        word, off = at >> 6, (at & 63).astype(np.uint64)
        out = self.low[word] >> off
        cross = off + np.uint64(self.width) > np.uint64(64)
        out[cross] |= self.low[word[cross] + 1] << (np.uint64(64) - off[cross])
        return out & np.uint64((1 << self.width) - 1)

    def access(self, j: np.ndarray) -> np.ndarray:
        highs = (self._select(j, zeros=False) - j).astype(np.uint64)
        return (highs << np.uint64(self.width)) | self._low(j)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first value that is x or more, in x's bucket, and whether it is x."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        x = x.astype(np.uint64)
        h = (x >> np.uint64(self.width)).astype(np.int64)
        top = int(self.access(np.array([self.n - 1]))[0]) >> self.width
        inside = h <= top
        h = np.minimum(h, top)
        begin = np.where(h > 0, self._select(np.maximum(h - 1, 0), zeros=True) - (h - 1), 0)
        stop = self._select(h, zeros=True) - h
        begin = np.where(inside, begin, self.n)
        stop = np.where(inside, stop, self.n)
        want = x & np.uint64((1 << self.width) - 1) if self.width else np.zeros(len(x), np.uint64)
        low, high = begin, stop.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            less = np.zeros(len(x), bool)
            less[open_] = self._low(mid[open_]) < want[open_]
            low = np.where(open_ & less, mid + 1, low)
            high = np.where(open_ & ~less, mid, high)
        found = low < stop
        found[found] = self._low(low[found]) == want[found]
        return low, found


LEVELS = 1 << 12


@dataclass
class Quantised:
    """Log probabilities as indices into equal steps between their least and greatest value."""

    index: np.ndarray
    range: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray) -> Quantised:
        low, high = (values.min(), values.max()) if len(values) else (0.0, 0.0)
        step = (high - low) / (LEVELS - 1) or 1.0
        return cls(np.rint((values - low) / step).astype(np.uint16), np.array([low, step]))

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.range[0] + self.range[1] * self.index[at]


@dataclass
class Trie:
    """Words at the first level, the contexts before each word at the second.

    `pointers` are the monotone starts of the words' children. Children are context numbers
    (places in `contexts`), ascending within a word; to be monotone throughout, each word's
    numbers stand above the last child before it. A search is relative to that base.
    """

    words: EliasFano
    word_value: Quantised
    pointers: EliasFano
    contexts: EliasFano
    children: EliasFano
    child_value: Quantised

    @classmethod
    def build(
        cls,
        words: np.ndarray,
        word_values: np.ndarray,
        owner: np.ndarray,
        context: np.ndarray,
        values: np.ndarray,
    ) -> Trie:
        """words ascending; (owner, context) ascending, owner a place in words."""
        names = np.unique(context)
        number = np.searchsorted(names, context).astype(np.int64)
        starts = np.searchsorted(owner, np.arange(len(words) + 1))
        filled = starts[1:] > starts[:-1]
        rise = np.zeros(len(words), np.int64)
        rise[filled] = number[starts[1:][filled] - 1] + 1
        base = np.concatenate([[0], np.cumsum(rise)[:-1]]) if len(words) else rise
        return cls(
            EliasFano.build(words),
            Quantised.build(word_values),
            EliasFano.build(starts),
            EliasFano.build(names),
            EliasFano.build((number + base[owner]).astype(np.uint64)),
            Quantised.build(values),
        )

    def query(
        self, words: np.ndarray, owner: np.ndarray, contexts: np.ndarray, unknown: float
    ) -> np.ndarray:
        """Value of each (words[owner], context): the child's, else the word's, else `unknown`."""
        place, known = self.words.successor(words)
        of_word = np.full(len(words), unknown)
        of_word[known] = self.word_value[place[known]]
        out = of_word[owner]
        number, seen = self.contexts.successor(contexts)
        both = np.flatnonzero(known[owner] & seen)
        if not len(both):
            return out
        at = place[known]
        start = np.zeros(len(words), np.int64)
        stop, base = start.copy(), start.copy()
        start[known] = self.pointers.access(at).astype(np.int64)
        stop[known] = self.pointers.access(at + 1).astype(np.int64)
        later = start > 0
        base[later] = self.children.access(start[later] - 1).astype(np.int64) + 1
        of = owner[both]
        child, found = self.children.successor((base[of] + number[both]).astype(np.uint64))
        found &= (child >= start[of]) & (child < stop[of])
        out[both[found]] = self.child_value[child[found]]
        return out

    def to_bytes(self) -> bytes:
        """All levels in one buffer: a count, the sizes, then the arrays."""
        parts = [
            *self.words.arrays(), *self.pointers.arrays(), *self.contexts.arrays(),
            *self.children.arrays(), self.word_value.index, self.word_value.range,
            self.child_value.index, self.child_value.range,
        ]
        blobs = [np.ascontiguousarray(p).tobytes() for p in parts]
        sizes = np.array([len(b) for b in blobs], np.int64).tobytes()
        return sizes + b"".join(b + b"\0" * (-len(b) % 8) for b in blobs)

    @classmethod
    def map(cls, data: bytes) -> Trie:
        """The trie over a memory map of the buffer; levels are views, not copies."""
        held = mmap.mmap(-1, max(len(data), 1))
        held.write(data)
        view = np.frombuffer(held, np.uint8)
        sizes = view[: 20 * 8].view(np.int64)
        at, views = 20 * 8, []
        kinds = [np.uint64] * 16 + [np.uint16, np.float64, np.uint16, np.float64]
        for size, kind in zip(sizes.tolist(), kinds):
            views.append(view[at : at + size].view(kind))
            at += size + (-size % 8)
        levels = [EliasFano.of(views[i : i + 4]) for i in range(0, 16, 4)]
        return cls(
            levels[0], Quantised(*views[16:18]), levels[1], levels[2], levels[3], Quantised(*views[18:20])
        )
