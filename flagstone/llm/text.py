"""Words of many texts at once: numpy over the Arrow buffer of a batch, no object per word.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Word hashes have 64 bits and are the same
on every executor and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 18  # bytes of text handled at once; a longer text is a piece of its own
SPACES = r"[\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of a public hash, a bijection)."""
    x = np.array(x, dtype=np.uint64)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers[0][:n], _powers[1][:n]


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end] for many intervals; values are scrambled 64-bit integers."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    width = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + width * _U(0xD6E8FEB86659FD93))


def distinct(x: np.ndarray) -> np.ndarray:
    """Distinct integers, ascending (by sorting, which is faster here than by hashing)."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


@dataclass
class Words:
    """Words of consecutive texts: `hash` of each, and where text i has [first[i], first[i+1])."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray  # byte positions in the piece
    end: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def hash_intervals(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of symbols[start:end] for ascending intervals of bytes, piece by piece."""
    hashes = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        low = start[done]
        upto = max(done + 1, int(np.searchsorted(end, low + PIECE, "right")))
        piece = _BYTE[symbols[low : end[upto - 1]]]
        hashes[done:upto] = rolling(piece, start[done:upto] - low, end[done:upto] - low)
        done = upto
    return hashes


def byte_values(data: np.ndarray) -> np.ndarray:
    """A scrambled 64-bit integer for each byte, to roll hashes over."""
    return _BYTE[data]


def lower_case(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return _LOWER[data]


def words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, gaps: np.ndarray = _SPACE
) -> Words:
    """Words of the texts data[offsets[i]:offsets[i+1]]: runs of bytes that are no gaps."""
    inside = ~gaps[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = hash_intervals(_LOWER[data] if lower else data, start, end)
    return Words(hashes, np.searchsorted(start, offsets), start, end)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; a null is an empty text."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    marks = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = marks[0] if len(marks) else 0
    return raw[low : marks[-1]], marks - low


def pieces(
    batch: pa.RecordBatch, column: str = "text", size: int = PIECE
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows with about `size` bytes of text, with bytes and offsets."""
    data, offsets = buffers(batch.column(batch.schema.get_field_index(column)))
    row = 0
    while row < batch.num_rows:
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        upto = min(upto, batch.num_rows)
        low, high = offsets[row], offsets[upto]
        yield batch.slice(row, upto - row), data[low:high], offsets[row : upto + 1] - low
        row = upto


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs, behind that number."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack_ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def grams(w: Words, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words and the index of their text.

    A text with fewer than n words, but at least one, gives its whole sequence if `short`.
    """
    count = w.count
    valid = np.ones(len(w.hash), bool)
    last = w.first[1:]
    for back in range(1, n):  # the last n-1 words of a text start no window
        at = last - back
        valid[at[count >= back]] = False
    starts = np.flatnonzero(valid)
    text = w.text[starts]
    ends = starts + n
    if short and n > 1:
        few = np.flatnonzero((count > 0) & (count < n))
        starts = np.concatenate([starts, w.first[few]])
        ends = np.concatenate([ends, w.first[few + 1]])
        text = np.concatenate([text, few])
        order = np.argsort(text, kind="stable")
        starts, ends, text = starts[order], ends[order], text[order]
    return rolling(w.hash, starts, ends), text


def word_list(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def row_key(*columns: str) -> Column:
    """Identity of a document: rows equal in these columns share their result."""
    return F.xxhash64(*columns)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
