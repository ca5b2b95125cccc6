"""Burrows-Wheeler transforms of shards of strings, and their merge by interleave refinement.

A shard is a run of byte strings, each closed by an end mark. Its transform lists, in the order
of the suffixes, the symbol before each; the LF mapping leads from a suffix to the one that is a
symbol longer. A merge starts with all rows of all shards in one block and refines: in each round
every row still in question moves to its longer suffix, and rows are dealt stably by the symbols
passed, so that after k rounds of two symbols they are in the order of their first 2k symbols.
Rows of one block agree in that prefix; where a block falls apart, the common prefix ends. Blocks
of a single row are settled, and so are blocks of rows of one shard, whose order and common
prefixes the shard knows. No suffix is sorted again.
"""

from __future__ import annotations

import numpy as np


def shard_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `depth` symbols, and their classes.

    Prefixes double in each round; only suffixes whose class is not theirs alone are dealt anew.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_ = symbols[order]
    new = np.ones(n, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # place of the class's first suffix
    have = 1
    while have < depth:
        last = np.append(new[1:], True)
        open_ = np.flatnonzero(~(new & last))  # places in classes of several
        if not len(open_):
            break
        at = order[open_]
        step = min(have, depth - have)
        follow = np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        order[open_] = at[by]
        key = key[by]
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[open_] = fresh
        group = np.flatnonzero(new)
        rank[order[open_]] = group[np.searchsorted(group, open_, "right") - 1]
        have += step
    return order, rank


class Shard:
    """Transform of one shard: `symbol` before each suffix and LF, rows in suffix order."""

    def __init__(self, symbols: np.ndarray, depth: int) -> None:
        order, rank = shard_order(symbols, depth)
        n = len(symbols)
        row = np.empty(n, np.int64)
        row[order] = np.arange(n)
        before = np.where(order > 0, order - 1, n - 1)
        self.symbol = symbols[before].astype(np.uint16)
        self.lf = row[before].astype(np.int32)
        self.order = order.astype(np.int32)  # text position of each row, to report
        same = np.zeros(n, bool)
        same[1:] = rank[order[1:]] == rank[order[:-1]]
        self.same = same  # this row agrees with the one before in `depth` symbols


def merge_repeats(shards: list[Shard], depth: int, end: int = 256) -> list[np.ndarray]:
    """For each shard, whether the row's first `depth` symbols (even) occur in another shard too.

    Prefixes with an end mark are no matches: rows that pass one are left out.
    """
    sizes = np.array([len(s.order) for s in shards], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = [np.zeros(n, bool) for n in sizes]
    if len(shards) < 2:
        return out
    # Two symbols a round: what a row reads on its way, and the row it comes to.
    code, step = np.empty(base[-1], np.int32), np.empty(base[-1], np.int32)
    for shard, low, high in zip(shards, base[:-1], base[1:]):
        two = shard.symbol[shard.lf]
        passed = two.astype(np.int32) << 8 | (shard.symbol & 255)
        passed[(shard.symbol == end) | (two == end)] = -1
        code[low:high] = passed
        step[low:high] = shard.lf[shard.lf] + low
    owner = np.repeat(np.arange(len(shards), dtype=np.int32), sizes)
    # Rows of different first symbols never meet: an eighth of them at a time saves memory.
    for eighth in range(8):
        rows = np.flatnonzero(code >> 13 == eighth).astype(np.int32)
        block = np.zeros(len(rows), np.int32)
        for _ in range(depth // 2):
            passed = code[rows]
            keep = passed >= 0
            rows, block, passed = rows[keep], block[keep], passed[keep]
            if not len(rows):
                break
            by = np.argsort(passed.astype(np.uint16), kind="stable")
            rows, block, passed = step[rows[by]], block[by], passed[by]
            new = np.ones(len(rows), bool)
            new[1:] = (passed[1:] != passed[:-1]) | (block[1:] != block[:-1])
            begins = np.flatnonzero(new)
            of = owner[rows]
            mixed = np.minimum.reduceat(of, begins) < np.maximum.reduceat(of, begins)
            lengths = np.diff(np.append(begins, len(rows)))
            held = np.repeat(mixed, lengths)
            rows, block = rows[held], np.repeat(np.cumsum(mixed, dtype=np.int32), lengths)[held]
        for row, shard in zip(rows, owner[rows]):
            out[shard][row - base[shard]] = True
    return out


def repeated_starts(
    strings: list[bytes], depth: int, shard_bytes: int = 1 << 20
) -> list[np.ndarray]:
    """For each string the starts of substrings of `depth` bytes that occur in another place too."""
    shards: list[Shard] = []
    spans: list[np.ndarray] = []  # first position of each string in its shard
    held: list[bytes] = []

    def close() -> None:
        lengths = np.array([len(s) + 1 for s in held], np.int64)
        marks = np.cumsum(lengths)
        symbols = np.full(int(marks[-1]), 256, np.uint16)
        inside = np.ones(len(symbols), bool)
        inside[marks - 1] = False
        symbols[inside] = np.frombuffer(b"".join(held), np.uint8)
        shards.append(Shard(symbols, depth))
        spans.append(np.concatenate([[0], marks]))
        held.clear()

    size = 0
    for s in strings:
        held.append(s)
        size += len(s) + 1
        if size >= shard_bytes:
            close()
            size = 0
    if held:
        close()
    across = merge_repeats(shards, depth)
    out: list[np.ndarray] = []
    for shard, found, marks in zip(shards, across, spans):
        n = len(shard.order)
        place = np.zeros(n, bool)
        within = shard.same.copy()
        within[:-1] |= shard.same[1:]
        place[shard.order[within | found]] = True
        for a, b in zip(marks[:-1].tolist(), marks[1:].tolist()):
            # prefixes that pass the end mark are no matches
            starts = np.flatnonzero(place[a : max(a, b - depth)])
            out.append(starts)
    return out
