"""Best-fit decreasing packing of tokenised documents into sequences of a fixed capacity.

Documents longer than the capacity are cut into full pieces, the first of which may be shorter;
all pieces together are then packed as one set, longest first, each into the tightest open
sequence. Lengths are integers up to the capacity, so a count for each length tells all that best-fit
decreasing needs: pieces of one length are alike, and so are open sequences of one history. `plan`
keeps classes of alike sequences in a segment tree over remaining capacities and finds the tightest
one in logarithmic time; it places whole runs of equal pieces at once, which gives the same sequences
as placing the pieces one by one (a sequence that still has room for a piece of the same length is
the tightest for the next). At most `capacity` counts reach the driver, however many pieces
there are.

A piece finds its place by its rank among the pieces of its length: counts a partition and length
are summed up and joined back, and the plan (see `plan` for the bound of its size) is broadcast.
Pieces are shuffled only by that join, on keys which have at most one partition's rows.

Cases: a null or empty text is one piece with the end mark alone; texts are encoded whole, about
1 MiB of texts at a time; repeated rows are packed each on its own; ties of one length are placed in
the order of the input; an empty table gives no pieces. Only the key and the text are read, so
other columns clash with nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.llm.bpe import Encoder, Vocabulary
from flagstone.llm.text import pieces as text_runs
from flagstone.sources.scratch import staged

CAPACITY = 2048
END = 0  # the id after every document
_RANK_BITS = 48
RUN = 1 << 19  # bytes of text encoded at once


class OpenSequences:
    """Classes of open sequences by remaining capacity, in a segment tree of their numbers."""

    def __init__(self, capacity: int) -> None:
        self.base = 1 << capacity.bit_length()
        self.held = [0] * (2 * self.base)
        self.classes: list[list[tuple[int, int]]] = [[] for _ in range(self.base)]

    def _change(self, remaining: int, by: int) -> None:
        node = self.base + remaining
        while node:
            self.held[node] += by
            node >>= 1

    def put(self, remaining: int, first: int, n: int) -> None:
        """`n` sequences from number `first` on have this much left."""
        if n and remaining:
            self.classes[remaining].append((first, n))
            self._change(remaining, 1)

    def take(self, remaining: int) -> tuple[int, int]:
        self._change(remaining, -1)
        return self.classes[remaining].pop()

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least `least` that a class has."""
        node = self.base + least
        while not self.held[node]:
            while node & 1:  # a right child: what is larger lies beyond its parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.base:
            node = 2 * node if self.held[2 * node] else 2 * node + 1
        return node - self.base


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces of each length go: rows (length, first rank, first sequence, pieces a
    sequence, offset), sorted.

    The r-th piece of a length, in the row with the last first rank up to r, goes to sequence
    first + (r - rank) div pieces. A length adds at most four classes, and whoever fills a class
    leaves less than half of its room, so there are at most 4 x capacity x log2(capacity) rows.
    """
    open_ones, rows, new = OpenSequences(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = open_ones.tightest(length)
            if room is None:
                room, first = capacity, new
                n = -(-left // (capacity // length))
                new += n
            else:
                first, n = open_ones.take(room)
            each = room // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                open_ones.put(room - each * length, first, full)
            if left and full < n:  # fewer than `each` are left
                rows.append((length, rank, first + full, left, capacity - room))
                open_ones.put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            open_ones.put(room, first + full, n - full)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = n_tokens % capacity or capacity
    if n_tokens <= capacity:
        return [(0, n_tokens)]
    starts = [0, *range(first, n_tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def pieces(
    df: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """Pieces of every document: key, piece, start, length, ids_crc32 (of the ids as little-endian
    unsigned integers of 32 bits), if wanted ids; and the piece's partition and rank among those of its
    length there."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    df = df.select(F.col(key), F.col("text").cast("string").alias("text"))
    names = [key, "piece", "start", "length", "ids_crc32", "slot", "local", *(["ids"] if with_ids else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, decimal=False)
        slot, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for part, _, _ in text_runs(batch, size=RUN):
                ids, offsets, _ = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                marks = offsets.tolist()
                row, number, start, length, crc, local, content = [], [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(marks, marks[1:])):
                    whole = np.append(ids[a:b], END).astype("<u4")
                    for k, (s, n) in enumerate(cut(len(whole), capacity)):
                        row.append(i)
                        number.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(whole[s : s + n].tobytes()))
                        local.append(seen[n])
                        seen[n] += 1
                        if with_ids:
                            content.append(whole[s : s + n].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int32())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array([slot] * len(row), pa.int32()),
                        pa.array(local, pa.int64()),
                        *([pa.array(content, pa.list_(pa.int32()))] if with_ids else []),
                    ],
                    names=names,
                )

    kinds = [df.schema[key].dataType, T.IntegerType(), *[T.LongType()] * 3, T.IntegerType(), T.LongType()]
    kinds += [T.ArrayType(T.IntegerType())] if with_ids else []
    return df.mapInArrow(work, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to written pieces."""
    counts = cut_pieces.groupBy("slot", "length").agg(F.count("*").alias("n"))
    counts = staged(counts, "lengths")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"))
    rows = plan({r.length: r.n for r in totals.collect()}, capacity)  # at most one row a length
    shared = cut_pieces.sparkSession.sparkContext.broadcast(rows)
    earlier = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("slot", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranks = cut_pieces.join(counts, ["slot", "length"])
    ranks = ranks.select(
        *[c for c in cut_pieces.columns if c not in ("slot", "local")],
        (F.col("before") + F.col("local")).alias("rank"),
    )
    out = T.StructType(
        [f for f in ranks.schema if f.name != "rank"]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, first, each, offset = shared.value.T
        keys = (length << _RANK_BITS) + rank
        for batch in batches:
            n, r = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (n << _RANK_BITS) + r, "right") - 1
            over = r - rank[at]
            kept = [i for i, c in enumerate(batch.schema.names) if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in kept],
                    pa.array(first[at] + over // each[at]),
                    pa.array(offset[at] + over % each[at] * n),
                ],
                names=out.names,
            )

    return ranks.mapInArrow(work, out)


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence each belongs to and its place there."""
    return place(staged(pieces(df, path, capacity, key, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of every sequence of `pack(..., with_ids=True)`; a group has at most `capacity` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    return packed.groupBy("sequence_id").agg(ids.alias("ids"))
