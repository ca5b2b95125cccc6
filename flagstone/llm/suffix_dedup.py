"""Removal of byte strings that occur twice or more, by merged Burrows-Wheeler transforms.

Texts are UTF-8 bytes; a window is `n` bytes of one document. Windows that stand side by side and
share their minimiser (the least-hashed `m` bytes in them) form a path, and equal windows lie in
paths of the same minimiser, so:

1. paths whose minimiser occurs once are left out, and equal paths are counted: a path that
   occurs twice or more is repeated as a whole;
2. where different paths share a minimiser, one copy of each is taken from its text and sent,
   by its minimiser, to a bucket of about `BUCKET_BYTES`. A bucket cuts its strings into shards of
   `SHARD_BYTES`, builds each shard's transform, and merges all transforms by interleave refinement (see `bwt`):
   the repeated intervals are the blocks that still hold two rows or more after n bytes;
3. a minimiser with more than `MAX_PATHS` different paths would make a bucket too large; its
   windows are dealt by minimiser and window hash instead and counted there. The result is the same.

Every count is combined before the shuffle, joins on a path are plain equi-joins that adaptive
execution splits, and nothing is gathered but a document's own runs and a bucket's strings.

Cases: a null or empty text has no bytes; texts shorter than n have no windows; rows equal in id
and text are two occurrences, both removed; a null id is an id like any other; a text longer
than `text.PIECE` is handled whole; an empty table gives an empty result; other columns are kept
by `remove_repeats`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.llm.bwt import repeated_starts
from flagstone.llm.keyfilter import key_bits
from flagstone.llm.runs import apply_runs, covered, packed_texts, unpacked
from flagstone.llm.substring_dedup import sliding_argmin
from flagstone.llm.text import byte_values, pieces, rolling
from flagstone.sources.scratch import staged

WINDOW = 200
MINIMISER = 24
MAX_PATHS = 12_000
BUCKET_BYTES = 1 << 20
SHARD_BYTES = 1 << 20
_PLACE = 20  # low bits that hold a position while minima are searched


def _least(small: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value (by all but its low bits, then by place) of each run."""
    if len(small) > 1 << _PLACE:
        return sliding_argmin(small >> np.uint64(_PLACE), width)
    mask = np.uint64((1 << _PLACE) - 1)
    best = (small & ~mask) | np.arange(len(small), dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return (best & mask).astype(np.int64)


def paths(data: np.ndarray, offsets: np.ndarray, n: int, m: int) -> tuple[np.ndarray, ...]:
    """Paths of windows with one minimiser: text, first byte in the piece, windows, minimiser, path."""
    size = np.diff(offsets)
    change = np.zeros(len(data) + 1, np.int64)
    long = size >= n
    np.add.at(change, offsets[:-1][long], 1)
    np.add.at(change, offsets[1:][long] - (n - 1), -1)
    starts = np.flatnonzero(np.cumsum(change)[:-1])
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    values = byte_values(data)
    at = np.arange(len(data) - m + 1)
    small = rolling(values, at, at + m)
    least = _least(small, n - m + 1)[starts]
    text = np.searchsorted(offsets, starts, "right") - 1
    cut = np.ones(len(starts), bool)
    cut[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(cut)
    count = np.diff(np.append(begins, len(starts)))
    first = starts[begins]
    return text[begins], first, count, small[least[begins]], rolling(values, first, first + count + n - 1)


def _path_rows(docs: DataFrame, n: int, m: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                text, first, count, seed, path = paths(data, offsets, n, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seed.view(np.int64)),
                        pa.array(path.view(np.int64)),
                        pa.array(np.asarray(part.column(0))[text]),
                        pa.array((first - offsets[text]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    names=["seed", "path", "key", "at", "size"],
                )

    return docs.mapInArrow(work, "seed long, path long, key long, at int, size int")


def _strings(opened: DataFrame, n: int) -> DataFrame:
    """The bytes of each path: rows have a packed text and a list of (seed, path, at, size, hot)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in (p for b in batches for u in unpacked(b) for p in pieces(u, "packed")):
            lists = part.column(part.schema.get_field_index("paths"))
            cells = lists.flatten()
            at, size = np.asarray(cells.field(2)), np.asarray(cells.field(3))
            low = np.repeat(offsets[:-1], np.asarray(lists.value_lengths())) + at
            high = low + size + n - 1
            raw = data.tobytes()
            strings = [raw[a:b] for a, b in zip(low.tolist(), high.tolist())]
            yield pa.RecordBatch.from_arrays(
                [cells.field(0), cells.field(1), cells.field(4), pa.array(strings, pa.binary())],
                names=["seed", "path", "hot", "string"],
            )

    return opened.mapInArrow(work, "seed long, path long, hot boolean, string binary")


def _bucket_starts(strings: DataFrame, n: int) -> DataFrame:
    """seed, path, starts: repeated windows of each bucket's strings."""

    shard_bytes = SHARD_BYTES

    def work(group: pa.Table) -> pa.Table:
        found = repeated_starts(group.column("string").to_pylist(), n, shard_bytes)
        keep = [i for i, f in enumerate(found) if len(f)]
        lists = pa.array([found[i].astype(np.int32) for i in keep], pa.list_(pa.int32()))
        rows = group.select(["seed", "path"]).take(pa.array(keep, pa.int64()))
        return rows.append_column("starts", lists)

    total = strings.agg(F.sum(F.length("string"))).first()[0] or 0
    buckets = max(1, -(-int(total) // BUCKET_BYTES))
    dealt = strings.withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(work, "seed long, path long, starts array<int>")


def _counted_starts(strings: DataFrame, n: int) -> DataFrame:
    """The same for minimisers with very many paths, by counts of window hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "string"):
                count = np.diff(offsets) - (n - 1)
                row = np.repeat(np.arange(part.num_rows), count)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = offsets[row] + offset
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        part.column(1).take(pa.array(row)),
                        pa.array(offset.astype(np.int32)),
                        pa.array(rolling(byte_values(data), start, start + n).view(np.int64)),
                    ],
                    names=["seed", "path", "at", "edge"],
                )

    edges = strings.mapInArrow(work, "seed long, path long, at int, edge long")
    twice = edges.groupBy("seed", "edge").count().where("count > 1").select("seed", "edge")
    held = edges.join(twice, ["seed", "edge"], "left_semi").groupBy("seed", "path")
    return held.agg(F.sort_array(F.collect_list("at")).alias("starts"))  # at most n - m + 1


def repeated_runs(documents: DataFrame, n: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """key and runs (array of first byte and end) of each document with repeated windows."""
    docs = documents.select(
        F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text")
    )
    rows = staged(_path_rows(docs, n, m), "paths")
    # Written first: a join with a table can be split where a seed is hot, one with an aggregate not.
    twice = staged(rows.groupBy("seed").count().where("count > 1").select("seed"), "seeds")
    rows = staged(rows.join(twice, "seed", "left_semi"), "shared-paths")
    found = staged(
        rows.groupBy("seed", "path").agg(
            F.count("*").alias("copies"), F.min(F.struct("key", "at", "size")).alias("first")
        ),
        "counted",
    )
    branching = staged(found.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"), "branching")
    opened = (
        found.join(branching, "seed")
        .groupBy(F.col("first.key").alias("key"))
        .agg(
            F.collect_list(
                F.struct("seed", "path", "first.at", "first.size", (F.col("n") > MAX_PATHS).alias("hot"))
            ).alias("paths")
        )
    )
    opened = staged(opened, "opened")
    texts = packed_texts(docs, key_bits(opened, "key")).dropDuplicates(["key"])
    strings = staged(_strings(opened.join(texts, "key"), n), "strings")
    cut = _bucket_starts(strings.where("not hot"), n).unionByName(
        _counted_starts(strings.where("hot").drop("hot"), n)
    )
    decided = found.select("seed", "path", "copies").join(cut, ["seed", "path"], "left")
    decided = staged(decided, "decided")
    whole = F.array(F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size") + n - 1).alias("end")))
    single = F.transform(
        "starts",
        lambda o: F.struct((F.col("at") + o).alias("start"), (F.col("at") + o + n).alias("end")),
    )
    runs = rows.join(decided, ["seed", "path"]).select(
        "key", F.when(F.col("copies") > 1, whole).otherwise(single).alias("runs")
    )
    return staged(
        runs.where("runs is not null").groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("runs")),
        "runs",
    )


def remove_repeats(
    documents: DataFrame, n: int = WINDOW, m: int = MINIMISER, digest: bool = False
) -> DataFrame:
    """The documents with n_bytes, n_removed, n_spans and `kept`: the remaining bytes.

    Cuts need not lie between characters, so `kept` is binary; with `digest` it is its SHA-256.
    The text itself is left out. New columns replace those of their names.
    """

    def cut(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
        if not len(starts):
            kept, removed, spans = text.tobytes(), 0, 0
        else:
            gone = covered(len(text), starts, ends)
            kept, removed = text[~gone].tobytes(), int(gone.sum())
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        return len(text), removed, spans, hashlib.sha256(kept).hexdigest() if digest else kept

    new = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long")]
    new.append(("kept", "string" if digest else "binary"))
    return apply_runs(documents, repeated_runs(documents, n, m), new, cut, ("text",))
