"""A sparse document-term matrix over a global dictionary, in CSR shards.

1. Distinct words of every run of texts are counted, summed up by word, and numbered: word ids are
   dense and the same for all shards (`dictionary`).
2. Texts are read again; a run of about `SHARD` bytes becomes a shard, rows of local word numbers
   with their counts. At most `hot` words, the most frequent ones (so few that they may be
   broadcast), get their ids there. The others, each at most once a shard, are joined with the
   dictionary by word and come back to their shard, which travels in packed form.
3. A shard's matrix is complete when its words' ids are in place: docs (one struct a row), indptr,
   indices (ascending in a row), data.

Words are compared as such; hashes only find candidates. A word is at most once a shard in the
join, so the most frequent word beyond the hot ones has a small part of the rows; all groups are
bounded by the shard.

Cases: a null text is empty and an empty text is an empty row; a text longer than a shard is a shard
of its own; repeated rows are rows of their own; an empty table has no words and no shards. The
carried columns travel in one struct, so their names clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.llm.ranks import numbered
from flagstone.llm.text import buffers, hash_intervals, pieces
from flagstone.sources.scratch import staged

SHARD = 1 << 20  # bytes of text
RUN = 1 << 23  # bytes of text whose words are counted together
HOT_WORDS = 1 << 20  # words sent to all tasks, at most


def _between(data: np.ndarray, low: int, high: int) -> np.ndarray:
    """Which bytes lie in a range, by comparison (much faster than by a table)."""
    return data - np.uint8(low) <= np.uint8(high - low)  # smaller ones wrap around


def _gaps(data: np.ndarray) -> np.ndarray:
    return _between(data, 0x09, 0x0D) | (data == 0x20)


def _marks(data: np.ndarray) -> np.ndarray:
    """Which bytes are one of `#$%&*|`."""
    return _between(data, ord("#"), ord("&")) | (data == ord("*")) | (data == ord("|"))


def encode_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, each word's number among them, and each text's first word."""
    inside = ~_gaps(data)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    marks = np.append(0, np.cumsum(end - start)).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(marks), pa.py_buffer(np.ascontiguousarray(data[inside]))
    )
    coded = text.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(start, offsets)


def dictionary(df: DataFrame, column: str = "text") -> DataFrame:
    """All words with the number of their occurrences and their id, from 0."""
    df = df.select(F.col(column).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch, size=RUN):
                words, numbers, _ = encode_words(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [words.cast(pa.string()), pa.array(np.bincount(numbers, minlength=len(words)))],
                    names=["word", "n"],
                )

    counted = df.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return numbered(counted, "word_id")


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The words with at least so many occurrences that there are at most `most` of them."""
    shift = "greatest(length(bin(n)) - 6, 0)"
    bins = words.select(F.expr(f"shiftleft(shiftright(n, {shift}), {shift})").alias("low"))
    least, held = None, 0
    for row in sorted(bins.groupBy("low").count().collect(), reverse=True):  # at most 64 x 64 bins
        held += row["count"]
        if held > most:
            break
        least = row.low
    return words.where(F.col("n") >= least) if least is not None else words.limit(0)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in each text; quick where few are set."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


# What a shard's row says about its document besides the carried columns.
TRAITS = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),  # code points
        T.StructField("n_upper", T.LongType()),
        T.StructField("marked", T.BooleanType()),
        T.StructField("digest", T.BinaryType()),
    ]
)


def _traits(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    marks, raw = offsets.tolist(), memoryview(np.ascontiguousarray(data))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(offsets) - _sums(_between(data, 0x80, 0xBF), offsets)),
            pa.array(_sums(_between(data, ord("A"), ord("Z")), offsets)),
            pa.array(_sums(_marks(data), offsets) > 0),
            pa.array([hashlib.sha256(raw[a:b]).digest() for a, b in zip(marks, marks[1:])], pa.binary()),
        ],
        names=TRAITS.names,
    )


def _one_list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    values = pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs, behind that number."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    raw = column[0].as_buffer()
    return np.frombuffer(raw, f"<u{np.frombuffer(raw, np.uint8, 1)[0]}", offset=1).astype(np.int64)


class _Hot:
    """The hot words, looked up by hash and then compared."""

    def __init__(self, table: pa.Table) -> None:
        self.words = table.column("word").cast(pa.large_string()).combine_chunks()
        self.number = table.column("word_id").to_numpy()
        data, offsets = buffers(self.words)
        hashes = hash_intervals(data, offsets[:-1], offsets[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def ids(self, words: pa.Array) -> np.ndarray:
        """Ids of words; -1 for those that are not hot."""
        if not len(self.words) or not len(words):
            return np.full(len(words), -1)
        data, offsets = buffers(words)
        hashes = hash_intervals(data, offsets[:-1], offsets[1:])
        order = np.argsort(hashes)  # in order, the search stays in the cache
        at = np.empty(len(hashes), np.int64)
        at[order] = np.searchsorted(self.hashes, hashes[order])
        found = self.order[np.minimum(at, len(self.order) - 1)]
        same = pc.equal(self.words.take(pa.array(found)), words).to_numpy(zero_copy_only=False)
        return np.where(same, self.number[found], -1)


def _fill(shard: pa.Table, rare: pa.Table) -> pa.Table:
    """Put the ids of the rare words into a shard and order its rows by word id."""
    terms = _unpacked(shard.column("terms"))
    terms[rare.column("slot").to_numpy()] = rare.column("word_id").to_numpy()
    indptr, data = _unpacked(shard.column("indptr")), _unpacked(shard.column("data"))
    columns = _unpacked(shard.column("indices"))
    indices = terms[columns]
    rank = np.empty(len(terms), np.int64)  # one key a cell sorts faster than two
    rank[np.argsort(terms)] = np.arange(len(terms))
    row = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    order = np.argsort(row * len(terms) + rank[columns])
    return pa.table(
        [
            shard.column("shard"),
            shard.column("docs"),
            _one_list(indptr, pa.int32()),
            _one_list(indices[order], pa.int64()),
            _one_list(data[order], pa.int32()),
        ],
        names=["shard", "docs", "indptr", "indices", "data"],
    )


def matrix(
    df: DataFrame,
    words: DataFrame,
    carry: dict[str, Column],
    column: str = "text",
    hot: int = HOT_WORDS,
) -> DataFrame:
    """CSR shards of the texts: shard, docs (carried columns and `TRAITS`), indptr, indices, data."""
    known = frequent(words, hot)
    shared = df.sparkSession.sparkContext.broadcast(_Hot(known.select("word", "word_id").toArrow()))
    df = df.select(
        F.struct(*[c.alias(n) for n, c in carry.items()]).alias("row"),
        F.col(column).cast("string").alias("text"),
    )
    row = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema["row"].dataType])
    doc = T.StructType([T.StructField("row", row), T.StructField("traits", TRAITS)])
    fields = [T.StructField("shard", T.LongType()), T.StructField("docs", T.ArrayType(doc))]
    kinds = {"indptr": T.IntegerType(), "indices": T.LongType(), "data": T.IntegerType()}
    schema = T.StructType(
        [
            *fields,
            *[T.StructField(n, T.BinaryType()) for n in (*kinds, "terms")],
            T.StructField("slots", T.ArrayType(T.IntegerType())),
            T.StructField("rare", T.ArrayType(T.StringType())),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part, data, offsets in pieces(batch, size=SHARD):
                local, numbers, first = encode_words(data, offsets)
                text = np.repeat(np.arange(part.num_rows), np.diff(first))
                bits = max(1, len(local)).bit_length()
                cell = np.sort((text << bits) + numbers)
                new = np.flatnonzero(np.diff(cell, prepend=-1))
                row, column_number = cell[new] >> bits, cell[new] & ((1 << bits) - 1)
                ids = shared.value.ids(local)
                slots = np.flatnonzero(ids < 0)
                docs = pa.StructArray.from_arrays(
                    [part.column(0), _traits(data, offsets)], names=["row", "traits"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                        pa.array([_packed(np.searchsorted(row, np.arange(part.num_rows + 1)))]),
                        pa.array([_packed(column_number)]),
                        pa.array([_packed(np.diff(np.append(new, len(cell))))]),
                        pa.array([_packed(np.maximum(ids, 0))]),
                        _one_list(slots, pa.int32()),
                        _one_list(local.take(pa.array(slots)), pa.string()),
                    ],
                    names=schema.names,
                )
                number += 1

    shards = staged(df.mapInArrow(cut, schema), "shards")
    rare = shards.select(F.col("shard").alias("of"), F.inline(F.arrays_zip("slots", "rare")))
    rare = rare.join(words.select("word", "word_id"), F.col("rare") == F.col("word"))
    rare = rare.select("of", F.col("slots").alias("slot"), "word_id")
    out = [*fields, *[T.StructField(n, T.ArrayType(k)) for n, k in kinds.items()]]
    return (
        shards.drop("slots", "rare")
        .groupBy("shard")
        .cogroup(rare.groupBy("of"))
        .applyInArrow(_fill, T.StructType(out))
    )


def row_statistics(shards: DataFrame) -> DataFrame:
    """One row a document: the carried columns, the traits, n_words (row sum), n_distinct (nonzeros)."""
    low = lambda i: F.element_at("indptr", i + 1)
    size = lambda i: F.element_at("indptr", i + 2) - low(i)
    stats = F.transform(
        "docs",
        lambda d, i: F.struct(
            d["row"].alias("row"),
            d["traits"].alias("traits"),
            F.aggregate(
                F.slice("data", low(i) + 1, size(i)), F.lit(0).cast("long"), lambda a, x: a + x
            ).alias("n_words"),
            size(i).cast("long").alias("n_distinct"),
        ),
    )
    return shards.select(F.inline(stats)).select("row.*", "traits.*", "n_words", "n_distinct")
