"""Cutting runs out of texts: the last step of the operators that remove repeated passages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from flagstone.llm.keyfilter import key_bits, may_hold
from flagstone.llm.text import buffers, pieces

Cut = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the intervals."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change)[:-1] > 0


def pack(column: pa.Array) -> pa.Array:
    """Texts as compressed bytes after their length; a null text is empty."""
    data, offsets = buffers(column)
    raw = memoryview(np.ascontiguousarray(data))
    sizes = np.diff(offsets).tolist()
    marks = offsets.tolist()
    codec = pa.Codec("zstd", compression_level=1)
    return pa.array(
        [
            n.to_bytes(8, "little") + (codec.compress(raw[a : a + n], asbytes=True) if n else b"")
            for a, n in zip(marks, sizes)
        ],
        pa.binary(),
    )


def unpack(column: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    out = []
    for blob in column.to_pylist():
        n = int.from_bytes(blob[:8], "little") if blob else 0
        out.append(codec.decompress(blob[8:], n, asbytes=True) if n else b"")
    return pa.array(out, pa.large_binary())


def packed_texts(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """key and packed text of the rows (key, text) whose key may be in the bit table."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.filter(pa.array(may_hold(shared.value, np.asarray(batch.column(0)))))
            yield pa.RecordBatch.from_arrays(
                [held.column(0), pack(held.column(1))], names=["key", "packed"]
            )

    return docs.select("key", "text").mapInArrow(work, "key long, packed binary")


def unpacked(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    """The batch in short slices, columns named packed... unpacked under the same names."""
    for low in range(0, batch.num_rows, size):
        part = batch.slice(low, size)
        columns = [
            unpack(c) if n.startswith("packed") else c for n, c in zip(part.schema.names, part.columns)
        ]
        yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)


def apply_runs(
    documents: DataFrame,
    runs: DataFrame,
    new: Sequence[tuple[str, str]],
    cut: Cut,
    drop: Sequence[str] = (),
) -> DataFrame:
    """The documents with the values that `cut(bytes, starts, ends)` gives for each text.

    `runs` has the identity `key` of a document and an array of (start, end). Documents whose key
    is surely not there are done where they are read; the others are joined.
    """
    table = key_bits(runs, "key")
    shared = documents.sparkSession.sparkContext.broadcast(table)
    names = [n for n, _ in new]
    held = [c for c in documents.columns if c not in names and c not in drop]
    # Columns travel by number, so that no name can clash.
    numbered = documents.select(
        F.xxhash64("doc_id", "text").alias("key"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(held)],
    )
    added = StructType.fromDDL(", ".join(f"{n} {kind}" for n, kind in new))
    schema = StructType([*[documents.schema[c] for c in held], *added])

    def finish(
        part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, runs_of: pa.Array | None
    ) -> pa.RecordBatch:
        starts = ends = np.zeros(0, np.int64)
        marks = np.zeros(part.num_rows + 1, np.int64)
        if runs_of is not None:
            np.cumsum(np.asarray(runs_of.value_lengths().fill_null(0)), out=marks[1:])
            starts, ends = (np.asarray(runs_of.flatten().field(i)) for i in (0, 1))
        got = [
            cut(data[a:b], starts[c:d], ends[c:d])
            for a, b, c, d in zip(offsets[:-1], offsets[1:], marks[:-1], marks[1:])
        ]
        at = [part.schema.get_field_index(f"c{i}") for i in range(len(held))]
        values = [pa.array([g[i] for g in got]) for i in range(len(new))]
        return pa.RecordBatch.from_arrays([*[part.column(i) for i in at], *values], names=[*held, *names])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that certainly have no runs."""
        for batch in batches:
            batch = batch.filter(pa.array(~may_hold(shared.value, np.asarray(batch.column(0)))))
            for part, data, offsets in pieces(batch):
                yield finish(part, data, offsets, None)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(shared.value, np.asarray(batch.column(0)))))
            columns = [batch.column(0), pack(batch.column(1)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "packed", *batch.schema.names[2:]])

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for short in unpacked(batch):
                for part, data, offsets in pieces(short, "packed"):
                    yield finish(part, data, offsets, part.column(part.schema.get_field_index("runs")))

    kinds = [StructField("key", LongType()), StructField("packed", BinaryType()), *numbered.schema[2:]]
    joined = numbered.mapInArrow(likely, StructType(kinds)).join(runs, "key", "left")
    return numbered.mapInArrow(untouched, schema).unionByName(joined.mapInArrow(cut_out, schema))
