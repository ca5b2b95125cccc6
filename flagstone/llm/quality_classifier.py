"""Document quality by a factorisation machine.

Inputs of a document: its distinct lower-cased words, hashed to `WORD_COLUMNS` columns; structure
statistics of the text (shares of capitals, digits, symbols, separators, line ends, word lengths,
repetition) and the metadata column `n_chars` against the true length, each cut to bins. Labels,
language, source and id are no inputs. The score is the logistic of bias, weights and all pairwise
interactions, in time linear in the inputs by the sum-of-squares identity.

The fit takes at most `max_rows` labelled rows outside the held-out part, chosen by a hash of the id;
only their hashed columns reach the driver. Scoring is a map over all documents: no shuffle.

Cases: a null or empty text has no words and is scored by its statistics; a null id counts as the
empty id for the split and is never used to learn; a null label is no label; of several labels for
one id the largest counts; repeated rows give repeated results; without any label every score is
0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.llm import linear
from flagstone.llm.text import distinct, pieces, words

WORD_COLUMNS = 1 << 16
BINS = 16
MAX_ROWS = 6_000
_CLASSES = {
    "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&@^~=+_\\",
    "bang": b"!?",
    "separator": b"|/<>{}[]",
    "line": b"\n",
    "stop": b".",
    "comma": b",;:",
}
STATISTICS = [*_CLASSES, "wide", "length", "distinct", "word_length", "line_length", "metadata"]
WIDTH = WORD_COLUMNS + len(STATISTICS) * BINS


def _bin(share: np.ndarray) -> np.ndarray:
    """Bins of doubling width for shares from 0 to 1."""
    return np.clip(np.ceil(np.log2(np.maximum(share, 0) * 16384 + 1)), 0, BINS - 1).astype(np.int64)


def statistics(
    data: np.ndarray, offsets: np.ndarray, n_words: np.ndarray, n_distinct: np.ndarray, n_chars: np.ndarray
) -> np.ndarray:
    """Bin of each statistic (columns) for each text (rows); n_chars is NaN where not known."""
    size = np.diff(offsets)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])

    out = []
    floor = np.maximum(size, 1)
    for letters in _CLASSES.values():
        member = np.zeros(256, bool)
        member[list(letters)] = True
        out.append(_bin(count(member[data]) / floor))
    wide = count((data & 0xC0) == 0x80)
    out.append(_bin(wide / floor))
    out.append(np.clip(np.log2(n_words + 1), 0, BINS - 1).astype(np.int64))
    out.append(np.floor(n_distinct / np.maximum(n_words, 1) * (BINS - 1)).astype(np.int64))
    chars = size - wide
    out.append(np.clip(chars / np.maximum(n_words, 1), 0, BINS - 1).astype(np.int64))
    lines = count(data == 0x0A) + 1
    out.append(np.clip(np.log2(n_words / lines + 1) * 1.5, 0, BINS - 1).astype(np.int64))
    metadata = np.where(np.isnan(n_chars), 0, np.where(n_chars == chars, 1, 2))
    out.append(metadata.astype(np.int64))
    return np.stack(out, axis=1)


def inputs(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> linear.Rows:
    """Sparse inputs of texts: words with equal shares of length 1, statistics with value 1/4."""
    w = words(data, offsets, lower=True)
    columns = (w.hash & np.uint64(WORD_COLUMNS - 1)).astype(np.int64)
    pairs = distinct(w.text * WORD_COLUMNS + columns)
    owner, columns = pairs // WORD_COLUMNS, pairs % WORD_COLUMNS
    n = len(offsets) - 1
    n_distinct = np.bincount(owner, minlength=n)
    stats = statistics(data, offsets, w.count, n_distinct, n_chars)
    stats += WORD_COLUMNS + np.arange(stats.shape[1]) * BINS
    held = stats.shape[1]
    first = np.concatenate([[0], np.cumsum(n_distinct + held)])
    out, values = np.empty(first[-1], np.int64), np.empty(first[-1])
    at = first[owner] + held + np.arange(len(pairs)) - np.concatenate([[0], np.cumsum(n_distinct)])[owner]
    out[at] = columns
    values[at] = 1 / np.sqrt(n_distinct[owner])
    at = (first[:-1, None] + np.arange(held)).ravel()
    out[at] = stats.ravel()
    values[at] = 0.25
    return linear.Rows(first, out, values)


def _batch_inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, linear.Rows]]:
    for batch in batches:
        for part, data, offsets in pieces(batch):
            chars = part.column(part.schema.get_field_index("n_chars")).cast(pa.float64())
            known = np.array(chars.fill_null(np.nan), dtype=float)
            yield part, inputs(data, offsets, known)


def _columns(df: DataFrame, *more: str) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in df.columns else F.lit(None).cast("double")
    return df.select(*more, F.col("text").cast("string").alias("text"), chars.alias("n_chars"))


def remainder(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5


def sample_labels(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most `max_rows` (doc_id, y) outside the held-out part, chosen by a hash of the id."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(remainder(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS
) -> linear.Factors:
    """Learn from at most `max_rows` labelled rows."""
    chosen = F.broadcast(sample_labels(labels, label, max_rows))  # at most max_rows
    rows = _columns(documents.join(chosen, "doc_id").select("text", "y", *_chars(documents)), "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _batch_inputs(batches):
            cut = [slice(a, b) for a, b in zip(x.first.tolist(), x.first[1:].tolist())]
            columns = x.columns.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int32()),
                    pa.array([columns[c].tobytes() for c in cut], pa.binary()),
                ],
                names=["y", "columns"],
            )

    got = rows.mapInArrow(work, "y int, columns binary").collect()
    got.sort(key=lambda r: (r.y, r.columns))  # one order, however Spark delivers them
    held = len(STATISTICS)
    columns = [np.frombuffer(r.columns, np.int32).astype(np.int64) for r in got]
    lengths = np.array([len(c) for c in columns], np.int64)
    values = [
        np.concatenate([np.full(held, 0.25), np.full(n - held, 1 / np.sqrt(max(n - held, 1)))])
        for n in lengths
    ]
    data = linear.Rows(
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        np.concatenate([*columns, np.zeros(0, np.int64)]),
        np.concatenate([*values, np.zeros(0)]),
    )
    return linear.fit_factors(data, np.array([r.y for r in got], float), WIDTH)


def _chars(df: DataFrame) -> list[str]:
    return ["n_chars"] if "n_chars" in df.columns else []


def score(documents: DataFrame, model: linear.Factors) -> DataFrame:
    """doc_id and score of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = _columns(documents, "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _batch_inputs(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(shared.value.probability(x))], names=["doc_id", "score"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(documents, fit(documents, labels))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
