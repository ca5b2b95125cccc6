"""Toxicity by a classifier chain of linear models.

Categories are predicted in order; each model also takes the probabilities of the categories
before it. For training these are out-of-fold predictions: the rows are cut into `FOLDS` parts by
a hash of the id, and a part's probabilities come from a model fitted on the others. The last
category is the label itself; a category before it holds for labelled toxic rows with one of its
seed words, and `other` for toxic rows without any.

Inputs are the distinct words of a text (runs of letters and digits, lower-cased) and their
beginnings of 4, 5 and 6 bytes, hashed, so that inflected forms share evidence.

The fit takes at most `max_rows` toxic and `max_rows` other labelled rows, chosen by a hash of the
id; rows are weighted back to the share of each class among all labels. Only hashed columns reach
the driver. Scoring is a map over all documents: no shuffle.

Cases: a null or empty text has no inputs and gets the chain's base rate; a null id is scored and
never used to learn; a null label is no label; of several labels for one id the largest counts;
repeated rows give repeated results; without toxic labels nothing is toxic; other columns are kept
by `reject` and ignored by the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.llm import linear
from flagstone.llm.text import distinct, hash_intervals, lower_case, pieces, words

COLUMNS = 1 << 18
MAX_ROWS = 4_000
FOLDS = 3
MIN_ROWS = 4  # of the sample in which a column must occur
BEGINNINGS = (4, 5, 6)
SEEDS = {
    "insult": ("idiot", "loser", "moron", "scum", "clown"),
    "contempt": ("pathetic", "worthless", "trash", "disgusting", "stupid"),
}
CATEGORIES = (*SEEDS, "other", "toxic")
THRESHOLD = 0.5

_GAPS = np.ones(256, bool)
_GAPS[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False
_GAPS[128:] = False


def inputs(data: np.ndarray, offsets: np.ndarray) -> linear.Rows:
    """Hashed words and beginnings of texts, each with value 1."""
    low = lower_case(data)
    w = words(low, offsets, gaps=_GAPS)
    owner = w.text
    hashes, owners = [w.hash], [owner]
    for n in BEGINNINGS:
        longer = w.end - w.start > n
        start = w.start[longer]
        hashes.append(hash_intervals(low, start, start + n) + np.uint64(n))
        owners.append(owner[longer])
    columns = (np.concatenate(hashes) & np.uint64(COLUMNS - 1)).astype(np.int64)
    pairs = distinct(np.concatenate(owners) * COLUMNS + columns)
    owner = pairs // COLUMNS
    first = np.searchsorted(owner, np.arange(len(offsets)))
    return linear.Rows(first, pairs % COLUMNS, np.ones(len(pairs)))


@dataclass
class Chain:
    """Linear models in the order of `categories`."""

    categories: tuple[str, ...]
    models: list[linear.Linear]

    def probabilities(self, rows: linear.Rows) -> np.ndarray:
        found = np.zeros((len(rows), 0))
        for model in self.models:
            found = np.column_stack([found, model.probability(rows, found - 0.5)])
        return found


def fit_chain(
    rows: linear.Rows, targets: np.ndarray, row_weights: np.ndarray, fold: np.ndarray
) -> Chain:
    """targets has a column for each category."""
    models: list[linear.Linear] = []
    before = np.zeros((len(rows), 0))
    for k in range(targets.shape[1]):
        y = targets[:, k]
        models.append(linear.fit_linear(rows, before - 0.5, y, row_weights, COLUMNS))
        if k + 1 < targets.shape[1]:
            out = np.zeros(len(rows))
            for part in range(FOLDS):
                train, test = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
                model = linear.fit_linear(
                    rows.take(train), before[train] - 0.5, y[train], row_weights[train], COLUMNS
                )
                out[test] = model.probability(rows.take(test), before[test] - 0.5)
            before = np.column_stack([before, out])
    return Chain(CATEGORIES, models)


def sample_labels(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most `max_rows` (doc_id, y) of each class, chosen by a hash of the id."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )

    def of(y: int) -> DataFrame:
        return known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    return of(1).unionByName(of(0))


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS
) -> Chain:
    """Learn the chain from at most 2 * max_rows labelled rows."""
    share = labels.where(F.col(label).isNotNull()).agg(F.avg(label)).first()[0]
    chosen = F.broadcast(sample_labels(labels, label, max_rows))
    low = F.lower("text")

    def holds(seeds: tuple[str, ...]) -> F.Column:
        return low.rlike(r"(^|[^a-z0-9])(" + "|".join(seeds) + r")([^a-z0-9]|$)")

    rows = documents.join(chosen, "doc_id").select(
        F.col("text").cast("string").alias("text"),
        "y",
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int").alias("fold"),
        *[F.coalesce(holds(s), F.lit(False)).alias(name) for name, s in SEEDS.items()],
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                x = inputs(data, offsets)
                columns = x.columns.astype(np.int32)
                cut = [slice(a, b) for a, b in zip(x.first.tolist(), x.first[1:].tolist())]
                packed = pa.array([columns[c].tobytes() for c in cut], pa.binary())
                names = part.schema.names
                kept = [n for n in names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(names.index(n)) for n in kept], packed], names=[*kept, "columns"]
                )

    schema = T.StructType([f for f in rows.schema if f.name != "text"]).add("columns", "binary")
    got = rows.mapInArrow(work, schema).collect()
    got.sort(key=lambda r: (r.y, r.fold, r.columns))
    columns = [np.frombuffer(r.columns, np.int32) for r in got]
    first = np.concatenate([[0], np.cumsum([len(c) for c in columns])]).astype(np.int64)
    flat = np.concatenate([*columns, np.zeros(0, np.int32)]).astype(np.int64)
    common = np.bincount(flat, minlength=COLUMNS) >= MIN_ROWS
    data = linear.Rows(first, flat, np.ones(len(flat))).only(common)
    y = np.array([r.y for r in got], float)
    named = np.array([[r[name] for name in SEEDS] for r in got], float).reshape(len(got), len(SEEDS))
    targets = np.column_stack([named * y[:, None], y * (named.sum(axis=1) == 0), y])
    share = float(share or 0.0)
    ones = max(y.sum(), 1)
    weights = np.where(y == 1, share / ones, (1 - share) / max(len(y) - ones, 1))
    return fit_chain(data, targets, weights, np.array([r.fold for r in got], np.int64))


def score(documents: DataFrame, chain: Chain, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and the probability of each category, `p_<category>`."""
    shared = documents.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]
    kept = documents.select(*keep)
    rows = documents.select(*keep, F.col("text").cast("string").alias("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "_text"):
                found = shared.value.probabilities(inputs(data, offsets))
                arrays = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, *[pa.array(c) for c in found.T]], names=[*keep, *names]
                )

    schema = T.StructType([*kept.schema, *[T.StructField(n, T.DoubleType()) for n in names]])
    return rows.mapInArrow(work, schema)


def classify(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, a probability for each category, score (that of the last one), predicted, toxic."""
    scored = score(documents, fit(documents, labels))
    toxic = F.col("p_toxic") >= threshold
    return scored.select(
        "*", F.col("p_toxic").alias("score"), toxic.cast("int").alias("predicted"), toxic.alias("toxic")
    )


def reject(documents: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(chain)
    place = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [str(i) for i in range(batch.num_columns)]  # columns may share names
            numbered = pa.RecordBatch.from_arrays(batch.columns, names=names)
            for part, data, offsets in pieces(numbered, names[place]):
                toxic = shared.value.probabilities(inputs(data, offsets))[:, -1]
                kept = part.filter(pa.array(toxic < threshold))
                yield pa.RecordBatch.from_arrays(kept.columns, names=batch.schema.names)

    return documents.mapInArrow(work, documents.schema)
