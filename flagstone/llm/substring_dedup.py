"""Removal of word sequences that an earlier document has too, by De Bruijn compaction.

The graph's edges are the windows of `n` words. Edges of one document that share their minimiser
(the least-hashed run of `m` words among those in the window) stand next to each other and form a
nonbranching path; a path is one row, not one row per edge. Equal windows have equal minimisers,
so edges can only be equal if their paths have the same one:

1. rows of paths whose minimiser occurs in one document only are left out;
2. equal paths compact into one by a join on (minimiser, path), owned by the smallest document;
   every occurrence in a larger document is repeated as a whole;
3. where several different paths share a minimiser (the graph branches), the owners' paths are
   opened into edges, and each edge is owned by the smallest document that has it. Edges come
   from the texts at the coordinates of the owner, with its full window hash.

Removed words are those under an edge whose owner has a smaller id. Minimiser and path (or edge)
hashes, 128 bits together, decide equality. All groupings are counts and minima, combined before
the shuffle; joins on a repeated path are plain equi-joins that adaptive execution splits, and
each has one row per path on its other side. Nothing is gathered but a document's own intervals.

Cases: a null or empty text has no words; a null id counts as larger than every id; rows equal in
id and text share their result, and rows of equal id are never removed for each other; a text
longer than `text.PIECE` bytes is handled whole; an empty table gives an empty result; other
columns are kept by `remove_repeats`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.llm.keyfilter import key_bits
from flagstone.llm.runs import apply_runs, covered, packed_texts, unpacked
from flagstone.llm.text import Words, pieces, rolling, words
from flagstone.sources.scratch import staged

WINDOW = 50
MINIMISER = 12
LAST = (1 << 63) - 1


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Position of the (leftmost) least value in each run of `width` values."""
    at = np.arange(len(x))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(x[right] < x[left], right, left)
        have += step
    return at


def window_starts(w: Words, n: int) -> np.ndarray:
    """Where windows of n words of one text start."""
    count = w.count
    valid = np.ones(len(w.hash), bool)
    for back in range(1, n):
        valid[(w.first[1:] - back)[count >= back]] = False
    return np.flatnonzero(valid)


def paths(w: Words, n: int, m: int) -> tuple[np.ndarray, ...]:
    """Paths of windows with one minimiser: text, first word in the piece, windows, minimiser, path."""
    starts = window_starts(w, n)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = np.arange(len(w.hash) - m + 1)
    small = rolling(w.hash, at, at + m)
    least = sliding_argmin(small, n - m + 1)[starts]
    text = w.text[starts]
    cut = np.ones(len(starts), bool)
    cut[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(cut)
    size = np.diff(np.append(begins, len(starts)))
    first = starts[begins]
    return text[begins], first, size, small[least[begins]], rolling(w.hash, first, first + size + n - 1)


def _keyed(df: DataFrame) -> DataFrame:
    """Order of the document, identity of the row, text."""
    return df.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64("doc_id", "text").alias("key"),
        F.col("text").cast("string").alias("text"),
    )


def _path_rows(df: DataFrame, n: int, m: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                w = words(data, offsets)
                text, first, size, seed, path = paths(w, n, m)
                doc = np.asarray(part.column(0))[text]
                key = np.asarray(part.column(1))[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seed.view(np.int64)),
                        pa.array(path.view(np.int64)),
                        pa.array(doc),
                        pa.array(key),
                        pa.array((first - w.first[text]).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                    ],
                    names=["seed", "path", "doc", "key", "at", "size"],
                )

    return df.mapInArrow(work, "seed long, path long, doc long, key long, at int, size int")


def _edges(opened: DataFrame, n: int) -> DataFrame:
    """Windows of the owners' paths: rows of opened have text and lists of (seed, path, at, size)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in (p for b in batches for u in unpacked(b) for p in pieces(u, "packed")):
            w = words(data, offsets)
            lists = part.column(part.schema.get_field_index("paths"))
            cells = lists.flatten()
            seed, path, at, size = (np.asarray(cells.field(i)) for i in range(4))
            text = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths()))
            doc = np.asarray(part.column(part.schema.get_field_index("doc")))[text]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            row = np.repeat(np.arange(len(size)), size)
            offset = np.arange(total) - (ends - size)[row]
            start = (w.first[text] + at)[row] + offset
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(seed[row]),
                    pa.array(rolling(w.hash, start, start + n).view(np.int64)),
                    pa.array(path[row]),
                    pa.array(offset.astype(np.int32)),
                    pa.array(doc[row]),
                ],
                names=["seed", "edge", "path", "at", "doc"],
            )

    return opened.mapInArrow(work, "seed long, edge long, path long, at int, doc long")


def repeated_runs(documents: DataFrame, n: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """key and runs (array of first word and end) of each document with repeated windows."""
    docs = _keyed(documents)
    rows = staged(_path_rows(docs, n, m), "paths")
    seeds = rows.groupBy("seed").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    # Written first: a join with a table can be split where a seed is hot, one with an aggregate not.
    seeds = staged(seeds.where("low < high").select("seed"), "seeds")
    rows = staged(rows.join(seeds, "seed", "left_semi"), "shared-paths")
    found = staged(
        rows.groupBy("seed", "path").agg(F.min(F.struct("doc", "key", "at", "size")).alias("owner")),
        "compacted",
    )
    branching = staged(found.groupBy("seed").count().where("count > 1").select("seed"), "branching")
    opened = (
        found.join(branching, "seed", "left_semi")
        .groupBy(F.col("owner.key").alias("key"))
        .agg(
            F.first("owner.doc").alias("doc"),
            F.collect_list(
                F.struct("seed", "path", F.col("owner.at").alias("at"), F.col("owner.size").alias("size"))
            ).alias("paths"),
        )
    )
    opened = staged(opened, "opened")
    texts = packed_texts(docs, key_bits(opened, "key")).dropDuplicates(["key"])
    edges = staged(_edges(opened.join(texts, "key"), n), "edges")
    owners = edges.groupBy("seed", "edge").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    owners = staged(owners.where("low < high").select("seed", "edge", "low"), "owners")
    cut = (
        edges.join(owners, ["seed", "edge"])
        .where("low < doc")
        .groupBy("seed", "path")
        .agg(F.collect_set("at").alias("offsets"))  # at most n - m + 1
    )
    decided = found.select("seed", "path", F.col("owner.doc").alias("low"))
    decided = staged(decided.join(cut, ["seed", "path"], "left"), "decided")
    whole = F.array(F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size") + n - 1).alias("end")))
    single = F.transform(
        "offsets",
        lambda o: F.struct((F.col("at") + o).alias("start"), (F.col("at") + o + n).alias("end")),
    )
    runs = rows.join(decided, ["seed", "path"]).select(
        "key", F.when(F.col("low") < F.col("doc"), whole).otherwise(single).alias("runs")
    )
    return staged(
        runs.where("runs is not null").groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("runs")),
        "runs",
    )


def _kept(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Words, removed words and kept words joined by one space."""
    found = text.tobytes().split()  # splits at exactly the six white bytes
    if not len(starts):
        return len(found), 0, b" ".join(found)
    gone = covered(len(found), starts, ends)
    return len(found), int(gone.sum()), b" ".join([found[i] for i in np.flatnonzero(~gone)])


def remove_repeats(
    documents: DataFrame, n: int = WINDOW, m: int = MINIMISER, output: str = "kept"
) -> DataFrame:
    """The documents with n_words and n_removed, and in place of the text, by `output`:

    kept     a column of that name, the kept words joined by one space
    digest   the same as SHA-256
    replace  `text` as it was, or the kept words joined by one space where words were removed

    New columns replace those of their names.
    """

    def cut(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
        n_words, n_removed, kept = _kept(text, starts, ends)
        if output == "digest":
            return n_words, n_removed, hashlib.sha256(kept).hexdigest()
        if output == "replace" and not n_removed:
            kept = text.tobytes()
        return n_words, n_removed, kept.decode()

    name = "text" if output == "replace" else "kept"
    new = [("n_words", "long"), ("n_removed", "long"), (name, "string")]
    return apply_runs(documents, repeated_runs(documents, n, m), new, cut, ("text",))
