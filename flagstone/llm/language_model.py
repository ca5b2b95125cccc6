"""Scores of texts by a bigram model whose tables are Elias-Fano tries, one per part of the words.

Model: p(w | c) = (count(c w) + MASS * p(w)) / (count(c) + MASS), a Dirichlet prior around the
additive unigram p(w) = (count(w) + 0.1) / (N + 0.1 (V + 1)). Contexts of the first word are one
start mark; the end of a text is a token. Numerators are stored with the predicted word, and a
context's denominator with the context, so each token's terms come from the part that holds its
word, and a text's score is the sum over parts.

Words are dealt into parts by their hash; a word with more than 1 / `HOT_SHARE` of all tokens
(there are fewer than HOT_SHARE of them, so their list is broadcast) is dealt by word and context.
There is one part per `PART_TOKENS` tokens, so parts stay the same size as the corpus grows. Texts
are cut into blocks of about `BLOCK_TOKENS` tokens; a block sends each part its distinct words,
their distinct contexts, and for each the documents where it occurs, by their place in the block. A part adds up the training
counts of all blocks, builds its trie (words, pointers, contexts, quantised values), maps it into
memory and answers each distinct bigram by context-relative successor search. It returns the sums
of each block's documents in one row; the block's rows are combined at the end. One very frequent bigram's document references meet in one part: two to
four bytes a document, already without text.

Words and bigrams are known by 64-bit hashes. Counts are over all training documents, without cuts.

Cases: a null or empty text has the end as its only token; a null id counts as the empty id for
the split; rows equal in id and text share their result (each is counted in training); with an
empty training part every word is unknown; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.llm.elias_fano import Trie
from flagstone.llm.text import mix, pack_ints, pieces, unpack_ints, words
from flagstone.sources.scratch import staged

MASS = 300.0
ALPHA = 0.1
HOT_SHARE = 1_000
PART_TOKENS = 1_500_000
BLOCK_TOKENS = 1_500_000
START, END = np.uint64(0x5374617274), np.uint64(0x456E64)
_TURN = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 10 == 0


def tokens(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token (words, then the end), of its context, and its text."""
    w = words(data, offsets, lower=True)
    predicted = np.insert(w.hash, w.first[1:], END)
    context = np.insert(w.hash, w.first[:-1], START)
    return predicted, context, np.repeat(np.arange(len(offsets) - 1), w.count + 1)


def unigrams(docs: DataFrame) -> DataFrame:
    """word and count over the training documents; counts are combined per task first."""

    def merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        names, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([h[1] for h in held]), minlength=len(names))
        return names, counts.astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, data, offsets in pieces(batch):
                found = np.unique(tokens(data, offsets)[0], return_counts=True)
                held.append(found)
                size += len(found[0])
                if size > 2_000_000:
                    held = [merge(held)]
                    if len(held[0][0]) > 1_000_000:
                        yield _counts(*held.pop())
                    size = sum(len(h[0]) for h in held)
        if held:
            yield _counts(*merge(held))

    train = docs.where("train").select("text")
    return train.mapInArrow(work, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))


def _counts(names: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(names.view(np.int64)), pa.array(counts)], names=["word", "count"]
    )


def _blocks(docs: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """One row for each block and part; see the module's text."""
    names = ["part", "block", "docs", "train", "words", "n_contexts", "contexts", "n_texts", "texts"]

    def pack(held: list[tuple], block: int) -> Iterator[pa.RecordBatch]:
        predicted = np.concatenate([h[0] for h in held])
        context = np.concatenate([h[1] for h in held])
        sizes = np.cumsum([0, *[len(h[3]) for h in held]])
        text = np.concatenate([h[2] + base for h, base in zip(held, sizes)])
        keys, train = np.concatenate([h[3] for h in held]), np.concatenate([h[4] for h in held])
        word_names, word = np.unique(predicted, return_inverse=True)
        part = (word_names % np.uint64(parts)).astype(np.int64)[word]
        if len(hot):
            is_hot = np.isin(word_names, hot)[word]
            crossed = mix(predicted[is_hot] ^ (context[is_hot] * _TURN))
            part[is_hot] = (crossed % np.uint64(parts)).astype(np.int64)
        _, number = np.unique(context, return_inverse=True)
        order = np.lexsort((number, word, part)) if len(part) >= 1 << 21 or parts >= 1 << 21 else np.argsort(
            (part << 42) | (word << 21) | number, kind="stable"
        )
        predicted, context, text, part = predicted[order], context[order], text[order], part[order]
        new_part = np.concatenate([[True], part[1:] != part[:-1]])
        new_word = new_part | np.concatenate([[True], predicted[1:] != predicted[:-1]])
        new_pair = new_word | np.concatenate([[True], context[1:] != context[:-1]])
        pair_at, word_at = np.flatnonzero(new_pair), np.flatnonzero(new_word)
        n_texts = np.diff(np.append(pair_at, len(text))).astype(np.uint32)
        n_contexts = np.diff(np.append(np.searchsorted(pair_at, word_at), len(pair_at))).astype(np.uint32)
        cuts = np.append(np.flatnonzero(new_part), len(text))
        pair_cuts, word_cuts = np.searchsorted(pair_at, cuts), np.searchsorted(word_at, cuts)
        # The documents' keys go to where the block's sums are put together, past all parts.
        rows: list[list] = [[-1 - block % parts], [block], [keys.tobytes()], *[[None] for _ in names[3:]]]
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            used, local = np.unique(text[a:b], return_inverse=True)
            pairs = slice(pair_cuts[i], pair_cuts[i + 1])
            found = slice(word_cuts[i], word_cuts[i + 1])
            for column, value in zip(
                rows,
                (
                    int(part[a]),
                    block,
                    pack_ints(used),
                    np.packbits(train[used]).tobytes(),
                    predicted[word_at[found]].tobytes(),
                    pack_ints(n_contexts[found]),
                    context[pair_at[pairs]].tobytes(),
                    pack_ints(n_texts[pairs]),
                    pack_ints(local),
                ),
            ):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 7]
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, block = 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for sub, data, offsets in pieces(batch):
                found = tokens(data, offsets)
                key = np.asarray(sub.column(sub.schema.get_field_index("key")))
                train = np.array(sub.column(sub.schema.get_field_index("train")).to_pylist(), np.uint8)
                held.append((*found, key, train))
                size += len(found[0])
                if size >= BLOCK_TOKENS:
                    yield from pack(held, block)
                    held, size, block = [], 0, block + 1
        if held:
            yield from pack(held, block)

    fields = ", ".join(f"{n} binary" for n in names[2:])
    return docs.select("key", "train", "text").mapInArrow(work, f"part long, block long, {fields}")


def part_counts(
    block_words: list[np.ndarray], block_contexts: list[np.ndarray], block_train: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, context), training count, and each block row's place among them."""
    word, context = np.concatenate(block_words), np.concatenate(block_contexts)
    order = np.lexsort((context, word))
    word, context = word[order], context[order]
    new = np.ones(len(order), bool)
    new[1:] = (word[1:] != word[:-1]) | (context[1:] != context[:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    counts = np.bincount(place, np.concatenate(block_train), minlength=int(new.sum()))
    return word[new], context[new], counts, place


def score_part(
    rows: list[dict], total: int, distinct: int, hot: np.ndarray, hot_counts: np.ndarray
) -> list[tuple[np.ndarray, ...]]:
    """For each row: documents, their tokens, known tokens, base and model sums in the part."""
    split = []
    for row in rows:
        docs = unpack_ints(row["docs"])
        train = np.unpackbits(np.frombuffer(row["train"], np.uint8))
        word = np.repeat(np.frombuffer(row["words"], np.uint64), unpack_ints(row["n_contexts"]))
        n_texts, text = unpack_ints(row["n_texts"]), unpack_ints(row["texts"])
        starts = np.cumsum(n_texts) - n_texts
        trained = np.add.reduceat(train[text].astype(np.int64), starts)
        split.append((docs, word, np.frombuffer(row["contexts"], np.uint64), n_texts, text, trained))
    word, context, counts, place = part_counts(
        [s[1] for s in split], [s[2] for s in split], [s[5] for s in split]
    )
    names, owner = np.unique(word, return_inverse=True)
    of_word = np.bincount(owner, counts, minlength=len(names))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
        of_word = np.where(hot[at] == names, hot_counts[at], of_word)
    share = (of_word + ALPHA) / (total + ALPHA * (distinct + 1))
    known = of_word > 0
    seen = counts > 0
    names_at = np.cumsum(known) - 1
    trie = Trie.map(
        Trie.build(
            names[known],
            np.log10(MASS * share[known]),
            names_at[owner[seen]],
            context[seen],
            np.log10(counts[seen] + MASS * share[owner[seen]]),
        ).to_bytes()
    )
    unknown = np.log10(MASS * ALPHA / (total + ALPHA * (distinct + 1)))
    top = trie.query(names, owner, context, unknown)
    # A word is the context of the token after it; the end is no context.
    as_context = np.where(names == END, 0.0, -np.log10(of_word + MASS))
    model = top + as_context[owner]
    base = np.log10(of_word + ALPHA)[owner]
    known = known[owner]
    out = []
    low = 0
    for docs, block_word, _, n_texts, text, _ in split:
        at = np.repeat(place[low : low + len(block_word)], n_texts)
        low += len(block_word)
        n = len(docs)
        out.append(
            (
                docs,
                np.bincount(text, minlength=n),
                np.bincount(text, known[at], minlength=n).astype(np.int64),
                np.bincount(text, base[at], minlength=n),
                np.bincount(text, model[at], minlength=n),
            )
        )
    return out


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = documents.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("key"),
        (~held_out(F.col("doc_id"))).alias("train"),
        F.col("text").cast("string").alias("text"),
    )
    counts = staged(unigrams(docs), "unigrams")
    all_ = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(all_.n), int(all_.v)
    rows = counts.where(F.col("count") * HOT_SHARE > total).toPandas()  # fewer than HOT_SHARE
    hot = rows["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, hot_counts = hot[order], rows["count"].to_numpy(np.int64)[order]
    n_train = int(hot_counts[hot == END].sum()) or int(
        counts.where(F.col("word") == int(END)).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    )
    parts = max(1, -(-total // PART_TOKENS))
    blocks = _blocks(docs, parts, hot)
    shared = docs.sparkSession.sparkContext.broadcast((hot, hot_counts))

    names = ["docs", "n_tokens", "n_known", "base", "model"]

    def work(group: pa.Table) -> pa.Table:
        """A part's sums, one packed row for each block; the keys of a block pass through."""
        if group.column("part")[0].as_py() < 0:
            nothing = pa.nulls(group.num_rows, pa.binary())
            return pa.table([group.column("block"), group.column("docs"), *[nothing] * 5], names=["block", "keys", *names])
        got = score_part(group.to_pylist(), total, distinct, *shared.value)
        packed = [pa.array([pack_ints(g[i]) for g in got], pa.binary()) for i in range(3)]
        packed += [pa.array([g[i].tobytes() for g in got], pa.binary()) for i in (3, 4)]
        return pa.table([group.column("block"), pa.nulls(len(got), pa.binary()), *packed], names=["block", "keys", *names])

    def combine(group: pa.Table) -> pa.Table:
        """A block's sums over all parts: at most BLOCK_TOKENS entries come together."""
        keys = next(k for k in group.column("keys").to_pylist() if k is not None)
        keys = np.frombuffer(keys, np.int64)
        sums = [np.zeros(len(keys), kind) for kind in (np.int64, np.int64, np.float64, np.float64)]
        for i in range(group.num_rows):
            docs, *values = (group.column(name)[i].as_py() for name in names)
            if docs is None:
                continue
            docs = unpack_ints(docs)
            for held, value in zip(sums[:2], values[:2]):
                held[docs] += unpack_ints(value)
            for held, value in zip(sums[2:], values[2:]):
                held[docs] += np.frombuffer(value, np.float64)
        return pa.table([pa.array(keys), *map(pa.array, sums)], names=["key", *names[1:]])

    parted = blocks.groupBy("part").applyInArrow(
        work, "block long, keys binary, " + ", ".join(f"{n} binary" for n in names)
    )
    schema = "key long, n_tokens long, n_known long, base double, model double"
    sums = parted.groupBy("block").applyInArrow(combine, schema).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "model")]
    )
    # Rows equal in id and text were added up together; each has its share.
    same = docs.groupBy("key").agg(F.count("*").alias("copies"))
    start = float(np.log10(n_train + MASS))
    per_token = float(np.log10(total + ALPHA * (distinct + 1)))
    rows = docs.select("doc_id", "key", "train").join(sums.join(same, "key"), "key", "left")
    n_tokens = F.expr("n_tokens div copies")
    return rows.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        n_tokens.alias("n_tokens"),
        F.expr("n_known div copies").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies") - n_tokens * per_token).alias("base_score"),
        (F.col("model") / F.col("copies") - start).alias("score"),
    )
