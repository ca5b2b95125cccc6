"""Near duplicates by an exact Jaccard join on word n-grams, with prefix filtering.

A text's set holds its distinct runs of `size` lower-cased words (fewer words: the whole sequence
as one). Sets link when 100 * intersection >= percent * union. Rows that agree in the whole set
are one class from the start. Then:

* the n-grams of a set are ordered from rare to frequent: n-grams outside the list of frequent ones
  come first, by hash, then the listed ones by their count. Linked sets share an n-gram in the
  first |x| - ceil(t |x|) + 1 of this order (prefix filter), and the first one they share leaves
  room for enough others behind it (positional filter) and their sizes agree (length filter);
* sets that share a rare prefix n-gram (at most `SMALL` sets have it) are listed in pairs. Sets
  that share a more frequent one are compared through one pivot per n-gram first, so a group of
  near copies costs one comparison per member; further rounds take other pivots while they
  connect many; after that only pairs whose members are not yet connected are listed. So no link between different components is lost, and no large group is
  expanded into all its pairs;
* common n-grams that are not in both prefixes lie behind one of them, so a pair's common prefix
  n-grams (counted, or bounded by the shared ones of each set) and the longer suffix bound the
  intersection; bitmaps of each set (the parity of its n-grams' hashes in `BITS` cells) bound
  the difference from below as well (suffix filter);
* a remaining pair is compared once, n-gram by n-gram.

The list of frequent n-grams has at most `SHARE` members per mean set size, and only orders the
n-grams: any order gives the same links. Frequent prefix n-grams skip the window over one n-gram's
rows, so such a window never holds a hot n-gram; pivots are minima, combined before the shuffle,
and joined back by a plain equi-join that adaptive execution splits.

Cases: a null or empty text, or one without words, has an empty set and links with nothing; a null id
is ignored as a component's id unless no other is there; repeated rows are in one class; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.llm.components import components
from flagstone.llm.keyfilter import key_bits
from flagstone.llm.runs import packed_texts, unpacked
from flagstone.llm.text import fresh, grams, mix, pieces, words
from flagstone.sources.scratch import staged

SIZE = 5
PERCENT = 75
BITS = 1024
SMALL = 32
SHARE = 2_000  # an n-gram in more than 1 / SHARE of the documents is frequent
COUNTED = 1 << 20  # bytes of text whose n-grams are counted together
# Rounds of pivots go on while more pairs than CROSSING a set could be listed, and while a round
# leaves no more than GAIN of them; what is left then is listed.
CROSSING = 1
GAIN = 0.8


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of the distinct n-grams of each text, ascending."""
    hashes, text = grams(words(data, offsets, lower=True), size)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return text[new], hashes[new]


def set_ids(text: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """An id of each set: two sums of scrambled hashes, scrambled again."""
    ends = np.searchsorted(text, np.arange(n + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes))])
    other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))])
    a, b = total[ends[1:]] - total[ends[:-1]], other[ends[1:]] - other[ends[:-1]]
    return mix(a ^ mix(b + np.diff(ends).astype(np.uint64))).view(np.int64)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """Identity, id of the set, its size and bitmap, for every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                text, hashes = shingle_sets(data, offsets, size)
                rows = part.num_rows
                cells = np.bincount(
                    text * BITS + (hashes >> np.uint64(54)).astype(np.int64), minlength=rows * BITS
                )
                parity = np.packbits((cells & 1).astype(np.uint8)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(set_ids(text, hashes, rows)),
                        pa.array(np.bincount(text, minlength=rows).astype(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(rows + 1, dtype=np.int32) * (BITS // 64)),
                            pa.array(parity),
                        ),
                    ],
                    names=["doc_id", "key", "set", "n", "bitmap"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, key long, set long, n long, bitmap array<long>")


def frequent_grams(docs: DataFrame, size: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of n-grams in more than 1 / SHARE of the documents, and their counts.

    Counts add up runs of text in which an n-gram occurs three times or more.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch, size=COUNTED):
                found, count = np.unique(shingle_sets(data, offsets, size)[1], return_counts=True)
                often = count >= 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[often].view(np.int64)), pa.array(count[often].astype(np.int64))],
                    names=["gram", "count"],
                )

    counted = docs.select("text").mapInArrow(work, "gram long, count long").groupBy("gram")
    rows = counted.agg(F.sum("count").alias("count")).where(F.col("count") > max(n_docs // SHARE, 2))
    got = rows.toPandas()
    hashes = got["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], got["count"].to_numpy(np.int64)[order]


def _prefixes(docs: DataFrame, size: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """gram, set, n, pos, common: the prefix of every set, once per piece and set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts = shared.value
        for batch in batches:
            for part, data, offsets in pieces(batch):
                text, hashes = shingle_sets(data, offsets, size)
                ids = set_ids(text, hashes, part.num_rows)
                n = np.bincount(text, minlength=part.num_rows)
                level = np.zeros(len(hashes), np.int64)
                if len(listed):
                    at = np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)
                    level = np.where(listed[at] == hashes, counts[at], 0)
                order = np.lexsort((hashes, level, text))
                position = np.arange(len(order)) - np.searchsorted(text, text)
                once = np.zeros(part.num_rows, bool)
                once[np.unique(ids, return_index=True)[1]] = True
                prefix = n - (percent * n + 99) // 100 + 1
                keep = (position < prefix[text]) & once[text]
                text, order = text[keep], order[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[order].view(np.int64)),
                        pa.array(ids[text]),
                        pa.array((n[text] << 32) | position[keep]),
                        pa.array(level[order] > 0),
                    ],
                    names=["gram", "set", "place", "common"],
                )

    return docs.select("text").mapInArrow(work, "gram long, set long, place long, common boolean")


def _verify(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b, packed_a, packed_b) that link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in unpacked(batch):
                owner, value = [], []
                for name in ("packed_a", "packed_b"):
                    row = 0
                    for sub, data, offsets in pieces(part, name):
                        text, hashes = shingle_sets(data, offsets, size)
                        owner.append(text + row)
                        value.append(hashes)
                        row += sub.num_rows
                owner, value = np.concatenate(owner), np.concatenate(value)
                order = np.lexsort((value, owner))
                owner, value = owner[order], value[order]
                same = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
                both = np.bincount(owner[1:][same], minlength=part.num_rows)
                union = np.bincount(owner, minlength=part.num_rows) - both
                yield part.select(["a", "b"]).filter(pa.array(100 * both >= percent * union))

    return pairs.mapInArrow(work, "a long, b long")


def classes(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, key (identity of the row), class, n_shingles, component_id of every document."""
    docs = documents.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text")
    )
    sets = staged(_sets(docs, size), "sets")
    frequent = frequent_grams(docs, size, sets.count())
    rows = _prefixes(docs, size, percent, frequent)
    rare = rows.where("not common").drop("common")
    partners = rare.selectExpr(
        "*",
        "min(set) over (partition by gram) as low",
        "max(set) over (partition by gram) as high",
        f"count(*) over (partition by gram) > {SMALL} as many",
    )
    rows = (
        partners.where("low < high")
        .select("gram", "set", "place", "many")
        .unionByName(rows.where("common").select("gram", "set", "place", F.lit(True).alias("many")).distinct())
    )
    rows = staged(rows, "prefixes").selectExpr(
        "gram", "set", "shiftright(place, 32) as n", "place & 4294967295 as pos", "many"
    )
    other = rows.toDF("gram", "set2", "n2", "pos2", "many2")
    need = f"({percent} * (n + n2) + {99 + percent}) div {100 + percent}"  # 100 i >= percent (n + n2 - i)
    sized = f"100 * least(n, n2) >= {percent} * greatest(n, n2)"

    def listed(pairs: DataFrame, others: str | None = None) -> DataFrame:
        """Distinct pairs that pass the length and positional filters, with their common n-grams;
        `others` bounds the common n-grams that are not listed here."""
        kept = pairs.where(sized).selectExpr(
            "least(set, set2) as a", "greatest(set, set2) as b", f"{need} as need",
            f"least(n - pos, n2 - pos2) >= {need} as room", f"{others or need} as others",
        )
        # The first common n-gram needs room for the rest; all of them are counted.
        found = kept.groupBy("a", "b", "need").agg(
            F.count("*").alias("common"), F.max("room").alias("room"), F.max("others").alias("others")
        )
        return found.where("room and common + others >= need").drop("room", "others")

    # Tables, not aggregates, on the side with one row per key: so a hot set or n-gram can be split.
    shared = rows.groupBy("set").agg(
        F.count_if("many").alias("in_many"), F.count_if(~F.col("many")).alias("in_few")
    )
    shape = sets.groupBy("set").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")
    )
    shape = staged(shape.join(shared, "set"), "shape")
    shared = shape.select("set", "in_many", "in_few")

    def verified(pairs: DataFrame, most: str) -> DataFrame:
        """The links among the pairs; `most` bounds their common prefix n-grams."""
        left, right = (
            shape.selectExpr(
                f"set as {x}", f"key as key_{x}", f"n as n_{x}", f"bitmap as bitmap_{x}",
                f"in_many as many_{x}", f"in_few as few_{x}",
            )
            for x in "ab"
        )
        behind = f"({percent} * greatest(n_a, n_b) + 99) div 100 - 1"
        apart = F.aggregate(
            F.zip_with("bitmap_a", "bitmap_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
        )
        near = pairs.join(left, "a").join(right, "b").where(f"{most} + {behind} >= need")
        near = near.where((F.col("n_a") + F.col("n_b") - apart) >= 2 * F.col("need"))
        near = staged(near.select("a", "b", "key_a", "key_b"), "pairs")
        keys = near.select(F.col("key_a").alias("key")).unionByName(near.select(F.col("key_b").alias("key")))
        keys = keys.distinct()
        texts = packed_texts(docs, key_bits(keys, "key"))
        texts = staged(texts.join(keys, "key", "left_semi").dropDuplicates(["key"]), "texts")
        loaded = near.join(texts.toDF("key_a", "packed_a"), "key_a").join(texts.toDF("key_b", "packed_b"), "key_b")
        loaded = loaded.select("a", "b", "packed_a", "packed_b")
        return staged(_verify(loaded, size, percent), "links")

    few = rows.where("not many").join(other.where("not many2"), "gram").where("set < set2")
    links = verified(listed(few), "common + least(many_a, many_b)")
    many = rows.where("many").select("gram", "set", "n", "pos")
    n_sets, before, turn = shape.count(), None, 0
    while True:
        labelled = staged(_labelled(many, links), "labelled")
        best = F.min(F.struct(F.xxhash64("component", F.lit(turn)), "set", "n", "pos", "component")).alias("best")
        each = labelled.groupBy("gram", "component").agg(F.count("*").alias("c"), best)
        pivots = each.groupBy("gram").agg(
            F.min("best").alias("best"), F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("cc"),
            F.count("*").alias("parts"),
        )
        pivots = pivots.where("parts > 1").selectExpr(
            "gram", "best.set as set2", "best.n as n2", "best.pos as pos2", "best.component as component2",
            "(c * c - cc) / 2 as crossing",
        )
        pivots = staged(pivots, "pivots")
        crossing = pivots.agg(F.coalesce(F.sum("crossing"), F.lit(0.0))).first()[0]
        few_left = before is not None and (crossing <= CROSSING * n_sets or crossing > GAIN * before)
        if few_left or not crossing:
            break
        found = verified(
            listed(labelled.join(pivots, "gram").where("component <> component2")),
            "least(many_a, many_b) + least(few_a, few_b)",
        )
        links = links.unionByName(found)
        before, turn = crossing, turn + 1
    left = staged(labelled.join(pivots.select("gram"), "gram", "left_semi"), "open")
    left = left.select("gram", "set", "n", "pos", "component").join(shared, "set")
    right = left.select(
        "gram", *[F.col(c).alias(f"{c}2") for c in ("set", "n", "pos", "component", "in_many", "in_few")]
    )
    # Only sets that share enough prefix n-grams with any other can link with each other.
    likely = (
        f"least(in_many, in_many2) + least(in_few, in_few2) + "
        f"({percent} * greatest(n, n2) + 99) div 100 - 1 >= {need}"
    )
    crossing = left.join(right, "gram").where(f"set < set2 and component <> component2 and {likely}")
    others = f"least(in_few, in_few2) + ({percent} * greatest(n, n2) + 99) div 100 - 1"
    found = verified(listed(crossing, others), "common + least(few_a, few_b)")
    links = links.unionByName(found)
    label = components(links).selectExpr("node as set", "component")

    member = sets.join(label, "set", "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component", "set").alias("class")
    )
    member = staged(member, "members")
    least = member.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    return member.join(least, "class", "left").select(
        "doc_id",
        "key",
        "class",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("low", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with the component of their set by the links so far."""
    label = components(links).selectExpr("node as set", "component")
    return rows.join(label, "set", "left").withColumn("component", F.coalesce("component", "set"))


def one_of_each(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id, with all its columns.

    Documents without words are groups of their own; of rows equal in id and text one stays.
    """
    found = classes(documents, size, percent)
    order = F.struct(F.isnull("doc_id"), "doc_id", "key")  # a null id comes last
    first = found.where("n_shingles > 0").groupBy("class").agg(F.min(order).alias("m"))
    name = fresh(documents, "_key")
    keys = first.select(F.col("m.key").alias(name)).unionByName(
        found.where("n_shingles = 0").select(F.col("key").alias(name)).distinct()
    )
    keyed = documents.withColumn(name, F.xxhash64("doc_id", "text"))
    return keyed.join(keys, name, "left_semi").dropDuplicates([name]).drop(name)
