"""How five document filters interact: what each removes, alone, first, after others, and on average.

A: under 50 words. B: under 65 distinct words in 100. C: over 5 capitals A-Z in 100 code points.
D: any of `#$%&*|`. E: the text of a document with a smaller id. A and B come from the row sums and
nonzero counts of the document-term matrix (`term_matrix`); C and D from what the matrix rows say about
their texts; E from the least id of each text digest, joined back on digest and id, so that copies in
any number meet in no task. A document's failures are five bits. Per part there are at most 32
different sets of failures; all orders are answered from those counts.

The Shapley value of a filter is what it removes, summed over all 120 orders: a document with t failures
is removed first by each of them in 120 / t orders.

Cases: a null text is empty; a null part is the part named by the empty string; a document without an id
is nobody's copy and has no labels; rows equal in id and text are no copies of each other (E asks for a
smaller id); of several labels of an id any 1 counts; an empty table has no parts. Only named columns
are read, so others clash with nothing.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.llm import term_matrix
from flagstone.sources.scratch import staged

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5


def flags(df: DataFrame, part: str = "source", hot: int = term_matrix.HOT_WORDS) -> DataFrame:
    """doc_id, part, and for each filter whether the document fails it."""
    words = term_matrix.dictionary(df)
    shards = term_matrix.matrix(
        df, words, {"doc_id": F.col("doc_id"), "part": F.coalesce(F.col(part).cast("string"), F.lit(""))}, hot=hot
    )
    rows = term_matrix.row_statistics(shards).select(
        "doc_id",
        "part",
        "digest",
        (F.col("n_words") < MIN_WORDS).alias("A"),
        (100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words")).alias("B"),
        (100 * F.col("n_upper") > MAX_UPPER_PERCENT * F.col("n_chars")).alias("C"),
        F.col("marked").alias("D"),
    )
    rows = staged(rows, "flags")
    named = rows.where("doc_id IS NOT NULL")
    least = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copies = named.join(least, ["digest", "doc_id"], "left").withColumn("E", F.col("first").isNull())
    nameless = rows.where("doc_id IS NULL").withColumn("E", F.lit(False))
    columns = ["doc_id", "part", *FILTERS]
    return copies.select(columns).unionByName(nameless.select(columns))


def failure_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failures (bit i for the i-th filter), n, good, toxic: at most 32 rows a part."""
    bits = [F.when(F.col(f), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)]
    failures = sum(bits[1:], bits[0])
    rows = flagged.select("doc_id", "part", failures.alias("failures"))
    marks = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    named = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    nameless = rows.where("doc_id IS NULL").select(
        "*", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic")
    )
    return named.unionByName(nameless).groupBy("part", "failures").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def _sum(chosen: Column, value: str) -> Column:
    """Sum of a count over the sets of failures in `chosen`."""
    return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, m: a + m[value])


def audit(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """Five rows for each part and order of the filters."""
    counts = failure_counts(flagged, labels)
    parts = counts.groupBy("part").agg(
        F.collect_list(F.struct("failures", "n", "good", "toxic")).alias("sets")  # at most 32
    )
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for k, i in enumerate(order):
            name = "".join(FILTERS[j] for j in order)
            steps.append(F.struct(F.lit(name).alias("filter_order"), F.lit(k + 1).alias("step"),
                                  F.lit(1 << i).alias("bit"), F.lit(before).alias("before")))
            before |= 1 << i
    rows = parts.select("part", "sets", F.inline(F.array(*steps)))
    bit, before = F.col("bit"), F.col("before")
    fails = F.filter("sets", lambda m: m["failures"].bitwiseAND(bit) != 0)
    here = F.filter(fails, lambda m: m["failures"].bitwiseAND(before) == 0)
    kept = F.filter("sets", lambda m: m["failures"].bitwiseAND(bit.bitwiseOR(before)) == 0)
    only = F.filter("sets", lambda m: m["failures"] == bit)
    orders = len(list(permutations(FILTERS)))
    shapley = F.aggregate(
        fails,
        F.lit(0).cast("long"),
        lambda a, m: a + m["n"] * (F.lit(orders) / F.bit_count(m["failures"])).cast("long"),
    )
    return rows.select(
        "part", "filter_order", "step",
        _sum(kept, "n").alias("kept"),
        _sum(here, "n").alias("removed"),
        (_sum(fails, "n") - _sum(here, "n")).alias("redundant"),
        _sum(only, "n").alias("unique_fails"),
        _sum(here, "good").alias("good_lost"),
        _sum(here, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
