"""Positions in a global order without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flagstone.llm.text import fresh
from flagstone.sources.scratch import staged

_SLOT_BITS = 33  # monotonically_increasing_id counts up from partition * 2^33


def ranked(
    df: DataFrame, within: list[str], order: list[str], name: str = "rank", size: str = "size"
) -> DataFrame:
    """Add each row's position, from 0, in `order` among the rows equal in `within`, and their number.

    Rows are dealt by ranges of (within, order) and sorted there; what a group has in earlier
    partitions comes from one count a partition and group, joined back on both. A group of any
    size is therefore spread over many tasks, and no join key has more rows than a partition.
    Nulls come first and form a group of their own. Equal rows take any order among them.
    """
    at, slot, row, low, before, n = (
        fresh(df, c) for c in ("at", "slot", "row_number", "first_row", "before", "n_rows")
    )
    keys = [F.col(c).asc() for c in [*within, *order]]
    # Equal rows may be very many: their place in the input deals them over several ranges.
    sliced = df.withColumn(at, F.monotonically_increasing_id())
    dealt = sliced.repartitionByRange(*keys, F.col(at)).sortWithinPartitions(*keys).drop(at)
    placed = staged(dealt.withColumn(row, F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn(slot, F.shiftright(row, _SLOT_BITS))
    counts = placed.groupBy(slot, *within).agg(F.min(row).alias(low), F.count("*").alias(n))
    group = Window.partitionBy(*within)
    earlier = group.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(slot).alias("_slot"),
        *[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)],
        low,
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before),
        F.sum(n).over(group).alias(n),
    )
    match = placed[slot] == counts["_slot"]
    for i, c in enumerate(within):
        match = match & placed[c].eqNullSafe(counts[f"_w{i}"])
    position = (F.col(row) - F.col(low) + F.col(before)).cast("long")
    return placed.join(counts, match).select(
        *[placed[c] for c in df.columns], position.alias(name), counts[n].alias(size)
    )


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Number the rows from 0, in no order that matters: positions in their partitions, written down,
    and behind the counts of the partitions before. Nothing but one count a partition moves."""
    slot, row, n, low, before = (fresh(df, c) for c in ("slot", "row_number", "n_rows", "first_row", "before"))
    placed = staged(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn(slot, F.shiftright(row, _SLOT_BITS))
    counts = placed.groupBy(slot).agg(F.min(row).alias(low), F.count("*").alias(n))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    counts = counts.withColumnRenamed(slot, "_slot").withColumn(
        before, F.coalesce(F.sum(n).over(earlier), F.lit(0))
    )
    return placed.join(counts, placed[slot] == counts["_slot"]).select(
        *df.columns, (F.col(row) - F.col(low) + F.col(before)).cast("long").alias(name)
    )
