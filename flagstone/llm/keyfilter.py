"""A bit table of keys with a fixed size, to leave most rows out of a later join.

The table has 2^24 bits (2 MB) whatever the data; a key whose bit is not set is certainly not
among the keys, the others still go through the join, so results never depend on the table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def bit_table(df: DataFrame, key: str) -> DataFrame:
    """word, mask: the words of the bit table of a column of 64-bit hashes that have a bit, at most 2^18 rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(_word(F.col(key)).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({key} & 63 as int))")).alias("mask"))
    )


def _word(key: Column) -> Column:
    return F.shiftright(key.bitwiseAND(F.lit((1 << BITS) - 1)), 6)


def key_bits(df: DataFrame, key: str) -> np.ndarray:
    """The bit table of a column of 64-bit hashes, as 2^18 words; combined before it is gathered."""
    table = np.zeros(1 << (BITS - 6), np.uint64)
    for row in bit_table(df, key).collect():
        table[row.word] = np.uint64(row.mask & 0xFFFFFFFFFFFFFFFF)
    return table


def that_may_hold(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be among the keys of a `bit_table`, which is broadcast; no Python."""
    bit = F.expr(f"shiftright(mask, cast({key} & 63 as int)) & 1")
    joined = rows.withColumn("word", _word(F.col(key))).join(F.broadcast(table), "word")
    return joined.where(bit == 1).drop("word", "mask")


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (int64) may be among the keys of the table."""
    bit = keys.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
