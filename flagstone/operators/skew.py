"""Joins and running aggregates that stay balanced when one key holds most rows.

A key is *hot* when it has more than `limit` rows. There are fewer than rows / limit such
keys, so the list of them is small by construction and may be broadcast. Cold keys take
the ordinary one-shuffle plan; hot keys are split. Where a table has no hot key, the hot
branch is not planned at all. Where it has, the input is written to the shared folder
first, so that the branches read a table instead of repeating the work before them, and
chains of these operators stay linear in plan size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.functions.times import DAY, SECOND
from flagstone.sources.scratch import staged

HOT_ROWS = Settings.hot_rows
TIE_SLICES = 256
FIND = "find"  # look for hot keys in the input itself


def hot_keys(
    df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS
) -> DataFrame | None:
    """Keys with more than `limit` rows, or None. Counts are combined before the shuffle."""
    heavy = df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys)
    return None if heavy.isEmpty() else staged(heavy, "hot-keys")


def split_hot(
    df: DataFrame, keys: Sequence[str], hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of cold keys and rows of hot keys; neither side is shuffled."""
    listed = F.broadcast(hot)
    return df.join(listed, list(keys), "left_anti"), df.join(
        listed, list(keys), "left_semi"
    )


def restrict(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `big` whose key occurs in `small`. The planner chooses how, by their sizes."""
    return big.join(small.select(*keys).distinct(), list(keys), "left_semi")


def skew_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    limit: int = HOT_ROWS,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Equi-join of a skewed fact side with a side that has one row per key.

    Hot keys join against their own dim rows, of which there are at most as many as hot
    keys, by broadcast; their fact rows are never shuffled. Null keys match nothing and
    are not shuffled either. `hot` passes on a list of hot keys that is already known.
    """
    keys = list(keys)
    keeps_unmatched = how in ("left", "left_outer", "left_anti")
    some_null = F.lit(False)
    for key in keys:
        some_null = some_null | F.col(key).isNull()
    present = fact.where(~some_null)

    if hot is FIND:
        hot = hot_keys(present, keys, limit)
    if hot is None:
        joined = present.join(dim, keys, how)
    else:
        present = staged(present, "skew-join")
        cold_fact, hot_fact = split_hot(present, keys, hot)
        hot_dim = dim.join(F.broadcast(hot), keys, "left_semi")
        joined = cold_fact.join(dim, keys, how).unionByName(
            hot_fact.join(F.broadcast(hot_dim), keys, how)
        )
    if keeps_unmatched:
        joined = joined.unionByName(fact.where(some_null), allowMissingColumns=True)
    return joined


def running(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    sums: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    peers: Mapping[str, Column] | None = None,
    tie: str | None = None,
    limit: int = HOT_ROWS,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Add running aggregates per key in order of `time` (integer microseconds).

    sums    running sum of a column; 0 where nothing was summed yet
    latest  running maximum; with a struct that starts with the time, the latest value so far
    peers   sum over the rows of the same key and time only

    Without `tie`, rows of equal time see each other (range frame). With `tie`, a column
    that orders them, each row sees the rows before it and itself (row frame); ties are
    ordered by a hash of that column first, so that they too can be split.

    All frames start at the first row, which costs one pass per key whatever the window
    length; sliding counts are expressed as arrivals minus expiries. A hot key is cut into
    cells of equal time, combined before the shuffle, and the sums before each cell come
    from second and day totals, so no task sees more than one second of one key. `hot`
    passes on a list of hot keys found in a smaller input.
    """
    keys, sums, latest, peers = (
        list(keys),
        dict(sums or {}),
        dict(latest or {}),
        dict(peers or {}),
    )
    if tie is not None:
        if peers:
            raise ValueError("peers need the range frame; leave out tie")
        rows = rows.withColumn(
            "_slice",
            F.pmod(F.xxhash64(F.col(tie)), F.lit(TIE_SLICES)).cast("int"),
        )
    if hot is FIND:
        hot = hot_keys(rows, keys, limit)
    if hot is None:
        out = _running_plain(rows, keys, time, sums, latest, peers, tie)
    else:
        rows = staged(rows, "running")
        cold_rows, hot_rows = split_hot(rows, keys, hot)
        out = _running_plain(
            cold_rows, keys, time, sums, latest, peers, tie
        ).unionByName(
            _running_split(hot_rows, keys, time, sums, latest, peers, tie, limit)
        )
    return out.drop("_slice")


def _running_plain(rows, keys, time, sums, latest, peers, tie):
    by_key = Window.partitionBy(*keys)
    if tie is None:
        so_far = by_key.orderBy(time).rangeBetween(Window.unboundedPreceding, 0)
    else:
        so_far = by_key.orderBy(time, "_slice", tie).rowsBetween(
            Window.unboundedPreceding, 0
        )
    same_time = by_key.orderBy(time).rangeBetween(0, 0)
    return rows.select(
        "*",
        *[
            F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(name)
            for name, c in sums.items()
        ],
        *[F.max(c).over(so_far).alias(name) for name, c in latest.items()],
        *[F.sum(c).over(same_time).alias(name) for name, c in peers.items()],
    )


def _running_split(rows, keys, time, sums, latest, peers, tie, limit):
    names = [*sums, *latest, *peers]
    within = [time] if tie is None else [time, "_slice"]
    cells = rows.groupBy(*keys, *within).agg(
        *[F.sum(c).alias(name) for name, c in {**sums, **peers}.items()],
        *[F.max(c).alias(name) for name, c in latest.items()],
        F.count("*").alias("_rows"),
    )
    cells = staged(cells, "cells")
    crowded = cells.where(F.col("_rows") > limit).select(*keys, *within)
    cells = cells.drop("_rows")
    if tie is None:
        totals = _cell_totals(
            cells, keys, within, list(sums), list(latest), inclusive=True
        )
        # Many rows may share one instant: those cells are joined by broadcast.
        hot = None if crowded.isEmpty() else crowded
        return skew_join(
            rows, totals.select(*keys, time, *names), [*keys, time], "inner", limit, hot
        ).select(*rows.columns, *names)

    before = _cell_totals(
        cells, keys, within, list(sums), list(latest), inclusive=False
    ).select(*keys, *within, *[F.col(n).alias(f"_before_{n}") for n in names])
    in_cell = (
        Window.partitionBy(*keys, *within)
        .orderBy(tie)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.join(before, [*keys, *within], "inner")
        .select(
            "*",
            *[F.sum(c).over(in_cell).alias(n) for n, c in sums.items()],
            *[F.max(c).over(in_cell).alias(n) for n, c in latest.items()],
        )
        .select(
            *rows.columns,
            *[
                _plus(F.col(f"_before_{n}"), F.col(n)).alias(n) for n in sums
            ],
            *[F.greatest(f"_before_{n}", n).alias(n) for n in latest],
        )
    )


def _cell_totals(cells, keys, within, sums, latest, inclusive):
    """Totals up to each cell: own second + seconds of the day before it + days before."""
    time = within[0]
    second = F.col(time) - F.pmod(F.col(time), F.lit(SECOND))
    day = F.col(time) - F.pmod(F.col(time), F.lit(DAY))
    cells = cells.withColumn("_second", second).withColumn("_day", day)

    def combine(frame, prefix):
        return [F.sum(n).over(frame).alias(prefix + n) for n in sums] + [
            F.max(n).over(frame).alias(prefix + n) for n in latest
        ]

    def grouped(df, by):
        return df.groupBy(*by).agg(
            *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in latest]
        )

    earlier = (Window.unboundedPreceding, -1)
    seconds = grouped(cells, [*keys, "_day", "_second"])
    by_day = Window.partitionBy(*keys, "_day").orderBy("_second").rowsBetween(*earlier)
    by_key = Window.partitionBy(*keys).orderBy("_day").rowsBetween(*earlier)
    second_base = seconds.select(
        *keys, "_day", "_second", *combine(by_day, "_s_")
    )
    day_base = grouped(seconds, [*keys, "_day"]).select(
        *keys, "_day", *combine(by_key, "_d_")
    )
    base = second_base.join(day_base, [*keys, "_day"])

    in_second = (
        Window.partitionBy(*keys, "_day", "_second")
        .orderBy(*within)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    other = [c for c in cells.columns if c not in (*sums, *latest)]
    return (
        cells.select(*other, *combine(in_second, "_c_"))
        .join(base, [*keys, "_day", "_second"])
        .select(
            *other,
            *[
                _plus(F.col(f"_c_{n}"), F.col(f"_s_{n}"), F.col(f"_d_{n}")).alias(n)
                for n in sums
            ],
            *[F.greatest(f"_c_{n}", f"_s_{n}", f"_d_{n}").alias(n) for n in latest],
        )
    )


def _plus(*parts: Column) -> Column:
    total = F.coalesce(parts[0], F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(part, F.lit(0))
    return total
