"""Exact order statistics by distributed selection: quantile sketches bracket, counts decide.

A sketch's value at a fraction is at most n / accuracy ranks off, so the values two such errors
below and above a rank bracket it, and between them lie few different values, however many rows
there are. The next scan counts what lies outside the brackets and, where a bracket is bound to hold
few different values, counts these one by one. The counts show whether a rank lies in its
bracket; where it does not, the search goes on in the region that holds it. A bracket that may
hold more than `bound` values is narrowed by another sketch of its own rows; its ends are counted
apart, so that frequent values end the search and every round leaves fewer rows.

The driver receives the region counts and at most `bound` values with their counts; nothing is
sorted, and no task sees more than its own rows.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
BOUND = 1_000_000  # values that a scan may return


@dataclass(frozen=True)
class Span:
    """Values from low to high, ends included unless `open_*`; `below` rows lie under it, `inside` in
    it, with at most `most` different values."""

    low: float
    high: float
    open_low: bool = False
    open_high: bool = False
    below: int = 0
    inside: int = 0
    most: int = 0

    @property
    def single(self) -> bool:
        return self.low == self.high

    def holds(self, v: Column) -> Column:
        over = v > self.low if self.open_low else v >= self.low
        under = v < self.high if self.open_high else v <= self.high
        return over & under


def _most(rows: int, accuracy: int) -> int:
    """Different values strictly between two sketched ends four errors apart, each one error off."""
    return min(rows, 6 * math.ceil(rows / accuracy))


def sketch_points(fraction: float, accuracy: int) -> list[float]:
    """Fractions whose sketched values bracket the rank of `fraction`."""
    return [max(0.0, fraction - 2 / accuracy), min(1.0, fraction + 2 / accuracy)]


def _disjoint(brackets: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed intervals with overlapping ones joined, ascending."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _counted(values: DataFrame, brackets: list[tuple[float, float]], each: bool) -> tuple[list[int], dict]:
    """Rows of each region, and if `each` the rows of every value strictly inside brackets.

    Bracket j has regions 4 j (under it), its low end, its inside and its high end.
    """
    v = F.col("v")
    region = F.lit(4 * len(brackets))
    for j, (low, high) in reversed(list(enumerate(brackets))):
        at = F.when(v < low, 4 * j).when(v == low, 4 * j + 1).when(v < high, 4 * j + 2)
        region = at.when(v == high, 4 * j + 3).otherwise(region)
    rows = values.select(region.alias("region"), "v")
    keys = [F.col("region")]
    if each:
        keys.append(F.when(F.col("region") % 4 == 2, v).alias("value"))
    counts, found = [0] * (4 * len(brackets) + 1), {}
    for row in rows.groupBy(*keys).agg(F.count("*").alias("n")).collect():
        counts[row.region] += row.n
        if each and row.value is not None:
            found[row.value] = row.n
    return counts, found


def _sketched(values: DataFrame, spans: dict[int, Span], accuracy: int) -> dict[int, tuple[float, float]]:
    """A bracket of each rank, from one sketch of its span's rows."""
    v = F.col("v")
    columns = []
    for rank, span in spans.items():
        points = sketch_points((rank - span.below) / max(1, span.inside - 1), accuracy)
        columns.append(F.percentile_approx(F.when(span.holds(v), v), points, accuracy).alias(f"r{rank}"))
    row = values.agg(*columns).first()
    return {rank: tuple(row[f"r{rank}"]) for rank in spans}


def order_statistics(
    values: DataFrame,
    ranks: Iterable[int],
    low: float,
    high: float,
    n: int,
    first: dict[int, tuple[float, float]] | None = None,
    accuracy: int = ACCURACY,
    bound: int = BOUND,
) -> dict[int, float]:
    """The values of `ranks` (from 0) of the column `v`, which has n values from low to high.

    `first` may bracket some ranks; wrong brackets cost scans, never a wrong value.
    """
    spans = {rank: Span(low, high, inside=n, most=n) for rank in ranks}
    done = {rank: s.low for rank, s in spans.items() if s.single}
    brackets = dict(first or {})
    while open_ := {rank: s for rank, s in spans.items() if rank not in done}:
        wide = {r: s for r, s in open_.items() if r not in brackets and s.most > bound}
        if wide:
            brackets |= _sketched(values, wide, accuracy)
        taken = {}
        for rank, span in open_.items():
            if rank in brackets:
                taken[rank] = (*brackets[rank], _most(span.inside, accuracy))
            else:
                taken[rank] = (span.low, span.high, span.most)
        brackets = {}
        intervals = _disjoint((a, b) for a, b, _ in taken.values())
        each = sum(most for _, _, most in taken.values()) <= bound
        counts, found = _counted(values, intervals, each)
        starts = [0]
        for c in counts:
            starts.append(starts[-1] + c)
        ordered = sorted(found)
        for rank, (_, _, most) in taken.items():
            region = bisect.bisect_right(starts, rank) - 1
            j, place = divmod(region, 4)
            if place == 1 or place == 3:
                done[rank] = intervals[j][place // 2]
            elif place == 2 and each:
                upto = starts[region]
                for value in ordered[bisect.bisect_right(ordered, intervals[j][0]) :]:
                    upto += found[value]
                    if upto > rank:
                        done[rank] = value
                        break
            elif place == 2:  # fewer rows than before: both ends are left out
                spans[rank] = Span(*intervals[j], True, True, starts[region], counts[region], min(most, counts[region]))
            else:  # the bracket missed: on in the region that holds the rank
                a, open_a = (intervals[j - 1][1], True) if j else (low, False)
                b, open_b = (intervals[j][0], True) if j < len(intervals) else (high, False)
                spans[rank] = Span(a, b, open_a, open_b, starts[region], counts[region], counts[region])
    return done
