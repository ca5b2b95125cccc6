"""Instants as columns. Interval edges are computed on integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP column."""
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def instant(us: Column | str) -> Column:
    return F.timestamp_micros(F.col(us) if isinstance(us, str) else us)


def parse_instant(text: Column) -> Column:
    """ISO-8601 text with `Z`, an offset or neither (UTC); anything else is null.

    Needs the session time zone UTC. Time-only and year-only forms, which a plain
    cast would accept, are refused.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def floor_to(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket that holds the instant."""
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(seconds * SECOND)))


def after(ts: Column, seconds: Column | int) -> Column:
    """The instant a number of seconds later."""
    step = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_micros(F.unix_micros(ts) + step.cast("long") * SECOND)
