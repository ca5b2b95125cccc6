"""As-of lookup: for each row, the latest version of its key at the row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.functions.times import micros
from flagstone.operators.skew import HOT_ROWS, running


def attach_latest(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    version_time: str,
    order: Sequence[str] = (),
    limit: int = HOT_ROWS,
) -> DataFrame:
    """Left as-of join: add to each fact the columns of the last version at or before it.

    `order` names version columns that decide between versions of equal time (largest
    wins). Facts and versions are put on one time line and a running maximum carries the
    version forward, so no pair of fact and version is ever built. A null key matches
    nothing: such versions are dropped and such facts get nulls, without a shuffle.
    """
    keys = list(keys)
    payload = [c for c in versions.columns if c not in (*keys, version_time)]
    rest = [c for c in payload if c not in order]
    version = F.struct(
        F.col(version_time),
        *[F.col(c) for c in order],
        *[F.col(c) for c in rest],
    )
    carried = [c for c in facts.columns if c not in keys]
    some_null = F.lit(False)
    for key in keys:
        some_null = some_null | F.col(key).isNull()
    line = facts.where(~some_null).select(
        *keys,
        micros(fact_time).alias("_us"),
        F.struct(*carried).alias("_fact"),
    ).unionByName(
        versions.where(~some_null).select(
            *keys, micros(version_time).alias("_us"), version.alias("_version")
        ),
        allowMissingColumns=True,
    )
    seen = running(
        line, keys, "_us", latest={"_latest": F.col("_version")}, limit=limit
    )
    found = seen.where(F.col("_fact").isNotNull()).select(
        *keys,
        "_fact.*",
        *[F.col("_latest").getField(c).alias(c) for c in (version_time, *payload)],
    )
    return found.unionByName(
        facts.where(some_null).select(*keys, *carried), allowMissingColumns=True
    )
