"""Threshold alerts, moderation requests and milestones; each fires once per image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.functions.times import micros
from flagstone.operators.skew import HOT_ROWS, running


def alert_rules(settings: Settings) -> dict[str, tuple[str, int, tuple[str, ...]]]:
    """Alert type: observed column, threshold, event types it is evaluated on."""
    both = ("view", "comment")
    return {
        "viral": ("views_5min", settings.viral_views_5min, both),
        "suspicious": ("comments_1min", settings.suspicious_comments_1min, ("comment",)),
        "popular": ("views_1hr", settings.popular_views_1hr, both),
    }


def threshold_crossings(
    rolling: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Every event at which a rolling count is at or above an alert threshold."""
    candidates = F.array(
        *[
            F.when(
                F.col("event_type").isin(*kinds) & (F.col(column) >= threshold),
                F.struct(
                    F.lit(name).alias("alert_type"),
                    F.col(column).cast("long").alias("observed"),
                    F.lit(threshold).cast("long").alias("threshold"),
                ),
            )
            for name, (column, threshold, kinds) in alert_rules(settings).items()
        ]
    )
    return rolling.select(
        "image_id", "event_id", "ts", F.inline(F.array_compact(candidates))
    )


def first_alerts(rolling: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The first crossing of each (image, alert type), by (ts, event id).

    A minimum over a struct, so it is combined before the shuffle.
    """
    return (
        threshold_crossings(rolling, settings)
        .groupBy("image_id", "alert_type")
        .agg(F.min(F.struct("ts", "event_id", "observed", "threshold")).alias("first"))
        .select(
            "image_id",
            "alert_type",
            F.col("first.ts").alias("alert_ts"),
            F.col("first.observed").alias("observed"),
            F.col("first.threshold").alias("threshold"),
        )
    )


def moderation_requests(alerts: DataFrame) -> DataFrame:
    """Requests for the alerts that need a decision; popular posts need none."""
    context_key = F.when(F.col("alert_type") == "viral", "views_5min").otherwise(
        "comments_1min"
    )
    return alerts.where(F.col("alert_type").isin("viral", "suspicious")).select(
        "image_id",
        F.col("alert_type").alias("trigger"),
        F.create_map(context_key, F.col("observed")).alias("context"),
        (micros("alert_ts") / F.lit(1e6)).alias("timestamp"),
    )


def milestone_crossings(
    views: DataFrame, settings: Settings = Settings(), limit: int = HOT_ROWS
) -> DataFrame:
    """The instant at which each image's view total reaches each milestone."""
    counted = running(
        views.where(F.col("image_id").isNotNull()).select(
            "image_id", micros("ts").alias("us")
        ),
        ["image_id"],
        "us",
        sums={"total": F.lit(1).cast("long")},
        peers={"at_once": F.lit(1).cast("long")},
        limit=limit,
    )
    steps = F.array(*[F.lit(m) for m in settings.milestones])
    reached = F.filter(
        steps,
        lambda m: (m <= F.col("total")) & (m > F.col("total") - F.col("at_once")),
    )
    return (
        counted.select("image_id", "us", F.explode(reached).alias("milestone_value"))
        .groupBy("image_id", "milestone_value")
        .agg(F.timestamp_micros(F.min("us")).alias("reached_at"))
        .select(
            "image_id",
            F.lit("views").alias("milestone_type"),
            "milestone_value",
            "reached_at",
        )
    )


def alert_statistics(alerts: DataFrame, milestones: DataFrame) -> DataFrame:
    """Images alerted per type, and milestones reached in all."""
    return (
        alerts.groupBy("alert_type")
        .agg(F.count("*").alias("n"))
        .unionByName(
            milestones.agg(F.count("*").alias("n")).select(
                F.lit("milestone").alias("alert_type"), "n"
            )
        )
    )
