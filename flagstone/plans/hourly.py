"""Hourly aggregation: replay a time range of the topics into the window tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.operators.ingest import good, parse_envelopes, validate
from flagstone.operators.windows import COUNTED, tumbling_counts, window_table
from flagstone.sources.scratch import staged
from flagstone.sources.writers import append_table


def hourly_windows(
    raw: DataFrame, start: datetime, end: datetime, settings: Settings = Settings()
) -> DataFrame:
    """Counts of all event types in [start, end) by event time, from raw messages."""
    events = good(validate(parse_envelopes(raw)))
    return tumbling_counts(events, settings, start, end)


def write_window_tables(
    counts: DataFrame, namespace: str, settings: Settings = Settings()
) -> None:
    """Append to the three window tables, partitioned by hour.

    Runs cover whole hours, and the hours written replace what was there, so a repeated
    run leaves no duplicates.
    """
    minutes = settings.bucket_seconds // 60
    for kind in COUNTED:
        table = window_table(counts, kind).withColumn(
            "window_hour", F.date_format("window_start", "yyyy-MM-dd-HH")
        )
        append_table(
            table, f"{namespace}.{kind}_windows_{minutes}min", ["window_hour"]
        )


def aggregate_range(
    raw: DataFrame, start: datetime, end: datetime, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """Written counts of [start, end) and the metrics of making them, in one scan of the messages.

    The metrics are observed while the messages are parsed and counted. Tasks that Spark runs
    again after the loss of an executor may be observed twice; then the observed events in range
    are not the counted ones, and the metrics are counted from the messages instead.
    """
    checked = validate(parse_envelopes(raw))
    seen = Observation("hourly")
    events = good(checked.observe(seen, *_event_metrics(start, end)))
    counts = staged(tumbling_counts(events, settings, start, end), "hourly-counts")
    windows = counts.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_count").alias("events"))
    held = windows.collect()  # a row a type
    found = dict(seen.get)
    if found["events_in_range"] != sum(row.events for row in held):
        found = checked.agg(*_event_metrics(start, end)).first().asDict()
    rows = [*found.items(), *[(f"{row.event_type}_windows", row.n) for row in held]]
    return counts, raw.sparkSession.createDataFrame(rows, "metric string, n long")


def _event_metrics(start: datetime, end: datetime) -> list[Column]:
    counted = F.coalesce(F.col("event_type").isin(*COUNTED), F.lit(False))
    in_range = counted & (F.col("ts") >= start) & (F.col("ts") < end)
    skipped = F.col("reject_reason").isNotNull()
    return [
        F.count(F.lit(1)).alias("events_read"),
        F.count_if(~skipped & in_range).alias("events_in_range"),
        F.count_if(skipped).alias("events_skipped"),
    ]


def run_metrics(
    raw: DataFrame, start: datetime, end: datetime, settings: Settings = Settings()
) -> DataFrame:
    """The metrics alone, for a range whose windows are not kept."""
    return aggregate_range(raw, start, end, settings)[1]


def run_hourly(
    raw: DataFrame, start: datetime, end: datetime, namespace: str, settings: Settings = Settings()
) -> DataFrame:
    """The hourly job as one call: replay [start, end) into the three window tables.

    Returns messages read, in range and skipped, and windows per type, as (metric, n).
    """
    counts, metrics = aggregate_range(raw, start, end, settings)
    write_window_tables(counts, namespace, settings)
    return metrics
