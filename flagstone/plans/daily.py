"""The daily job as one call: training rows of a range of upload days, kept once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.operators.quality import value_counts
from flagstone.plans.training_table import build_training_data
from flagstone.sources.scratch import staged
from flagstone.sources.writers import append_table

DAY = "upload_day"


def run_daily(
    users: DataFrame,
    images: DataFrame,
    flags: DataFrame,
    windows: DataFrame,
    start: datetime,
    end: datetime,
    table: str,
    settings: Settings = Settings(),
) -> DataFrame:
    """Write the training rows of images uploaded in [start, end) and return their label counts.

    Both ends are midnights: the table is partitioned by upload day, and the days written replace
    what was there, so a repeated or overlapping run leaves one copy of each row. Windows and
    flags outside what these images can use are not read. An image's last day is final once its
    label horizon has passed; running that day again then brings the label up to date.
    """
    if any(t != t.replace(hour=0, minute=0, second=0, microsecond=0) for t in (start, end)):
        raise ValueError("a run covers whole days")
    rows = build_training_data(
        users, images, flags, windows=windows, settings=settings, uploaded=(start, end), extra=["uploaded_at"]
    )
    rows = rows.withColumn(DAY, F.date_format("uploaded_at", "yyyy-MM-dd")).drop("uploaded_at")
    rows = staged(rows, "training-rows")
    append_table(rows, table, [DAY])
    return value_counts(rows)
