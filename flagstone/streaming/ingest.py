"""Ingest with several outputs of one micro-batch: events on time, late ones, rejected records.

A micro-batch is parsed once, persisted, and written to its outputs; together they hold every
record read. A record is late if its event time is more than `delay` behind the newest one of the
batches before, which is Spark's own rule for the watermark of a batch. The sink keeps each batch's
newest time next to its outputs, under the batch's number, so a replayed batch meets the same
watermark and replaces the same rows, and a stream resumed from its checkpoint goes on with it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.functions.times import SECOND, micros
from flagstone.operators.ingest import good, parse_envelopes, quarantine, validate
from flagstone.sources.writers import run_id, write_batch

EVENT_COLUMNS = ("event_type", "image_id", "event_id", "ts")
REJECT_COLUMNS = ("topic", "partition", "offset", "arrived_at", "event_type", "image_id", "reject_reason", "_corrupt_record")
OUTPUTS = ("events", "late", "quarantine")
_MARKS = "run_id string, batch_id long, newest_us long"


class IngestSink:
    """Batch function over raw messages: `events`, `late` and `quarantine` under one folder."""

    def __init__(
        self, out: str, delay_seconds: int = 3600, event_columns: tuple[str, ...] = EVENT_COLUMNS
    ) -> None:
        self.out, self.delay_us, self.event_columns = out, delay_seconds * SECOND, event_columns

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Epoch microseconds: the newest event time of the batches before, less the delay."""
        try:
            marks = spark.read.schema(_MARKS).option("basePath", f"{self.out}/marks").parquet(f"{self.out}/marks")
            here = marks.where((F.col("run_id") == run_id(spark)) & (F.col("batch_id") < batch_id))
            newest = here.agg(F.max("newest_us")).first()[0]
        except Exception as error:  # the first batch of all: no folder yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        return None if newest is None else newest - self.delay_us

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checked = validate(parse_envelopes(batch), arrival_fallback=True)
        checked = checked.persist(StorageLevel.DISK_ONLY)
        try:
            mark = self.watermark(spark, batch_id)
            is_late = F.lit(False) if mark is None else micros("ts") < mark
            events = good(checked).select(*self.event_columns).withColumn("_late", is_late)
            write_batch(events.where(~F.col("_late")).drop("_late"), f"{self.out}/events", batch_id)
            write_batch(events.where("_late").drop("_late"), f"{self.out}/late", batch_id)
            write_batch(quarantine(checked).select(*REJECT_COLUMNS), f"{self.out}/quarantine", batch_id)
            newest = good(checked).agg(F.max(micros("ts")).alias("newest_us"))
            write_batch(newest.where("newest_us is not null"), f"{self.out}/marks", batch_id)
        finally:
            checked.unpersist()


def read_output(spark: SparkSession, out: str, name: str, schema) -> DataFrame:
    """All rows of one output, of all batches."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{out}/{name}")
