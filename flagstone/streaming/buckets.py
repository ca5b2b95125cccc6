"""Counts per image and time bucket as keyed state that other jobs can read.

One built-in aggregation over grouping sets: a state entry a bucket, and one with the totals of the
image, so a micro-batch touches only the entries it adds to and no row leaves the engine. Rows are
combined before the shuffle, so a busy image is a row per bucket and map task. A bucket
older than the longest window behind the watermark is removed by the watermark, whether or not its
image is seen again; totals stay. A busy image has at most longest / grain + 1 entries of each type.

The state is read with Spark's own reader (`read_buckets`, `read_totals`): serving needs no second
copy of it and no scan of the event history.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.functions.times import SECOND, micros

KINDS = ("view", "comment", "flag")
TOTALS = ("total_views", "total_comments", "total_flags")
_VALUE = "struct<n:bigint, " + ", ".join(f"{name}:bigint" for name in TOTALS) + ", last_us:bigint>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in the store that named state variables need."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def bucket_state(
    events: DataFrame, settings: Settings = Settings(), watermark: str = "1 hour", grain_seconds: int = 1
) -> DataFrame:
    """Totals of each image a micro-batch touches, as a stream; the buckets are in its state.

    Start it inside `state_store`, in update mode. `events` has image_id, event_type and ts. Feed it what
    `ingest.IngestSink` writes as events, which holds no late rows: a row behind the watermark would
    count in the totals, and in its bucket as long as that is held.
    """
    longest = max(seconds for _, seconds in settings.rolling)
    us = micros("ts")
    # `reach` is when the longest window leaves the event, so a bucket's end of life is the end of a
    # window over it; the watermark is that of `ts`, as its delay grows by the same span.
    bucket = F.window("reach", f"{grain_seconds} seconds", startTime=f"{longest % grain_seconds} seconds")
    rows = (
        events.where(F.col("event_type").isin(*KINDS) & F.col("image_id").isNotNull())
        .withColumn("reach", F.timestamp_micros(us + longest * SECOND))
        .withWatermark("reach", f"{watermark} {longest} seconds")
        .select("image_id", "event_type", (us - F.pmod(us, F.lit(grain_seconds * SECOND))).alias("us"), bucket.alias("bucket"))
        .withColumn("kind", F.col("event_type"))  # what is grouped by is null in the totals
    )
    image, kind, held = F.col("image_id"), F.col("event_type"), F.col("bucket")
    entries = rows.groupingSets([[image, kind, held], [image]], image, kind, held).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("kind") == k).alias(name) for k, name in zip(KINDS, TOTALS)],
        F.max("us").alias("last_us"),
    )
    # The test takes in a count, as one of the grouping alone would move below the state and empty it.
    return entries.where("coalesce(length(event_type), -n) < 0").select("image_id", *TOTALS, F.timestamp_micros("last_us").alias("last_ts"))


def _entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the stream holds as of its last batch; entries with totals have no type and end."""
    rows = spark.read.format("statestore").option("path", checkpoint).load()
    # Spark names the fields by their functions, so several are called count; they are told by place.
    value = F.col("value").cast(_VALUE).alias("value")
    return rows.select("key.image_id", "key.event_type", "key.bucket.end", value).select("*", "value.*").drop("value")


def read_buckets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """image_id, event_type, ts (start of the bucket), n: what the stream holds as of its last batch."""
    start = F.timestamp_micros("last_us").alias("ts")  # of a bucket's rows all have its start
    return _entries(spark, checkpoint).where("end is not null").select("image_id", "event_type", start, "n")


def read_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """image_id, total_views, total_comments, total_flags and last_ts, the newest bucket they contain,
    as of the stream's last batch."""
    totals = _entries(spark, checkpoint).where("end is null")
    return totals.select("image_id", *TOTALS, F.timestamp_micros("last_us").alias("last_ts"))


def buckets_held(spark: SparkSession, checkpoint: str) -> DataFrame:
    """image_id, buckets_held: the number of buckets the state has of each image that has any."""
    return read_buckets(spark, checkpoint).groupBy("image_id").agg(F.count("*").alias("buckets_held"))
