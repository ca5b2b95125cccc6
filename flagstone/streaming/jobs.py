"""Streaming jobs: windowed counts, state sinks, upload metadata, decisions."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flagstone.config import Settings
from flagstone.operators.alerts import moderation_requests
from flagstone.operators.ingest import good, parse_envelopes, to_messages, validate
from flagstone.operators.windows import latest_metadata
from flagstone.plans.serving import decide, missing_requests, serving_features
from flagstone.schemas import MILESTONES
from flagstone.sources.scratch import scratch_dir
from flagstone.sources.writers import (
    decision_rows,
    insert_if_absent,
    load_latest_model,
    put_latest,
    write_batch,
)
from flagstone.streaming.state import GRAIN, SHUFFLES, alerts_of, grain_totals, milestones_of


def parsed_stream(raw: DataFrame) -> DataFrame:
    """Good events of a stream; an event without a time takes its arrival time."""
    return good(validate(parse_envelopes(raw), arrival_fallback=True))


def tumbling_stream(
    events: DataFrame, settings: Settings = Settings(), watermark: str = "1 hour"
) -> DataFrame:
    """Event-time tumbling counts; in append mode a bucket comes out once it is closed."""
    bucket = F.window("ts", f"{settings.bucket_seconds} seconds")
    return (
        events.withWatermark("ts", watermark)
        .groupBy("image_id", "event_type", bucket)
        .agg(F.count("*").alias("event_count"))
        .select(
            "image_id",
            "event_type",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_count",
        )
    )


def sliding_stream(
    events: DataFrame,
    width: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "1 hour",
) -> DataFrame:
    """Counts over overlapping windows with a fixed slide, for dashboards."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy("image_id", "event_type", F.window("ts", width, slide))
        .agg(F.count("*").alias("event_count"))
        .select(
            "image_id",
            "event_type",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_count",
        )
    )


def latest_windows(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for window counts in update mode: open windows are stored as well."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put_latest(batch, path, batch_id)

    return write


def grain_sink(path: str, grain: str = GRAIN) -> Callable[[DataFrame, int], None]:
    """Batch function that stores each micro-batch's counts per image, type and grain.

    Nothing is held back: counts of one grain from several batches add up in the keyed state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(grain_totals(batch, grain), path, batch_id)

    return write


def flag_stream(events: DataFrame) -> DataFrame:
    """Running flag count per image, for update or complete mode."""
    return (
        events.where(F.col("event_type") == "flag")
        .groupBy("image_id")
        .agg(F.count("*").alias("total_flags"))
    )


def deduplicated(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop redelivered events: same type and id again within the watermark."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(
        ["event_type", "event_id"]
    )


def state_sinks(
    out: str, settings: Settings = Settings()
) -> Callable[[DataFrame, int], None]:
    """Batch function for `rolling_state`: features, alerts, requests and milestones.

    The state rows are written first and the other outputs are made from the written
    rows, so the stateful operator runs once per batch. Alerts and milestones go to tables with one
    row a key, whatever runs wrote them; requests and features belong to their run (`read_run`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = write_batch(batch, f"{out}/features", batch_id)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        if rows.isEmpty():
            return  # a batch that only moved the watermark
        alerts = alerts_of(rows, settings)
        insert_if_absent(alerts, f"{out}/alerts", ("image_id", "alert_type"), ("alert_ts",))
        # A batch asks for the alerts that are its own, also when it is replayed.
        held = batch.sparkSession.read.schema(alerts.schema).parquet(f"{out}/alerts")
        alerts = alerts.join(
            held.select("image_id", "alert_type", "alert_ts"), ["image_id", "alert_type", "alert_ts"], "left_semi"
        )
        write_batch(
            to_messages(moderation_requests(alerts), "moderation_requests"),
            f"{out}/requests",
            batch_id,
        )
        insert_if_absent(
            milestones_of(rows)
            .withColumn("id", F.uuid())
            .select(*MILESTONES.names),
            f"{out}/milestones",
        )

    return write


def metadata_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for `upload_metadata` rows: the latest row of each image."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put_latest(latest_metadata(batch), path, batch_id)

    return write


class DecisionSink:
    """Batch function that answers requests and stores the decisions.

    Requests on images that are not known get no decision but a row in the errors table.

    Tables are passed as functions so that each batch reads their current state. With `totals`
    (the state of a running count, see `buckets.read_totals`), a batch reads no more of the events than
    the longest window before its first request. With
    `model_root`, the model pointer is looked at before a batch, at most every
    `check_seconds`.
    """

    def __init__(
        self,
        out: str,
        events: Callable[[], DataFrame],
        images: Callable[[], DataFrame],
        users: Callable[[], DataFrame],
        settings: Settings = Settings(),
        model_root: str | None = None,
        check_seconds: float = 30.0,
        totals: Callable[[], DataFrame] | None = None,
    ):
        self.out, self.settings = out, settings
        self.events, self.images, self.users, self.totals = events, images, users, totals
        self.model_root, self.check_seconds = model_root, check_seconds
        self.model, self.pointer, self.checked = None, None, float("-inf")

    def refresh_model(self, spark: SparkSession) -> None:
        if self.model_root is None:
            return
        if time.monotonic() - self.checked < self.check_seconds:
            return
        self.checked = time.monotonic()
        model, self.pointer = load_latest_model(spark, self.model_root, self.pointer)
        self.model = model or self.model

    def __call__(self, requests: DataFrame, batch_id: int) -> None:
        self.refresh_model(requests.sparkSession)
        features = serving_features(
            requests,
            self.events(),
            self.images(),
            self.users(),
            self.settings,
            self.totals() if self.totals else None,
        )
        scored = decide(
            features,
            self.settings,
            use_model=self.model_root is not None,
            model=self.model,
            version=self.pointer["version"] if self.pointer else None,
        )
        write_batch(decision_rows(scored), f"{self.out}/decisions", batch_id)
        write_batch(
            missing_requests(requests, self.images(), self.settings).select(
                "event_id", "image_id", "trigger", "ts", "error"
            ),
            f"{self.out}/errors",
            batch_id,
        )


def run_available(
    stream: DataFrame,
    target: str | Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    mode: str = "append",
    timeout: float | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Process what is there and stop: to a Parquet folder or through a batch function.

    There is no time limit unless `timeout` (seconds) is given. `partitions` is that of the stream's
    shuffles and state, if its checkpoint is new; without it the session's setting counts.
    """
    spark = stream.sparkSession
    _listen(spark)
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
    )
    writer = writer.foreachBatch(target) if callable(target) else writer.format("parquet").option("path", target)
    with _shuffles(spark, partitions):  # a stream keeps the settings it starts with
        query = writer.start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query


@contextmanager
def _shuffles(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    before = spark.conf.get(SHUFFLES)
    spark.conf.set(SHUFFLES, partitions or before)
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES, before)


class RunTotals(StreamingQueryListener):
    """Adds up every progress report of each run: batches, rows read, rows dropped as late."""

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        sums = self.totals.setdefault(
            str(p.runId), {"batches": 0, "input_rows": 0, "late_rows": 0}
        )
        sums["batches"] += 1
        sums["input_rows"] += p.numInputRows
        sums["late_rows"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryTerminated(self, event) -> None:
        if ended := self.ended.get(str(event.runId)):
            ended.set()

    def of(self, query: StreamingQuery, wait: float = 30.0) -> dict[str, int]:
        """Totals of a run; for an ended run, once its last report has arrived."""
        run = str(query.runId)
        if not query.isActive and run in self.ended:
            self.ended[run].wait(wait)
        return dict(self.totals.get(run, {"batches": 0, "input_rows": 0, "late_rows": 0}))


_totals: dict[str, RunTotals] = {}  # by application


def _listen(spark: SparkSession) -> RunTotals:
    application = spark.sparkContext.applicationId
    if application not in _totals:
        _totals[application] = RunTotals()
        spark.streams.addListener(_totals[application])
    return _totals[application]


def run_statistics(query: StreamingQuery) -> dict[str, int]:
    """Batches, rows read and rows dropped as too late, over all batches of a run."""
    return _listen(SparkSession.active()).of(query)
