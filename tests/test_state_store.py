"""State that other jobs read, serving from it, and ingest with several outputs."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.plans import serving
from flagstone.sources import writers
from flagstone.streaming import buckets, ingest, jobs
from helpers import EVENT, at, events, rows

SETTINGS = Settings()
RAW = "topic string, partition int, offset long, timestamp timestamp, value string"


def feed(spark, path, frames, checkpoint):
    for frame in frames:
        frame.write.mode("append").parquet(path)
        source = spark.readStream.schema(frame.schema).parquet(path)
        with buckets.state_store(spark):
            jobs.run_available(
                buckets.bucket_state(source, SETTINGS, "1 minute"),
                lambda b, i: b.write.format("noop").mode("append").save(), checkpoint, "update",
            )


def test_state_of_a_busy_image_is_bounded_and_expires_when_idle(spark, tmp_path):
    busy = [("hot", "view", s / 50) for s in range(1500)]  # 30 seconds, 50 views each
    checkpoint = str(tmp_path / "checkpoint")
    feed(spark, str(tmp_path / "in"), [events(spark, busy), events(spark, [("other", "flag", 10.0)])], checkpoint)
    held = buckets.read_buckets(spark, checkpoint).where("image_id = 'hot'")
    assert held.count() == 30 and held.agg(F.sum("n")).first()[0] == 1500
    # Nothing more comes for the image, yet its buckets go once the watermark is past all windows.
    late = [("other", "view", 3 * 3600.0)]
    feed(spark, str(tmp_path / "in"), [events(spark, late)], checkpoint)
    assert rows(buckets.read_buckets(spark, checkpoint)) == [("other", "view", at(3 * 3600), 1)]
    totals = buckets.read_totals(spark, checkpoint)
    assert rows(totals, "image_id", "total_views", "total_flags") == [("hot", 1500, 0), ("other", 1, 1)]


def test_bucket_counts_leave_no_row_to_python(spark, tmp_path):
    path = str(tmp_path / "in")
    events(spark, [("i", "view", 0)]).write.parquet(path)
    source = spark.readStream.schema(EVENT).parquet(path)
    plan = buckets.bucket_state(source, SETTINGS)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "PySpark" not in plan and "Pandas" not in plan


def count_buckets(spark, tmp_path, frames, settings, grain):
    """Feed a bucket count a frame at a time; its checkpoint and the rows of each micro-batch."""
    path, checkpoint, given = str(tmp_path / "in"), str(tmp_path / "checkpoint"), []
    for frame in frames:
        frame.write.mode("append").parquet(path)
        stream = buckets.bucket_state(spark.readStream.schema(EVENT).parquet(path), settings, "1 minute", grain)
        with buckets.state_store(spark):
            jobs.run_available(stream, lambda b, i: given.extend(b.collect()), checkpoint, "update")
    return checkpoint, given


def test_bucket_stream_gives_the_totals_of_touched_images(spark, tmp_path):
    first = events(spark, [("i", "view", 0.5), ("i", "comment", 1), ("j", "flag", 2), (None, "view", 3), ("j", "odd", 4)])
    checkpoint, given = count_buckets(spark, tmp_path, [first, events(spark, [("i", "view", 9.5)])], SETTINGS, 1)
    assert [tuple(r) for r in sorted(given)] == [("i", 1, 1, 0, at(1)), ("i", 2, 1, 0, at(9)), ("j", 0, 0, 1, at(2))]
    assert rows(buckets.read_totals(spark, checkpoint)) == [("i", 2, 1, 0, at(9)), ("j", 0, 0, 1, at(2))]
    assert rows(buckets.buckets_held(spark, checkpoint)) == [("i", 3), ("j", 1)]


def test_buckets_of_a_grain_that_divides_no_window_end_at_their_own_time(spark, tmp_path):
    settings = Settings(window_1min=10, window_5min=20, window_1hr=50)
    frame = events(spark, [("i", "view", 7.0 * k) for k in range(60)])  # the last one at 413 s
    checkpoint, _ = count_buckets(spark, tmp_path, [frame], settings, 7)
    start = lambda s: s - (at(s).timestamp() % 7)  # noqa: E731  buckets begin at multiples of 7 s of the epoch
    held = sorted({start(7.0 * k) for k in range(60) if start(7.0 * k) + 50 + 7 > 413 - 60})
    assert rows(buckets.read_buckets(spark, checkpoint), "ts", "n") == [(at(s), 1) for s in held]


def test_totals_from_state_equal_totals_from_history(spark):
    history = [(f"i{k % 3}", ["view", "comment", "flag"][k % 7 % 3], 600.0 * k) for k in range(300)]
    log = events(spark, history)
    # The state has seen less than the log holds; requests lie before and after its last event.
    seen = log.where(F.col("ts") <= F.lit(at(600.0 * 280)))
    totals = seen.groupBy("image_id").agg(
        *[F.count_if(F.col("event_type") == k).alias(f"total_{k}s") for k in ("view", "comment", "flag")],
        F.max("ts").alias("last_ts"),
    )
    asked = [(f"i{k % 3}", f"r{k}", at(600.0 * k + 1)) for k in (250, 265, 279, 280, 290, 299)]
    requests = spark.createDataFrame(asked + [("new", "r", at(600.0 * 299))], "image_id string, event_id string, ts timestamp")
    recent = serving.recent_events(log, requests, SETTINGS)
    assert recent.count() < 80
    counted = serving.rolling_counts(recent, SETTINGS, probes=requests)
    got = serving.totals_at_requests(counted, recent, totals, SETTINGS)
    expected = serving.rolling_counts(log, SETTINGS, probes=requests)
    assert rows(got, *expected.columns) == rows(expected)


def test_recent_events_are_pruned_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    events(spark, [("i", "view", 60.0 * k) for k in range(500)]).write.parquet(path)
    requests = spark.createDataFrame([("i", "r", at(30_000))], "image_id string, event_id string, ts timestamp")
    recent = serving.recent_events(spark.read.parquet(path), requests, SETTINGS)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    first = at(30_000) - timedelta(hours=1)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan and str(first.hour) in plan


def message(offset, seconds, kind="view", damaged=False):
    stamp = at(seconds).isoformat()
    value = f'{{"event_type": "{kind}", "image_id": "i", "viewed_at": "{stamp}Z"}}'
    return ("views", 0, offset, at(seconds), value[:20] if damaged else value)


def test_ingest_keeps_every_record_and_replays_alike(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = ingest.IngestSink(out, delay_seconds=60)
    first = spark.createDataFrame([message(0, 0), message(1, 500), message(2, 1, damaged=True)], RAW)
    second = spark.createDataFrame([message(3, 439), message(4, 440), message(5, 900), message(6, 9, "odd")], RAW)

    def held(name, column):
        schema = "event_id string, reject_reason string"
        return sorted(r[0] for r in ingest.read_output(spark, out, name, schema).select(column).collect())

    for _ in range(2):  # the second time every batch is a replay
        sink(first, 0)
        sink(second, 1)
        assert held("events", "event_id") == ["views-0-0", "views-0-1", "views-0-4", "views-0-5"]
        assert held("late", "event_id") == ["views-0-3"]
        assert held("quarantine", "reject_reason") == ["bad_json", "unknown_type"]
