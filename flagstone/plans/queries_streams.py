"""Registered queries that run as streams over the event log, a file at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.functions.times import after, micros
from flagstone.operators.ingest import parse_requests
from flagstone.operators.windows import latest_metadata
from flagstone.plans.queries_events import upload_rows
from flagstone.plans.queries_features import _DECISION_SQL, _requests
from flagstone.plans.registry import (
    ALERT,
    BUCKET,
    DAY,
    GRAIN_ALERT_SQL,
    HOUR,
    MESSAGE_SQL,
    MODEL_SQL,
    ROLLING_COLUMNS,
    ROLLING_SQL,
    TRAIN,
    US,
    grain_sql,
    messages,
    ntz,
    register,
)
from flagstone.config import TOPICS, Settings
from flagstone.schemas import MILESTONES
from flagstone.sources import eventlog, readers, writers
from flagstone.sources.scratch import scratch_dir, staged
from flagstone.streaming import buckets, ingest, jobs
from flagstone.streaming import state as st

ROUNDS = 2
DELAY = "1 hour"


def rounds(df: DataFrame, name: str, time: str = "ts") -> Iterator[DataFrame]:
    """Grow a folder by time slices of equal size; yield it as a stream after each.

    The consumer runs its query to the end each time, so every slice is at least one
    micro-batch and the query restarts from its checkpoint in between.
    """
    spark = df.sparkSession
    us = micros(time)
    inner = [i / ROUNDS for i in range(1, ROUNDS)]
    cuts = df.agg(F.percentile_approx(us, inner, 1000).alias("cuts")).first()["cuts"]
    edges = [None, *cuts, None]
    path = scratch_dir(spark, name)
    for low, high in zip(edges, edges[1:]):
        part = df
        if low is not None:
            part = part.where(us > low)
        if high is not None:
            part = part.where(us <= high)
        part.write.mode("append").parquet(path)
        yield spark.readStream.schema(df.schema).parquet(path)


def run_rounds(
    df: DataFrame,
    name: str,
    build: Callable[[DataFrame], DataFrame],
    target: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    time: str = "ts",
    partitions: int | None = None,
) -> DataFrame | None:
    """Feed a frame to a streaming query in rounds; return its table, if it writes one."""
    spark = df.sparkSession
    checkpoint = scratch_dir(spark, f"{name}-checkpoint")
    path = scratch_dir(spark, f"{name}-out") + "/table"
    schema = None
    for source in rounds(df, name, time):
        stream = build(source)
        schema = stream.schema
        jobs.run_available(stream, target or path, checkpoint, mode, partitions=partitions)
    return None if target else spark.read.schema(schema).parquet(path)


@register(
    "s1_stream_ingest",
    f"""{MESSAGE_SQL} SELECT event_type, image_id, ts,
    CASE WHEN event_type IN ('comment', 'flag') THEN event_id
         ELSE event_type || 's-' || (k % 4) || '-' || n END AS event_id
    FROM checked WHERE reject_reason IS NULL""",
)
def s1_stream_ingest(spark: SparkSession, root: str) -> DataFrame:
    raw = messages(eventlog.load_log(spark, root))
    path = scratch_dir(spark, "messages")
    raw.write.mode("overwrite").parquet(path)
    stream = readers.stream_topics(spark, path=path, per_trigger=4, topics=TOPICS)
    events = jobs.parsed_stream(stream).select("event_type", "image_id", "ts", "event_id")
    out = scratch_dir(spark, "events") + "/table"
    jobs.run_available(events, out)
    return ntz(spark.read.schema(events.schema).parquet(out))


@register(
    "s4_message_sink",
    f"""{GRAIN_ALERT_SQL} SELECT 'moderation_requests' AS topic, count(*) AS n FROM alert
    WHERE alert_type IN ('viral', 'suspicious')""",
)
def s4_message_sink(spark: SparkSession, root: str) -> DataFrame:
    """Requests published by the state job, counted per topic."""
    out = _state_output(spark, root)
    return _batches(spark, f"{out}/requests", "topic string, value string").groupBy(
        "topic"
    ).agg(F.count("*").alias("n"))


@register(
    "t1_stream_tumbling",
    f"""{MODEL_SQL} SELECT image_id, event_type, make_timestamp(us - us % {BUCKET}) AS window_start,
    make_timestamp(us - us % {BUCKET} + {BUCKET}) AS window_end, count(*) AS event_count FROM byuser
    GROUP BY image_id, event_type, us - us % {BUCKET}""",
)
def t1_stream_tumbling(spark: SparkSession, root: str) -> DataFrame:
    """All buckets, open ones too: update mode into a latest-state table."""
    events = eventlog.by_user(eventlog.load_log(spark, root))
    return _latest_windows(events, "tumbling", lambda s: jobs.tumbling_stream(s, TRAIN, DELAY))


def _latest_windows(
    events: DataFrame, name: str, build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Window counts in update mode; the largest count of a window is its last one."""
    spark = events.sparkSession
    path = scratch_dir(spark, f"{name}-windows")
    run_rounds(events, name, build, jobs.latest_windows(path), mode="update")
    key = ("image_id", "event_type", "window_start", "window_end")
    schema = build(events).schema
    return ntz(writers.get_latest(spark, path, schema, key, order=("event_count",)))


@register(
    "t3_stream_sliding",
    f"""{MODEL_SQL}, s AS (SELECT image_id, event_type,
      us - us % (21600 * CAST({US} AS BIGINT)) - i * 21600 * CAST({US} AS BIGINT) AS ws
      FROM byuser, (VALUES (0), (1), (2), (3)) AS v(i))
    SELECT image_id, event_type, make_timestamp(ws) AS window_start,
      make_timestamp(ws + 86400 * CAST({US} AS BIGINT)) AS window_end, count(*) AS event_count FROM s
    GROUP BY image_id, event_type, ws""",
)
def t3_stream_sliding(spark: SparkSession, root: str) -> DataFrame:
    events = eventlog.by_user(eventlog.load_log(spark, root))
    return _latest_windows(
        events, "sliding", lambda s: jobs.sliding_stream(s, "1 day", "6 hours", DELAY)
    )


def _counted(log: DataFrame) -> DataFrame:
    return eventlog.by_user(log).select(
        "image_id", "event_type", "ts", F.lit(1).cast("long").alias("n")
    )


@register(
    "t2_stream_rolling",
    f"""{ROLLING_SQL} SELECT image_id, event_type, ts, {ROLLING_COLUMNS} FROM rolling
    WHERE event_type <> 'flag'""",
)
def t2_stream_rolling(spark: SparkSession, root: str) -> DataFrame:
    """Keyed state fed with single events: exact at every event."""
    rows = run_rounds(
        _counted(eventlog.load_log(spark, root)),
        "rolling",
        lambda s: st.rolling_state(s, ALERT, DELAY),
        partitions=st.partitions(spark),
    )
    return ntz(rows.select("image_id", "event_type", "ts", *ROLLING_COLUMNS.split(", ")))


@register(
    "t2_stream_rolling_by_grain",
    f"""{grain_sql(HOUR)} SELECT DISTINCT image_id, event_type, ts, {ROLLING_COLUMNS} FROM rolling
    WHERE event_type <> 'flag'""",
)
def t2_stream_rolling_by_grain(spark: SparkSession, root: str) -> DataFrame:
    """Two stages: counts per grain of one hour, then keyed state over the counts.

    A grain that came in several batches has as many state rows; the last has the largest counts.
    """
    counts = _grains(eventlog.load_log(spark, root), "1 hour")
    shown = ROLLING_COLUMNS.split(", ")
    rows = run_rounds(
        counts,
        "rolling",
        lambda s: st.rolling_state(s, ALERT, DELAY).select("image_id", "event_type", "ts", *shown),
        partitions=st.partitions(spark),
    )
    last = [F.max(c).alias(c) for c in shown]
    return ntz(rows.groupBy("image_id", "event_type", "ts").agg(*last))


def _grains(log: DataFrame, grain: str, path: str | None = None) -> DataFrame:
    """First stage of the state jobs: a table of counts per grain and batch.

    Only what is counted is fed: an event's id would be most of the bytes of each round.
    """
    events = eventlog.by_user(log).select("image_id", "event_type", "ts")
    path = path or scratch_dir(log.sparkSession, "grains-out")
    run_rounds(events, "grains", lambda s: s, jobs.grain_sink(path, grain))
    return _batches(log.sparkSession, path, st.grain_totals(events, grain).schema)


def _state_output(spark: SparkSession, root: str, out: str | None = None) -> str:
    """Both stages, at the default grain of one second."""
    out = out or scratch_dir(spark, "state")
    run_rounds(
        _grains(eventlog.load_log(spark, root), st.GRAIN, f"{out}/grains"),
        "counts",
        lambda s: st.rolling_state(s, ALERT, DELAY),
        jobs.state_sinks(out, ALERT),
        partitions=st.partitions(spark),
    )
    return out


def _batches(spark: SparkSession, path: str, schema) -> DataFrame:
    return writers.read_run(spark, path, schema)


@register(
    "t5_stream_alerts",
    f"{GRAIN_ALERT_SQL} SELECT image_id, alert_type, alert_ts, observed, threshold FROM alert",
)
def t5_stream_alerts(spark: SparkSession, root: str) -> DataFrame:
    out = _state_output(spark, root)
    return ntz(spark.read.schema(_ALERT).parquet(f"{out}/alerts"))


_ALERT = "image_id string, alert_type string, alert_ts timestamp, observed long, threshold long"


@register(
    "t15_reset",
    f"""{GRAIN_ALERT_SQL} SELECT 'grains' AS output, count(DISTINCT (image_id, event_type, us)) AS n_rows,
      count(*) AS n FROM grain WHERE event_type IN ('view', 'comment', 'flag')
    UNION ALL SELECT alert_type, count(*), CAST(sum(observed) AS BIGINT) FROM alert GROUP BY alert_type
    UNION ALL SELECT 'milestones', count(*), CAST(sum(milestone_value) AS BIGINT) FROM milestone""",
)
def t15_reset(spark: SparkSession, root: str) -> DataFrame:
    """Both stages twice into one folder, the second time with new checkpoints, as after a reset:
    counts are those of one run, and each alert and milestone is there once."""
    out = scratch_dir(spark, "reset")
    for _ in range(2):
        _state_output(spark, root, out)
    total = lambda c: F.sum(c).cast("long").alias("n")
    grains = _batches(spark, f"{out}/grains", "image_id string, event_type string, ts timestamp, n long")
    per_grain = grains.groupBy("image_id", "event_type", "ts").agg(F.sum("n").alias("n"))
    alerts = spark.read.schema(_ALERT).parquet(f"{out}/alerts")
    reached = spark.read.schema(MILESTONES).parquet(f"{out}/milestones")
    return (
        per_grain.agg(F.count("*").alias("n_rows"), total("n")).select(F.lit("grains").alias("output"), "n_rows", "n")
        .unionByName(alerts.groupBy(F.col("alert_type").alias("output")).agg(F.count("*").alias("n_rows"), total("observed")))
        .unionByName(
            reached.agg(F.count("*").alias("n_rows"), total("milestone_value")).select(
                F.lit("milestones").alias("output"), "n_rows", "n"
            )
        )
    )


@register(
    "t7_stream_milestones",
    f"{GRAIN_ALERT_SQL} SELECT image_id, milestone_type, milestone_value, reached_at FROM milestone",
)
def t7_stream_milestones(spark: SparkSession, root: str) -> DataFrame:
    out = _state_output(spark, root)
    return ntz(spark.read.schema(MILESTONES).parquet(f"{out}/milestones").drop("id"))


@register(
    "t8_stream_flag_totals",
    f"""{MODEL_SQL} SELECT image_id, count(*) AS total_flags FROM eng
    WHERE event_type = 'flag' GROUP BY image_id""",
)
def t8_stream_flag_totals(spark: SparkSession, root: str) -> DataFrame:
    """Update mode: each batch puts the changed totals, the latest row of each image counts."""
    events = eventlog.engagement(eventlog.load_log(spark, root)).select(
        "image_id", "event_type", "ts"
    )
    path = scratch_dir(spark, "flags")
    run_rounds(
        events,
        "events",
        jobs.flag_stream,
        lambda batch, i: writers.put_latest(batch, path, i),
        mode="update",
    )
    schema = jobs.flag_stream(events).schema
    return writers.get_latest(spark, path, schema, order=("total_flags",))


@register(
    "t9_stream_metadata",
    f"""{MODEL_SQL} SELECT user_id AS image_id, id AS event_id, coalesce(category, 'unknown') AS category,
    uploaded_at AS ts FROM img QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY up DESC) = 1""",
)
def t9_stream_metadata(spark: SparkSession, root: str) -> DataFrame:
    uploads = upload_rows(eventlog.load_log(spark, root)).withColumn(
        "image_id", F.col("user_id")
    )
    path = scratch_dir(spark, "metadata")
    run_rounds(uploads, "uploads", lambda s: s, jobs.metadata_sink(path))
    latest = writers.get_latest(spark, path, latest_metadata(uploads).schema)
    return ntz(latest.select("image_id", "event_id", "category", "ts"))


@register(
    "t11_stream_decisions",
    f"""{_DECISION_SQL} SELECT image_id, 'heuristic' AS inference_mode, p AS moderation_probability,
    rec AS recommendation, 'flagged' AS trigger_type FROM final""",
)
def t11_stream_decisions(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    events = staged(eventlog.engagement(log), "engagement")
    out = scratch_dir(spark, "decisions")
    sink = jobs.DecisionSink(
        out,
        events=lambda: events,
        images=lambda: eventlog.images(log),
        users=lambda: eventlog.users(log),
        settings=TRAIN,
    )
    run_rounds(_requests(events), "requests", lambda s: s, sink)
    schema = (
        "id string, image_id string, inference_mode string, moderation_probability double, "
        "recommendation string, trigger_type string, created_at timestamp"
    )
    return _batches(spark, f"{out}/decisions", schema).drop("id", "created_at")


def _request_chain(spark: SparkSession, root: str) -> str:
    """Requests as messages in a topic, parsed and answered; each fourth names no known image."""
    log = eventlog.load_log(spark, root)
    events = staged(eventlog.engagement(log), "engagement")
    asked = _requests(events).withColumn("offset", F.col("event_id").cast("long"))
    strange = F.col("offset") % 4 == 0
    body = F.struct(
        F.when(strange, F.concat(F.lit("gone-"), "image_id")).otherwise(F.col("image_id")).alias("image_id"),
        F.when(F.col("offset") % 2 == 1, F.col("trigger")).alias("trigger"),
        (micros("ts") / 1e6).alias("timestamp"),
    )
    sent = asked.select(
        F.lit("moderation_requests").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.col("ts").alias("timestamp"),
        F.to_json(body).alias("value"),
    )
    out = scratch_dir(spark, "answers")
    sink = jobs.DecisionSink(
        out,
        events=lambda: events,
        images=lambda: eventlog.images(log),
        users=lambda: eventlog.users(log),
        settings=TRAIN,
    )
    run_rounds(sent, "request-topic", parse_requests, sink, time="timestamp")
    return out


def _bucket_checkpoint(events: DataFrame, settings: Settings, grain_seconds: int) -> str:
    """Checkpoint of a bucket count that has read all events, in rounds."""
    spark = events.sparkSession
    checkpoint = scratch_dir(spark, "buckets-checkpoint")
    with buckets.state_store(spark):
        for source in rounds(events, "bucket-events"):
            jobs.run_available(
                buckets.bucket_state(source, settings, DELAY, grain_seconds),
                lambda batch, batch_id: batch.write.format("noop").mode("append").save(),
                checkpoint,
                "update",
            )
    return checkpoint


_LIFE = max(seconds for _, seconds in ALERT.rolling) + HOUR


@register(
    "t4_state_expiry",
    f"""{MODEL_SQL}, seen AS (
      SELECT image_id, event_type, us - us % {HOUR * US} AS bucket,
        (SELECT max(us) // 1000 - {HOUR} * 1000 FROM byuser) AS watermark_ms
      FROM byuser WHERE event_type IN ('view', 'comment', 'flag'))
    SELECT image_id, event_type, make_timestamp(bucket) AS ts, count(*) AS n FROM seen
    WHERE (bucket + {_LIFE * US}) // 1000 > watermark_ms GROUP BY ALL""",
)
def t4_state_expiry(spark: SparkSession, root: str) -> DataFrame:
    """The state after the stream's end: buckets that a window can still reach, and no others."""
    events = eventlog.by_user(eventlog.load_log(spark, root))
    return ntz(buckets.read_buckets(spark, _bucket_checkpoint(events, ALERT, HOUR)))


@register(
    "t10_state_totals",
    f"""{MODEL_SQL} SELECT image_id, count(*) FILTER (WHERE event_type = 'view') AS total_views,
      count(*) FILTER (WHERE event_type = 'comment') AS total_comments,
      count(*) FILTER (WHERE event_type = 'flag') AS total_flags, make_timestamp(max(us - us % {HOUR * US})) AS last_ts
    FROM byuser WHERE event_type IN ('view', 'comment', 'flag') GROUP BY image_id""",
)
def t10_state_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals outlive the buckets they were counted from."""
    events = eventlog.by_user(eventlog.load_log(spark, root))
    return ntz(buckets.read_totals(spark, _bucket_checkpoint(events, ALERT, HOUR)))


@register(
    "t11_decisions_from_state",
    f"""{_DECISION_SQL} SELECT image_id, 'heuristic' AS inference_mode, p AS moderation_probability,
    rec AS recommendation, 'flagged' AS trigger_type FROM final""",
)
def t11_decisions_from_state(spark: SparkSession, root: str) -> DataFrame:
    """Decisions with totals read from the state of a running count, and events by a pruned scan."""
    log = eventlog.load_log(spark, root)
    events = staged(eventlog.engagement(log), "engagement")
    checkpoint = _bucket_checkpoint(events, TRAIN, 1)
    out = scratch_dir(spark, "state-decisions")
    sink = jobs.DecisionSink(
        out,
        events=lambda: events,
        images=lambda: eventlog.images(log),
        users=lambda: eventlog.users(log),
        settings=TRAIN,
        totals=lambda: buckets.read_totals(spark, checkpoint),
    )
    run_rounds(_requests(events), "requests", lambda s: s, sink)
    schema = (
        "image_id string, inference_mode string, moderation_probability double, "
        "recommendation string, trigger_type string"
    )
    return _batches(spark, f"{out}/decisions", schema)


# Every seventh message comes late by a third of the whole time; two rounds, cut in the middle.
_ARRIVAL_SQL = f"""{MESSAGE_SQL},
arrival AS (
  SELECT *, CASE WHEN k = 7 THEN 'bad_json' ELSE reject_reason END AS reason,
    us + CASE WHEN n % 7 = 0 THEN (SELECT (max(us) - min(us)) // 3 FROM checked) ELSE 0 END AS arrived,
    (SELECT (max(us) + min(us)) // 2 FROM checked) AS cut FROM checked),
split AS (
  SELECT *, arrived > cut AND us < (SELECT max(us) FROM arrival WHERE arrived <= cut AND reason IS NULL) - {HOUR * US} AS is_late,
    CASE WHEN event_type IN ('comment', 'flag') THEN event_id ELSE event_type || 's-' || (k % 4) || '-' || n END AS id
  FROM arrival)"""


def _ingested(spark: SparkSession, root: str) -> str:
    """Damaged messages in two rounds, some of them late, through the ingest sink."""
    log = eventlog.load_log(spark, root)
    raw = staged(messages(log, damage=True), "raw-messages")
    us, number = micros("timestamp"), F.col("offset")
    ends = raw.agg(F.min(us).alias("low"), F.max(us).alias("high")).first()
    late = F.when(number % 7 == 0, (ends.high - ends.low) // 3).otherwise(0)
    cut = (ends.high + ends.low) // 2
    out, path = scratch_dir(spark, "ingest"), scratch_dir(spark, "ingest-in")
    checkpoint = scratch_dir(spark, "ingest-checkpoint")
    sink = ingest.IngestSink(out, HOUR)
    for part in (raw.where(us + late <= cut), raw.where(us + late > cut)):
        part.write.mode("append").parquet(path)
        jobs.run_available(spark.readStream.schema(raw.schema).parquet(path), sink, checkpoint)
    return out


_EVENT = "event_type string, image_id string, event_id string, ts timestamp"


@register(
    "p8_stream_events",
    f"""{_ARRIVAL_SQL} SELECT event_type, image_id, id AS event_id, ts FROM split WHERE reason IS NULL AND NOT is_late""",
)
def p8_stream_events(spark: SparkSession, root: str) -> DataFrame:
    return ntz(ingest.read_output(spark, _ingested(spark, root), "events", _EVENT))


@register(
    "t12_late_events",
    f"""{_ARRIVAL_SQL} SELECT event_type, image_id, id AS event_id, ts FROM split WHERE reason IS NULL AND is_late""",
)
def t12_late_events(spark: SparkSession, root: str) -> DataFrame:
    """What the watermark would drop, kept in a table of its own."""
    return ntz(ingest.read_output(spark, _ingested(spark, root), "late", _EVENT))


@register(
    "p8_stream_quarantine",
    f"""{_ARRIVAL_SQL} SELECT n AS "offset", reason AS reject_reason FROM split WHERE reason IS NOT NULL""",
)
def p8_stream_quarantine(spark: SparkSession, root: str) -> DataFrame:
    schema = '"offset" long, reject_reason string'.replace('"', "")
    return ingest.read_output(spark, _ingested(spark, root), "quarantine", schema)


@register(
    "t11_request_chain",
    f"""{_DECISION_SQL} SELECT image_id, 'heuristic' AS inference_mode, p AS moderation_probability,
    rec AS recommendation,
    CASE WHEN CAST(event_id AS BIGINT) % 2 = 1 THEN 'flagged' ELSE 'unknown' END AS trigger_type
    FROM final WHERE CAST(event_id AS BIGINT) % 4 <> 0""",
)
def t11_request_chain(spark: SparkSession, root: str) -> DataFrame:
    """Messages, parsing and decisions in one stream; a missing trigger is unknown."""
    schema = (
        "image_id string, inference_mode string, moderation_probability double, "
        "recommendation string, trigger_type string"
    )
    return _batches(spark, f"{_request_chain(spark, root)}/decisions", schema)


@register(
    "t11_request_errors",
    f"""{MODEL_SQL} SELECT 'moderation_requests-0-' || n AS event_id, 'gone-' || image_id AS image_id,
    'Image not found' AS error FROM eng WHERE event_type = 'flag' AND n % 4 = 0""",
)
def t11_request_errors(spark: SparkSession, root: str) -> DataFrame:
    schema = "event_id string, image_id string, error string"
    return _batches(spark, f"{_request_chain(spark, root)}/errors", schema)


@register(
    "t13_stream_redelivery",
    f"""{MODEL_SQL} SELECT event_id, event_type, ts FROM byuser""",
)
def t13_stream_redelivery(spark: SparkSession, root: str) -> DataFrame:
    """Every third event arrives again, half of them in a later round, and is kept once."""
    events = eventlog.by_user(eventlog.load_log(spark, root)).withColumn("arrived", F.col("ts"))
    again = events.where(F.col("event_id").cast("long") % 3 == 0).withColumn(
        "arrived", after(F.col("ts"), F.when(F.col("event_id").cast("long") % 2 == 0, 20 * DAY).otherwise(1))
    )
    unique = run_rounds(
        events.unionByName(again), "events", lambda s: jobs.deduplicated(s, "40 days"), time="arrived"
    )
    return ntz(unique.select("event_id", "event_type", "ts"))
