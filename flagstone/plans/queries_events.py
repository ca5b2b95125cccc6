"""Registered queries: sources, sinks, parsing, validation, counts, windows, alerts."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.config import CATEGORIES
from flagstone.functions import features as fx
from flagstone.functions import text as tx
from flagstone.functions.times import after, floor_to, parse_instant
from flagstone.operators import alerts as al
from flagstone.operators import ingest as ing
from flagstone.operators import quality as q
from flagstone.operators import windows as win
from flagstone.operators.skew import skew_join
from flagstone.plans import hourly
from flagstone.plans.registry import (
    ALERT,
    ALERT_SQL,
    AS_OF,
    BUCKET,
    MESSAGE_SQL,
    MODEL_SQL,
    ROLLING_SQL,
    TRAIN,
    TRAINING_SQL,
    US,
    WINDOWS_SQL,
    alerts,
    messages,
    milestones,
    ntz,
    register,
    rolling,
    training,
    windows,
)
from flagstone.sources import eventlog, readers, writers
from flagstone.sources.scratch import scratch_dir

START = datetime(2024, 1, 10, tzinfo=timezone.utc)
END = datetime(2024, 1, 11, tzinfo=timezone.utc)
RANGE_SQL = "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'"


# ------------------------------------------------------------------- sources and sinks


@register(
    "s2_replay_range",
    f"""{MESSAGE_SQL} SELECT event_type || 's' AS topic, CAST(k % 4 AS INTEGER) AS "partition",
    n AS "offset", ts FROM message
    WHERE event_type IN ('view', 'comment', 'upload', 'flag') AND {RANGE_SQL}""",
)
def s2_replay_range(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_dir(spark, "messages")
    messages(eventlog.load_log(spark, root)).write.partitionBy("topic").parquet(path)
    replay = readers.read_topics_between(spark, START, END, path=path)
    return ntz(replay.select("topic", "partition", "offset", F.col("timestamp").alias("ts")))


@register(
    "s2_replay_by_index",
    f"""{MESSAGE_SQL} SELECT event_type || 's' AS topic, CAST(k % 4 AS INTEGER) AS "partition",
    n AS "offset", ts FROM message
    WHERE event_type IN ('view', 'comment', 'upload', 'flag') AND {RANGE_SQL}""",
)
def s2_replay_by_index(spark: SparkSession, root: str) -> DataFrame:
    """The replay opens the files that can hold the range and one that came after the index."""
    path, index = scratch_dir(spark, "messages") + "/log", scratch_dir(spark, "message-index") + "/table"
    sent = messages(eventlog.load_log(spark, root))
    later = F.col("offset") % 50 == 0
    sent.where(~later).repartitionByRange(16, "timestamp").write.partitionBy("topic").parquet(path)
    readers.index_messages(spark, path, index)
    sent.where(later).coalesce(1).write.mode("append").partitionBy("topic").parquet(path)
    replay = readers.read_topics_between(spark, START, END, path=path, index=index)
    return ntz(replay.select("topic", "partition", "offset", F.col("timestamp").alias("ts")))


@register(
    "s6_snapshot_round_trip",
    f"""{MODEL_SQL} SELECT id, user_id, s3_url, caption, category, uploaded_at FROM img""",
)
def s6_snapshot_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_dir(spark, "snapshot") + "/latest.parquet"
    images = eventlog.images(eventlog.load_log(spark, root))
    writers.overwrite_snapshot(images, path)
    writers.overwrite_snapshot(images, path)
    return ntz(readers.read_snapshot(spark, path, images.schema))


@register(
    "s9_append_idempotent",
    f"""{MODEL_SQL}, {WINDOWS_SQL}
    SELECT image_id, event_type, window_start, window_end, event_count FROM windows""",
)
def s9_append_idempotent(spark: SparkSession, root: str) -> DataFrame:
    """The same days written twice leave one copy."""
    table = f"{_lake(spark)}.windows"
    counts = windows(eventlog.load_log(spark, root)).withColumn(
        "window_day", F.date_format("window_start", "yyyy-MM-dd")
    )
    for _ in range(2):
        writers.append_table(counts, table, ["window_day"])
    return ntz(readers.scan_table(spark, table).drop("window_day"))


def _lake(spark: SparkSession) -> str:
    """A database of its own in the scratch folder."""
    path = scratch_dir(spark, "lake")
    name = "lake_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@register(
    "s10_replace_table",
    f"{MODEL_SQL} SELECT id, user_id, uploaded_at FROM img WHERE k % 2 = 0",
)
def s10_replace_table(spark: SparkSession, root: str) -> DataFrame:
    """A table replaced by its even half."""
    table = f"{_lake(spark)}.images"
    log = eventlog.load_log(spark, root)
    for part in (log, log.where(F.col("k") % 2 == 0)):
        images = eventlog.images(part).select("id", "user_id", "uploaded_at")
        writers.replace_table(images, table)
    return ntz(readers.scan_table(spark, table))


@register(
    "s11_insert_if_absent",
    f"""{ALERT_SQL} SELECT image_id, milestone_type, milestone_value, reached_at FROM milestone""",
)
def s11_insert_if_absent(spark: SparkSession, root: str) -> DataFrame:
    """All milestones inserted twice, the second time with later instants."""
    path = scratch_dir(spark, "milestones") + "/table"
    reached = milestones(eventlog.load_log(spark, root))
    writers.insert_if_absent(reached, path)
    writers.insert_if_absent(
        reached.withColumn("reached_at", after(F.col("reached_at"), 60)), path
    )
    return ntz(spark.read.schema(reached.schema).parquet(path))


@register(
    "s13_latest_state",
    f"""{MODEL_SQL} SELECT user_id AS image_id, event_id, event_type, ts FROM typed
    WHERE event_type IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, n DESC) = 1""",
)
def s13_latest_state(spark: SparkSession, root: str) -> DataFrame:
    """Each user's last event, put in four batches and read back."""
    path = scratch_dir(spark, "latest")
    events = eventlog.by_user(eventlog.load_log(spark, root))
    batch = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for i in range(4):
        writers.put_latest(win.latest_metadata(events.where(batch == i)), path, i)
    schema = win.latest_metadata(events).schema
    return ntz(writers.get_latest(spark, path, schema))


@register(
    "s13_latest_state_prefix",
    f"""{MODEL_SQL} SELECT user_id AS image_id, max(ts) AS ts FROM typed
    WHERE event_type IS NOT NULL AND user_id LIKE '1%' GROUP BY user_id""",
)
def s13_latest_state_prefix(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_dir(spark, "latest")
    state = win.latest_metadata(eventlog.by_user(eventlog.load_log(spark, root)))
    writers.put_latest(state, path, 0)
    found = writers.get_latest(spark, path, state.schema, prefix="1")
    return ntz(found.select("image_id", "ts"))


@register(
    "s14_csv_append",
    f"""{TRAINING_SQL} SELECT image_id, decision_point_minutes, views_1hr, category
    FROM training UNION ALL SELECT image_id, decision_point_minutes, views_1hr, category FROM training""",
)
def s14_csv_append(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_dir(spark, "csv") + "/features"
    rows = training(spark, root).select(
        "image_id", "decision_point_minutes", "views_1hr", "category"
    )
    writers.append_csv(rows, path)
    writers.append_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def _halve(batch):
    import pyarrow as pa
    import pyarrow.compute as pc

    return pa.RecordBatch.from_arrays(
        [batch.column("event_id"), pc.divide(batch.column("value"), 2.0)],
        names=["event_id", "half"],
    )


@register(
    "s15_batched_scan",
    f"{MODEL_SQL} SELECT event_id, value / CAST(2 AS DOUBLE) AS half FROM log",
)
def s15_batched_scan(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root).select("event_id", "value")
    return readers.map_batches(log, _halve, "event_id string, half double")


@register(
    "s17_category_from_path",
    f"""{MODEL_SQL} SELECT event_id,
    CASE WHEN k % 3 <> 0 AND k % 14 < 11
         THEN ([{", ".join(f"'{c}'" for c in CATEGORIES)}])[k % 14 + 1]
         ELSE 'Unknown' END AS category FROM log""",
)
def s17_category_from_path(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    folder = F.when(
        F.col("k") % 3 != 0, F.format_string("class_%02d", F.col("k") % 14)
    ).otherwise("misc")
    path = F.concat_ws("/", F.lit("/data/train"), folder, F.concat("event_id", F.lit(".jpg")))
    return log.select("event_id", tx.category_from_path(path).alias("category"))


# ---------------------------------------------------- parsing, filtering and validation


@register(
    "p1_parse_messages",
    f"""{MESSAGE_SQL} SELECT event_type, image_id, user_id, ts,
    CASE WHEN event_type IN ('comment', 'flag') THEN event_id
         ELSE event_type || 's-' || (k % 4) || '-' || n END AS event_id
    FROM checked WHERE reject_reason IS NULL""",
)
def p1_parse_messages(spark: SparkSession, root: str) -> DataFrame:
    raw = messages(eventlog.load_log(spark, root))
    events = ing.good(ing.validate(ing.parse_envelopes(raw)))
    return ntz(events.select("event_type", "image_id", "user_id", "ts", "event_id"))


@register(
    "p2_parse_instants",
    f"""{MODEL_SQL} SELECT event_id, CASE k % 6 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN ts
    WHEN 3 THEN ts + INTERVAL 5 HOUR END AS parsed FROM log""",
)
def p2_parse_instants(spark: SparkSession, root: str) -> DataFrame:
    """Z, +00:00, naive and -05:00 forms parse; junk and time-only text are null."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    form = F.col("k") % 6
    text = (
        F.when(form == 0, F.concat(stamp, F.lit("Z")))
        .when(form == 1, F.concat(stamp, F.lit("+00:00")))
        .when(form == 2, stamp)
        .when(form == 3, F.concat(stamp, F.lit("-05:00")))
        .when(form == 4, F.lit("not a time"))
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    log = eventlog.load_log(spark, root)
    return ntz(log.select("event_id", parse_instant(text).alias("parsed")))


@register(
    "p3_arrival_fallback",
    f"""{MODEL_SQL} SELECT event_id, CASE WHEN k % 4 = 0 THEN ts + INTERVAL 1 SECOND
    WHEN k % 4 = 1 THEN NULL ELSE ts END AS event_ts FROM log
    WHERE raw_type IN ('view', 'click', 'error', 'signup')""",
)
def p3_arrival_fallback(spark: SparkSession, root: str) -> DataFrame:
    """A missing time becomes the arrival time, unreadable text stays null: every type in its own column."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kinds = {"view": "view", "click": "comment", "error": "flag", "signup": "upload"}
    named = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in kinds.items()])
    log = eventlog.load_log(spark, root).withColumn("event_type", named).where("event_type IS NOT NULL")
    text = F.when(F.col("k") % 4 == 1, "yesterday").when(F.col("k") % 4 > 1, stamp)
    kind = F.col("event_type")
    rows = log.select(
        "event_id",
        "event_type",
        F.when(kind == "view", text).alias("viewed_at"),
        F.when(kind.isin("comment", "flag"), text).alias("created_at"),
        F.when(kind == "upload", text).alias("uploaded_at"),
        F.lit(None).cast("double").alias("timestamp"),
        after(F.col("ts"), 1).alias("arrived_at"),
    )
    return ntz(
        rows.select("event_id", ing.event_time(F.col("arrived_at")).alias("event_ts"))
    )


@register(
    "p4_event_time_by_type",
    f"""{MESSAGE_SQL} SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts FROM message
    WHERE event_type IN ('view', 'comment', 'upload', 'flag') GROUP BY event_type""",
)
def p4_event_time_by_type(spark: SparkSession, root: str) -> DataFrame:
    parsed = ing.parse_envelopes(messages(eventlog.load_log(spark, root)))
    timed = parsed.where(F.col("event_type").isin(*ing.KNOWN)).withColumn(
        "ts", ing.event_time()
    )
    return ntz(
        timed.groupBy("event_type").agg(
            F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
        )
    )


@register(
    "p5_route_comments",
    f"""{MESSAGE_SQL} SELECT event_id AS comment_id, image_id, ts FROM checked
    WHERE reject_reason IS NULL AND event_type = 'comment'""",
)
def p5_route_comments(spark: SparkSession, root: str) -> DataFrame:
    raw = messages(eventlog.load_log(spark, root))
    events = ing.good(ing.validate(ing.parse_envelopes(raw)))
    return ntz(ing.route(events, "comment").select("comment_id", "image_id", "ts"))


@register(
    "p6_required_keys",
    f"""{MESSAGE_SQL} SELECT event_type, count(*) AS n, count(*) FILTER (WHERE reject_reason IS NULL) AS kept
    FROM checked GROUP BY event_type""",
)
def p6_required_keys(spark: SparkSession, root: str) -> DataFrame:
    checked = ing.validate(ing.parse_envelopes(messages(eventlog.load_log(spark, root))))
    return checked.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("reject_reason").isNull()).alias("kept")
    )


@register("p7_time_range", f"{MODEL_SQL} SELECT event_id, ts FROM log WHERE {RANGE_SQL}")
def p7_time_range(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return ntz(win.in_range(log, START, END).select("event_id", "ts"))


@register(
    "p8_quarantine",
    f"""{MESSAGE_SQL} SELECT reject_reason, count(*) AS n FROM (
      SELECT CASE WHEN k = 7 THEN 'bad_json' ELSE reject_reason END AS reject_reason FROM checked)
    WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
)
def p8_quarantine(spark: SparkSession, root: str) -> DataFrame:
    raw = messages(eventlog.load_log(spark, root), damage=True)
    bad = ing.quarantine(ing.validate(ing.parse_envelopes(raw)))
    return bad.groupBy("reject_reason").agg(F.count("*").alias("n"))


@register(
    "p9_flag_targets",
    f"""{MODEL_SQL} SELECT event_id FROM facts WHERE event_type = 'flag'
    AND (image_id IS NOT NULL OR k % 2 = 0)""",
)
def p9_flag_targets(spark: SparkSession, root: str) -> DataFrame:
    events = eventlog.attributed(eventlog.load_log(spark, root))
    flags = events.where(F.col("event_type") == "flag").withColumn(
        "comment_id", F.when(F.col("k") % 2 == 0, F.col("event_id"))
    )
    return ing.flag_has_target(flags).select("event_id")


@register(
    "p10_accepted",
    f"""{MODEL_SQL} SELECT e.event_id, e.image_id FROM facts e
    WHERE e.image_id IN (SELECT id FROM img WHERE k % 3 <> 0)""",
)
def p10_accepted(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    known = eventlog.images(log.where(F.col("k") % 3 != 0))
    return ing.accepted(eventlog.attributed(log), known).select("event_id", "image_id")


@register(
    "p10_rejected",
    f"""{MODEL_SQL} SELECT e.event_id, e.image_id FROM facts e WHERE NOT EXISTS (
    SELECT 1 FROM img i WHERE i.k % 3 <> 0 AND i.id = e.image_id)""",
)
def p10_rejected(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    known = eventlog.images(log.where(F.col("k") % 3 != 0))
    return ing.rejected(eventlog.attributed(log), known).select("event_id", "image_id")


@register(
    "p10_lines_of_open_orders",
    """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""",
)
def p10_lines_of_open_orders(spark: SparkSession, root: str) -> DataFrame:
    lines = spark.read.parquet(f"{root}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber"
    )
    orders = (
        spark.read.parquet(f"{root}/orders.parquet")
        .where(F.col("o_orderstatus") == "O")
        .select(F.col("o_orderkey").alias("l_orderkey"))
    )
    return skew_join(lines, orders, ["l_orderkey"], "left_semi")


@register(
    "p11_first_user_per_name",
    f"""{MODEL_SQL} SELECT username, id, created_at FROM (
      SELECT 'u' || (CAST(id AS INTEGER) % 40) AS username, id, created_at, created_us FROM usr)
    QUALIFY row_number() OVER (PARTITION BY username ORDER BY created_us, id) = 1""",
)
def p11_first_user_per_name(spark: SparkSession, root: str) -> DataFrame:
    users = eventlog.users(eventlog.load_log(spark, root)).withColumn(
        "username", F.concat(F.lit("u"), (F.col("id").cast("int") % 40).cast("string"))
    )
    return ntz(ing.first_user_per_name(users).select("username", "id", "created_at"))


_STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


@register(
    "p12_messages",
    f"""{MODEL_SQL}
    SELECT 'views' AS topic, '{{"event_type":"view","image_id":"' || image_id || '","viewed_at":"'
           || {_STAMP} || '"}}' AS value FROM eng WHERE event_type = 'view'
    UNION ALL
    SELECT 'comments', '{{"event_type":"comment","comment_id":"' || event_id || '","image_id":"' || image_id
           || '","user_id":"' || user_id || '","content":"c' || k || '","created_at":"' || {_STAMP} || '+00:00"}}'
    FROM eng WHERE event_type = 'comment'
    UNION ALL
    SELECT 'flags', '{{"event_type":"flag","flag_id":"' || event_id || '","user_id":"' || user_id
           || '","image_id":"' || image_id || '","reason":"r' || k || '","created_at":"' || {_STAMP} || '+00:00"}}'
    FROM eng WHERE event_type = 'flag'
    UNION ALL
    SELECT 'uploads', '{{"event_type":"upload","image_id":"' || id || '","user_id":"' || user_id || '"'
           || coalesce(',"category":"' || category || '"', '')
           || coalesce(',"caption":"' || replace(caption, '"', '\\"') || '"', '')
           || ',"uploaded_at":"' || strftime(uploaded_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","s3_url":"' || s3_url || '"}}'
    FROM img""",
)
def p12_messages(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    events = eventlog.engagement(log).withColumns(
        {
            "id": F.col("event_id"),
            "created_at": F.col("ts"),
            "comment_id": F.lit(None).cast("string"),
            "content": F.concat(F.lit("c"), F.col("k").cast("string")),
            "reason": F.concat(F.lit("r"), F.col("k").cast("string")),
        }
    )
    return ing.union_topics(
        ing.view_messages(ing.route(events, "view")),
        ing.comment_messages(ing.route(events, "comment")),
        ing.flag_messages(ing.route(events, "flag")),
        ing.upload_messages(eventlog.images(log)),
    )


def upload_rows(log: DataFrame) -> DataFrame:
    return ing.upload_metadata(
        eventlog.images(log).select(
            F.col("id").alias("image_id"),
            F.col("id").alias("event_id"),
            "category",
            "caption",
            F.col("uploaded_at").alias("ts"),
            "user_id",
        )
    )


@register(
    "p13_upload_metadata",
    f"""{MODEL_SQL} SELECT id AS image_id, coalesce(category, 'unknown') AS category,
    CAST(length(coalesce(caption, '')) AS INTEGER) AS caption_length, uploaded_at AS ts, user_id FROM img""",
)
def p13_upload_metadata(spark: SparkSession, root: str) -> DataFrame:
    return ntz(upload_rows(eventlog.load_log(spark, root)).drop("event_id"))


@register(
    "p14_category_default",
    f"{MODEL_SQL} SELECT id, coalesce(category, 'Unknown') AS category FROM img",
)
def p14_category_default(spark: SparkSession, root: str) -> DataFrame:
    images = eventlog.images(eventlog.load_log(spark, root))
    return images.select("id", fx.known_category(F.col("category")).alias("category"))


@register(
    "p15_select_cast",
    "SELECT CAST(event_id AS VARCHAR) AS id, ts AS created_at, CAST(user_id AS VARCHAR) AS user_id FROM events",
)
def p15_select_cast(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return ntz(
        log.select("event_id", "ts", "user_id").withColumnsRenamed(
            {"event_id": "id", "ts": "created_at"}
        )
    )


@register(
    "p16_short_ids",
    f"{MODEL_SQL} SELECT id, substring(s3_url, 1, 8) AS short FROM img",
)
def p16_short_ids(spark: SparkSession, root: str) -> DataFrame:
    images = eventlog.images(eventlog.load_log(spark, root))
    return images.select("id", tx.short_id(F.col("s3_url"), 8).alias("short"))


@register(
    "p17_active_images",
    f"""{MODEL_SQL} SELECT id, CAST(count(*) AS INTEGER) AS views FROM img
    JOIN eng ON eng.image_id = img.id AND event_type = 'view' GROUP BY id""",
)
def p17_active_images(spark: SparkSession, root: str) -> DataFrame:
    return _with_views(eventlog.load_log(spark, root)).where("views > 0").select("id", "views")


def _with_views(log: DataFrame) -> DataFrame:
    accepted = eventlog.engagement(log).where(F.col("event_type") == "view")
    images = eventlog.images(log).withColumn("views", F.lit(0))
    return win.with_view_counter(images, accepted)


@register(
    "p18_progress_rows",
    f"""{MODEL_SQL} SELECT image_id, event_id, total FROM (
      SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY us, n) AS total
      FROM byuser WHERE event_type = 'view') WHERE total % 10 = 0 OR total IN (5, 10, 20)""",
)
def p18_progress_rows(spark: SparkSession, root: str) -> DataFrame:
    totals = win.running_total(eventlog.by_user(eventlog.load_log(spark, root)))
    return win.progress_rows(totals, ALERT).select("image_id", "event_id", "total")


# ------------------------------------------------------------------------ aggregations


@register(
    "a1_tumbling_counts",
    f"""{MODEL_SQL}, {WINDOWS_SQL}
    SELECT image_id, event_type, window_start, window_end, event_count FROM windows""",
)
def a1_tumbling_counts(spark: SparkSession, root: str) -> DataFrame:
    return ntz(windows(eventlog.load_log(spark, root)))


@register(
    "a1_hourly_windows",
    f"""{MESSAGE_SQL} SELECT image_id, event_type, make_timestamp(us - us % {BUCKET}) AS window_start,
    make_timestamp(us - us % {BUCKET} + {BUCKET}) AS window_end, count(*) AS event_count
    FROM checked WHERE reject_reason IS NULL AND event_type <> 'upload' AND {RANGE_SQL}
    GROUP BY image_id, event_type, us - us % {BUCKET}""",
)
def a1_hourly_windows(spark: SparkSession, root: str) -> DataFrame:
    raw = messages(eventlog.load_log(spark, root))
    return ntz(hourly.hourly_windows(raw, START, END, TRAIN))


@register(
    "a2_totals",
    f"""{MODEL_SQL} SELECT image_id, count(*) FILTER (WHERE event_type = 'view') AS total_views,
    count(*) FILTER (WHERE event_type = 'comment') AS total_comments,
    count(*) FILTER (WHERE event_type = 'flag') AS total_flags FROM eng GROUP BY image_id""",
)
def a2_totals(spark: SparkSession, root: str) -> DataFrame:
    return win.totals(eventlog.engagement(eventlog.load_log(spark, root)))


@register(
    "a3_view_counter",
    f"""{MODEL_SQL} SELECT id, CAST((SELECT count(*) FROM eng WHERE eng.image_id = img.id
    AND event_type = 'view') AS INTEGER) AS views FROM img""",
)
def a3_view_counter(spark: SparkSession, root: str) -> DataFrame:
    return _with_views(eventlog.load_log(spark, root)).select("id", "views")


@register(
    "a7_label_counts",
    f"""{TRAINING_SQL} SELECT label_needs_moderation_24h, count(*) AS n FROM training
    GROUP BY label_needs_moderation_24h""",
)
def a7_label_counts(spark: SparkSession, root: str) -> DataFrame:
    return q.value_counts(training(spark, root))


@register(
    "a9_milestone_distribution",
    f"{ALERT_SQL} SELECT milestone_value, count(*) AS n FROM milestone GROUP BY milestone_value",
)
def a9_milestone_distribution(spark: SparkSession, root: str) -> DataFrame:
    return q.milestone_distribution(milestones(eventlog.load_log(spark, root)))


@register(
    "a10_duplicates",
    f"""{MODEL_SQL} SELECT user_id, event_type, count(*) AS n FROM eng
    GROUP BY user_id, event_type HAVING count(*) > 1""",
)
def a10_duplicates(spark: SparkSession, root: str) -> DataFrame:
    events = eventlog.engagement(eventlog.load_log(spark, root))
    return q.duplicates(events, ["user_id", "event_type"])


_TWICE_SQL = """SELECT * FROM milestone UNION ALL
      SELECT * FROM milestone WHERE CAST(image_id AS BIGINT) % 2 = 0"""


@register(
    "a10_duplicate_milestones",
    f"""{ALERT_SQL}, twice AS ({_TWICE_SQL})
    SELECT 'image, type, value' AS checked, image_id, milestone_type, milestone_value, count(*) AS n
    FROM twice GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT 'image, value', image_id, NULL, milestone_value, count(*) FROM twice
    GROUP BY ALL HAVING count(*) > 1""",
)
def a10_duplicate_milestones(spark: SparkSession, root: str) -> DataFrame:
    """Milestones of every second image stored twice, by both keys that are looked at."""
    reached = milestones(eventlog.load_log(spark, root))
    twice = reached.unionByName(reached.where(F.col("image_id").cast("long") % 2 == 0))
    full, short = ["image_id", "milestone_type", "milestone_value"], ["image_id", "milestone_value"]
    found = [
        q.duplicates(twice, key).withColumn("checked", F.lit(name))
        for name, key in (("image, type, value", full), ("image, value", short))
    ]
    return ing.union_topics(*found).select("checked", *full, "n")


@register(
    "a17_schema_check",
    """SELECT * FROM (VALUES ('category', 'missing'), ('views_5min', 'missing'), ('views_1min', 'forbidden'))
    AS t(column_name, problem) WHERE (SELECT count(*) FROM events) > 0""",
)
def a17_schema_check(spark: SparkSession, root: str) -> DataFrame:
    """A training table that lacks two columns and has one it must not have."""
    table = training(spark, root).drop("category").withColumnRenamed("views_5min", "views_1min")
    return spark.createDataFrame(q.schema_problems(table), "column_name string, problem string")


@register(
    "a20_table_exists",
    """SELECT * FROM (VALUES ('images', true), ('no_such_table', false)) AS t(table_name, present)
    WHERE (SELECT count(*) FROM events) > 0""",
)
def a20_table_exists(spark: SparkSession, root: str) -> DataFrame:
    lake = _lake(spark)
    writers.replace_table(eventlog.images(eventlog.load_log(spark, root)), f"{lake}.images")
    found = [(name, q.table_exists(spark, f"{lake}.{name}")) for name in ("images", "no_such_table")]
    return spark.createDataFrame(found, "table_name string, present boolean")


@register(
    "a11_rows_per_image",
    f"{MODEL_SQL} SELECT image_id, count(*) AS n FROM eng GROUP BY image_id",
)
def a11_rows_per_image(spark: SparkSession, root: str) -> DataFrame:
    return q.rows_per_image(eventlog.engagement(eventlog.load_log(spark, root)))


_LATENCY_SQL = """
    SELECT round(avg({c}), 6) AS mean_ms, min({c}) AS min_ms, max({c}) AS max_ms,
    round(quantile_cont({c}, 0.5), 6) AS p50_ms, round(quantile_cont({c}, 0.95), 6) AS p95_ms,
    round(quantile_cont({c}, 0.99), 6) AS p99_ms, quantile_cont({c}, 0.99) < 50 AS meets_target FROM {t}"""


def _rounded(df: DataFrame) -> DataFrame:
    names = ("mean_ms", "p50_ms", "p95_ms", "p99_ms")
    return df.withColumns({c: F.round(c, 6) for c in names})


@register("a12_latency_summary", _LATENCY_SQL.format(c="value", t="events"))
def a12_latency_summary(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(q.latency_summary(eventlog.load_log(spark, root), "value"))


@register("a12_price_summary", _LATENCY_SQL.format(c="l_extendedprice", t="lineitem"))
def a12_price_summary(spark: SparkSession, root: str) -> DataFrame:
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    return _rounded(q.latency_summary(lines, "l_extendedprice"))


@register(
    "a13_topic_counts",
    f"""{MESSAGE_SQL} SELECT event_type || 's' AS topic, count(*) AS n FROM message GROUP BY 1
    UNION ALL SELECT 'all', count(*) FROM message""",
)
def a13_topic_counts(spark: SparkSession, root: str) -> DataFrame:
    return q.topic_counts(messages(eventlog.load_log(spark, root)))


@register(
    "a14_alert_statistics",
    f"""{ALERT_SQL} SELECT alert_type, count(*) AS n FROM alert GROUP BY alert_type
    UNION ALL SELECT 'milestone', count(*) FROM milestone""",
)
def a14_alert_statistics(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return al.alert_statistics(alerts(log), milestones(log))


@register(
    "a15_run_metrics",
    f"""{MESSAGE_SQL}, inside AS (SELECT * FROM checked WHERE reject_reason IS NULL
      AND event_type <> 'upload' AND {RANGE_SQL})
    SELECT 'events_read' AS metric, count(*) AS n FROM checked
    UNION ALL SELECT 'events_in_range', count(*) FROM inside
    UNION ALL SELECT 'events_skipped', count(*) FROM checked WHERE reject_reason IS NOT NULL
    UNION ALL SELECT event_type || '_windows', count(DISTINCT (image_id, us - us % {BUCKET}))
    FROM inside GROUP BY event_type""",
)
def a15_run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Observed while the windows are made."""
    raw = messages(eventlog.load_log(spark, root))
    return hourly.aggregate_range(raw, START, END, TRAIN)[1]


@register(
    "a1_hourly_job",
    f"""{MESSAGE_SQL} SELECT event_type, image_id, make_timestamp(us - us % {BUCKET}) AS window_start,
    make_timestamp(us - us % {BUCKET} + {BUCKET}) AS window_end, count(*) AS event_count
    FROM checked WHERE reject_reason IS NULL AND event_type <> 'upload' AND {RANGE_SQL}
    GROUP BY event_type, image_id, us - us % {BUCKET}""",
)
def a1_hourly_job(spark: SparkSession, root: str) -> DataFrame:
    """The hourly job over one range, twice: the three tables hold one copy."""
    raw, lake = messages(eventlog.load_log(spark, root)), _lake(spark)
    for _ in range(2):
        hourly.run_hourly(raw, START, END, lake, TRAIN)
    minutes = TRAIN.bucket_seconds // 60
    tables = [
        readers.scan_table(spark, f"{lake}.{kind}_windows_{minutes}min").withColumn("event_type", F.lit(kind))
        for kind in win.COUNTED
    ]
    columns = ("event_type", "image_id", "window_start", "window_end", "event_count")
    return ntz(ing.union_topics(*tables).select(*columns))


@register(
    "a16_reconcile",
    f"""{MODEL_SQL}, raw AS (SELECT image_id, event_type, count(*) AS raw,
      count(*) FILTER (WHERE k <> 5) AS windowed FROM eng GROUP BY image_id, event_type)
    SELECT image_id, event_type, windowed, raw FROM raw WHERE raw <> windowed""",
)
def a16_reconcile(spark: SparkSession, root: str) -> DataFrame:
    """Window counts that miss some events, against the raw events."""
    events = eventlog.engagement(eventlog.load_log(spark, root))
    partial = win.tumbling_counts(events.where(F.col("k") != 5), TRAIN)
    return q.reconcile(partial, events)


# --------------------------------------------------------------------- rolling windows


@register(
    "w1_rolling_views",
    f"""{ROLLING_SQL} SELECT image_id, event_id, ts, views_1min, views_5min, views_1hr
    FROM rolling WHERE event_type = 'view'""",
)
def w1_rolling_views(spark: SparkSession, root: str) -> DataFrame:
    rows = rolling(eventlog.load_log(spark, root)).where(F.col("event_type") == "view")
    return ntz(
        rows.select("image_id", "event_id", "ts", "views_1min", "views_5min", "views_1hr")
    )


@register(
    "w2_rolling_comments",
    f"""{ROLLING_SQL} SELECT image_id, event_id, ts, comments_1min, comments_5min, comments_1hr
    FROM rolling WHERE event_type = 'comment'""",
)
def w2_rolling_comments(spark: SparkSession, root: str) -> DataFrame:
    """Half of the comments are delivered twice; the windows count them once."""
    events = eventlog.by_user(eventlog.load_log(spark, root))
    again = events.where(
        (F.col("event_type") == "comment") & (F.col("event_id").cast("long") % 2 == 0)
    )
    rows = win.rolling_counts(events.unionByName(again), ALERT)
    return ntz(
        rows.where(F.col("event_type") == "comment").select(
            "image_id", "event_id", "ts", "comments_1min", "comments_5min", "comments_1hr"
        )
    )


@register(
    "w3_views_at_comments",
    f"""{ROLLING_SQL} SELECT image_id, event_id, views_1min, views_5min, views_1hr, total_views
    FROM rolling WHERE event_type = 'comment'""",
)
def w3_views_at_comments(spark: SparkSession, root: str) -> DataFrame:
    rows = rolling(eventlog.load_log(spark, root)).where(F.col("event_type") == "comment")
    return rows.select(
        "image_id", "event_id", "views_1min", "views_5min", "views_1hr", "total_views"
    )


@register(
    "w4_running_totals",
    f"""{MODEL_SQL} SELECT image_id, event_id,
    row_number() OVER (PARTITION BY image_id ORDER BY us, n) AS total FROM byuser WHERE event_type = 'view'""",
)
def w4_running_totals(spark: SparkSession, root: str) -> DataFrame:
    return win.running_total(eventlog.by_user(eventlog.load_log(spark, root))).select(
        "image_id", "event_id", "total"
    )


@register(
    "w5_milestones",
    f"{ALERT_SQL} SELECT image_id, milestone_type, milestone_value, reached_at FROM milestone",
)
def w5_milestones(spark: SparkSession, root: str) -> DataFrame:
    return ntz(milestones(eventlog.load_log(spark, root)))


@register(
    "w6_first_alerts",
    f"{ALERT_SQL} SELECT image_id, alert_type, alert_ts, observed, threshold FROM alert",
)
def w6_first_alerts(spark: SparkSession, root: str) -> DataFrame:
    return ntz(alerts(eventlog.load_log(spark, root)))


@register(
    "t6_moderation_requests",
    f"""{ALERT_SQL} SELECT image_id, alert_type AS "trigger", observed AS context_count,
    epoch_us(alert_ts) / CAST(1000000 AS DOUBLE) AS "timestamp"
    FROM alert WHERE alert_type IN ('viral', 'suspicious')""",
)
def t6_moderation_requests(spark: SparkSession, root: str) -> DataFrame:
    requests = al.moderation_requests(alerts(eventlog.load_log(spark, root)))
    return requests.select(
        "image_id",
        "trigger",
        F.map_values("context")[0].alias("context_count"),
        "timestamp",
    )


@register(
    "w8_latest_metadata",
    f"""{MODEL_SQL} SELECT user_id AS image_id, id AS event_id, coalesce(category, 'unknown') AS category,
    uploaded_at AS ts FROM img QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY up DESC) = 1""",
)
def w8_latest_metadata(spark: SparkSession, root: str) -> DataFrame:
    uploads = upload_rows(eventlog.load_log(spark, root)).withColumn(
        "image_id", F.col("user_id")
    )
    return ntz(
        win.latest_metadata(uploads).select("image_id", "event_id", "category", "ts")
    )


_AS_OF_US = "epoch_us(TIMESTAMP '2024-01-20')"


@register(
    "w9_counts_at_instant",
    f"""{MODEL_SQL} SELECT image_id, {", ".join(
        f"count(*) FILTER (WHERE event_type = '{kind}' AND us <= {_AS_OF_US} "
        f"AND us >= {_AS_OF_US} - {seconds * US}) AS {kind}s_{size}"
        for kind in ("view", "comment") for size, seconds in ALERT.rolling)}
    FROM byuser GROUP BY image_id""",
)
def w9_counts_at_instant(spark: SparkSession, root: str) -> DataFrame:
    return win.window_counts(eventlog.by_user(eventlog.load_log(spark, root)), AS_OF, ALERT)


# ---------------------------------------------------------------- sorts, limits, unions


@register(
    "o1_latest_orders",
    """SELECT o_orderkey AS id, o_orderdate AS created_at FROM orders
    ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 10""",
)
def o1_latest_orders(spark: SparkSession, root: str) -> DataFrame:
    orders = spark.read.parquet(f"{root}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("created_at"),
    )
    return q.latest_decisions(orders).withColumn("id", F.col("id").cast("long"))


@register(
    "o2_most_recent_active",
    f"""{MODEL_SQL} SELECT id, uploaded_at FROM img
    WHERE EXISTS (SELECT 1 FROM eng WHERE eng.image_id = img.id AND event_type = 'view')
    ORDER BY uploaded_at DESC, id LIMIT 1""",
)
def o2_most_recent_active(spark: SparkSession, root: str) -> DataFrame:
    images = _with_views(eventlog.load_log(spark, root))
    return ntz(q.most_recent_active(images).select("id", "uploaded_at"))


@register(
    "o3_milestone_timeline",
    f"""{ALERT_SQL} SELECT image_id, milestone_type, milestone_value, reached_at FROM milestone
    ORDER BY reached_at, image_id, milestone_value""",
)
def o3_milestone_timeline(spark: SparkSession, root: str) -> DataFrame:
    return ntz(q.milestone_timeline(milestones(eventlog.load_log(spark, root))))


@register(
    "o4_recent_milestones",
    f"""{ALERT_SQL} SELECT substring(image_id, 1, 16) AS image_id, milestone_type, milestone_value, reached_at
    FROM milestone ORDER BY reached_at DESC, image_id, milestone_value LIMIT 10""",
)
def o4_recent_milestones(spark: SparkSession, root: str) -> DataFrame:
    return ntz(q.recent_milestones(milestones(eventlog.load_log(spark, root))))


@register(
    "o5_random_image",
    f"""{MODEL_SQL} SELECT id, user_id, 'store/' || id AS s3_url, caption, category, uploaded_at FROM img
    ORDER BY md5(id || ':42'), id LIMIT 1""",
)
def o5_random_image(spark: SparkSession, root: str) -> DataFrame:
    return ntz(q.random_image(eventlog.images(eventlog.load_log(spark, root))))


@register(
    "o7_table_report",
    "SELECT event_id, ts, user_id, event_type FROM events ORDER BY event_id LIMIT 5",
)
def o7_table_report(spark: SparkSession, root: str) -> DataFrame:
    events = spark.read.parquet(f"{root}/events.parquet")
    return q.table_report(
        events.select("event_id", "ts", "user_id", "event_type"), ["event_id"]
    )


@register(
    "o7_table_schema",
    """SELECT position, column_name, data_type, n_rows FROM (VALUES (1, 'event_id', 'bigint'),
      (2, 'ts', 'timestamp_ntz'), (3, 'user_id', 'bigint'), (4, 'event_type', 'string')) AS t(position, column_name, data_type),
      (SELECT count(*) AS n_rows FROM events)""",
)
def o7_table_schema(spark: SparkSession, root: str) -> DataFrame:
    events = spark.read.parquet(f"{root}/events.parquet")
    return q.table_schema(events.select("event_id", "ts", "user_id", "event_type"))


@register(
    "u1_union_topics",
    f"""{MODEL_SQL} SELECT event_id, event_type, image_id, CASE WHEN event_type = 'view' THEN ts END AS viewed_at,
    CASE WHEN event_type = 'comment' THEN user_id END AS user_id FROM eng
    WHERE event_type IN ('view', 'comment')""",
)
def u1_union_topics(spark: SparkSession, root: str) -> DataFrame:
    events = eventlog.engagement(eventlog.load_log(spark, root))
    base = ("event_id", "event_type", "image_id")
    return ntz(
        ing.union_topics(
            ing.route(events, "view").select(*base, F.col("ts").alias("viewed_at")),
            ing.route(events, "comment").select(*base, "user_id"),
        )
    )


# ---------------------------------------------------------------------- text and times


@register(
    "f25_floor_five_minutes",
    f"{MODEL_SQL} SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket FROM log",
)
def f25_floor_five_minutes(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return ntz(log.select("event_id", floor_to(F.col("ts"), 300).alias("bucket")))


@register(
    "f26_object_urls",
    f"""{MODEL_SQL} SELECT id, 'http://store/images/' || id || '.' || CASE WHEN k % 2 = 0 THEN 'jpg' ELSE 'tar.gz'[5:] END
    AS url FROM img""",
)
def f26_object_urls(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root).where(F.col("event_type") == "signup")
    name = F.when(F.col("k") % 2 == 0, "photo.jpg").otherwise("photo.tar.gz")
    url = tx.object_url(
        F.lit("http://store"), F.lit("images"), tx.object_key(F.col("event_id"), name)
    )
    return log.select(F.col("event_id").alias("id"), url.alias("url"))


@register(
    "f27_display_ids",
    f"""{MODEL_SQL} SELECT event_id, substring(coalesce(image_id,
      CASE WHEN event_type = 'comment' THEN 'comment-' || event_id END,
      CASE WHEN event_type = 'flag' THEN 'flag-' || event_id END, 'N/A'), 1, 8) AS display FROM facts""",
)
def f27_display_ids(spark: SparkSession, root: str) -> DataFrame:
    events = eventlog.attributed(eventlog.load_log(spark, root))
    kind = F.col("event_type")
    return events.select(
        "event_id",
        tx.display_id(
            F.col("image_id"),
            F.when(kind == "comment", F.concat(F.lit("comment-"), F.col("event_id"))),
            F.when(kind == "flag", F.concat(F.lit("flag-"), F.col("event_id"))),
        ).alias("display"),
    )
