"""Registered queries: joins, features, scoring, decisions, the model."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.config import (
    CATEGORIES,
    CATEGORY_COLUMNS,
    FEATURES,
    SCALAR_FEATURES,
)
from flagstone.functions import features as fx
from flagstone.functions.scoring import (
    explanation,
    ranked_factors,
    recommendation,
    score_heuristic,
)
from flagstone.functions.times import after
from flagstone.operators import alerts as al
from flagstone.operators import quality as q
from flagstone.operators import windows as win
from flagstone.operators.skew import skew_join
from flagstone.plans import daily, model, serving
from flagstone.plans import training_table as tt
from flagstone.plans.queries_events import upload_rows
from flagstone.plans.registry import (
    ALERT_SQL,
    AS_OF,
    MODEL_SQL,
    ROLLING_SQL,
    TRAIN,
    TRAINING_SQL,
    US,
    US_SQL,
    flagged,
    flags,
    milestones,
    ntz,
    register,
    rolling,
    training,
    training_table,
    windows,
)
from flagstone.schemas import TRAINING
from flagstone.sources import eventlog, readers, writers
from flagstone.sources.scratch import scratch_dir, staged

POINTS_SQL = ", ".join(f"({m})" for m in TRAIN.decision_points)


# ------------------------------------------------------------------------------- joins


@register(
    "j1_images_with_users",
    f"""{MODEL_SQL} SELECT i.id, i.user_id, u.created_at AS user_created_at FROM img i
    JOIN usr u ON u.id = i.user_id WHERE CAST(u.id AS INTEGER) % 7 <> 0""",
)
def j1_images_with_users(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    users = eventlog.users(log).where(F.col("id").cast("int") % 7 != 0)
    joined = tt.with_users(eventlog.images(log), users, TRAIN)
    return ntz(joined.select("id", "user_id", "user_created_at"))


@register(
    "j2_decision_rows",
    f"""{MODEL_SQL} SELECT id, CAST(m AS INTEGER) AS decision_point_minutes, up + m * 60 * {US_SQL} AS cutoff_us
    FROM img, (VALUES {POINTS_SQL}) AS p(m)""",
)
def j2_decision_rows(spark: SparkSession, root: str) -> DataFrame:
    images = eventlog.images(eventlog.load_log(spark, root))
    return tt.decision_rows(images, TRAIN).select(
        "id", "decision_point_minutes", "cutoff_us"
    )


@register(
    "j3_window_sums",
    f"""{TRAINING_SQL} SELECT id AS image_id, CAST(m AS INTEGER) AS decision_point_minutes,
    views_5min, views_1hr, comments_5min, comments_1hr FROM sums
    WHERE id IN (SELECT p.id FROM points p JOIN windows w ON w.image_id = p.id
      AND w.event_type IN ('view', 'comment') AND w.ws >= p.up
      AND w.we <= p.up + {max(TRAIN.decision_points)} * 60 * {US_SQL})""",
)
def j3_window_sums(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    sums = tt.window_sums(eventlog.images(log), windows(log), TRAIN)
    names = ("views_5min", "views_1hr", "comments_5min", "comments_1hr")
    points = F.array(*[F.lit(m) for m in TRAIN.decision_points])
    return sums.select(
        "image_id",
        F.inline(F.arrays_zip(points.alias("decision_point_minutes"), *names)),
    ).toDF("image_id", "decision_point_minutes", *names)


@register("j4_labels", f"{TRAINING_SQL} SELECT id AS image_id FROM flagged")
def j4_labels(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return tt.labels(eventlog.images(log), flags(log), TRAIN)


MILESTONE_FEATURES_SQL = f"""{MODEL_SQL}, m1 AS (
  SELECT image_id, ts AS reached_at, us AS reached_us, rn AS milestone_value FROM (
    SELECT image_id, ts, us, row_number() OVER (PARTITION BY image_id ORDER BY us, n) AS rn
    FROM eng WHERE event_type = 'view') WHERE rn IN (1, 2, 3)),
p AS (SELECT id, up, m, up + m * 60 * {US_SQL} AS cutoff FROM img, (VALUES {POINTS_SQL}) AS v(m)),
long AS (
  SELECT p.id, p.m,
    (SELECT count(*) FROM eng c WHERE c.event_type = 'comment' AND c.image_id = p.id
       AND c.us >= p.up AND c.us <= p.cutoff) AS comments_1hr,
    coalesce((SELECT max(milestone_value) FROM m1 WHERE m1.image_id = p.id AND reached_us <= p.cutoff), 0)
      AS views_1hr
  FROM p)
SELECT id, CAST(m AS INTEGER) AS decision_point_minutes, views_1hr, comments_1hr,
  CASE WHEN m >= 360 THEN CAST(trunc(views_1hr / greatest(m / CAST(360 AS DOUBLE), 1)) AS BIGINT) ELSE views_1hr END AS views_5min,
  CASE WHEN m >= 360 THEN CAST(trunc(comments_1hr / greatest(m / CAST(360 AS DOUBLE), 1)) AS BIGINT) ELSE comments_1hr END AS comments_5min
FROM long"""


@register("j5_milestone_features", MILESTONE_FEATURES_SQL)
def j5_milestone_features(spark: SparkSession, root: str) -> DataFrame:
    """Comment interval counts, as-of milestones and the short-window estimates."""
    log = eventlog.load_log(spark, root)
    events = eventlog.engagement(log)
    steps = replace(TRAIN, milestones=(1, 2, 3))
    reached = al.milestone_crossings(events.where(F.col("event_type") == "view"), steps)
    comments = events.where(F.col("event_type") == "comment").select(
        "image_id", F.col("ts").alias("created_at")
    )
    rows = tt.decision_rows(eventlog.images(log), TRAIN)
    return tt.milestone_features(rows, comments, reached, TRAIN).select(
        "id",
        "decision_point_minutes",
        "views_1hr",
        "comments_1hr",
        "views_5min",
        "comments_5min",
    )


@register(
    "j6_latest_upload_as_of",
    f"""{MODEL_SQL} SELECT event_id, event_type, image_id FROM facts""",
)
def j6_latest_upload_as_of(spark: SparkSession, root: str) -> DataFrame:
    """As-of join: each event with its user's latest upload."""
    return eventlog.attributed(eventlog.load_log(spark, root)).select(
        "event_id", "event_type", "image_id"
    )


@register(
    "j7_user_image_counts",
    f"""{TRAINING_SQL} SELECT id, CAST(m AS INTEGER) AS decision_point_minutes, user_image_count FROM user_asof""",
)
def j7_user_image_counts(spark: SparkSession, root: str) -> DataFrame:
    images = eventlog.images(eventlog.load_log(spark, root))
    return tt.user_image_counts(images, TRAIN).select(
        "id", "decision_point_minutes", "user_image_count"
    )


@register(
    "j8_image_metadata",
    f"""{MODEL_SQL} SELECT i.id AS image_id, coalesce(i.category, 'Unknown') AS category, i.uploaded_at,
    u.created_at AS user_created_at,
    (SELECT count(*) FROM img o WHERE o.user_id = i.user_id) AS user_image_count
    FROM img i JOIN usr u ON u.id = i.user_id""",
)
def j8_image_metadata(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    meta = serving.image_metadata(eventlog.images(log), eventlog.users(log))
    return ntz(
        meta.select(
            "image_id", "category", "uploaded_at", "user_created_at", "user_image_count"
        )
    )


@register(
    "j11_merge_features",
    f"""{MODEL_SQL}, online AS (SELECT image_id, 'online' AS category, count(*) AS total FROM eng
      WHERE event_type = 'view' GROUP BY image_id)
    SELECT coalesce(i.id, o.image_id) AS image_id, coalesce(i.category, o.category) AS category, total,
      i.user_id FROM online o FULL JOIN (SELECT * FROM img WHERE k % 3 <> 0) i ON i.id = o.image_id""",
)
def j11_merge_features(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    views = eventlog.engagement(log).where(F.col("event_type") == "view")
    online = views.groupBy("image_id").agg(F.count("*").alias("total"))
    meta = eventlog.images(log.where(F.col("k") % 3 != 0)).select(
        F.col("id").alias("image_id"), "category", "user_id"
    )
    return serving.merge_features(
        online.withColumn("category", F.lit("online")), meta
    ).select("image_id", "category", "total", "user_id")


@register(
    "j12_new_milestones",
    f"""{ALERT_SQL} SELECT image_id, milestone_value, reached_at FROM milestone WHERE milestone_value <> 5""",
)
def j12_new_milestones(spark: SparkSession, root: str) -> DataFrame:
    reached = milestones(eventlog.load_log(spark, root))
    key = ("image_id", "milestone_type", "milestone_value")
    old = reached.where(F.col("milestone_value") == 5)
    fresh = writers.new_rows(reached, old, key, ("reached_at",))
    return ntz(fresh.select("image_id", "milestone_value", "reached_at"))


@register(
    "j1_lines_with_parts",
    """SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE p_size > 10""",
)
def j1_lines_with_parts(spark: SparkSession, root: str) -> DataFrame:
    """The skew-safe join at volume."""
    lines = spark.read.parquet(f"{root}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )
    parts = (
        spark.read.parquet(f"{root}/part.parquet")
        .where(F.col("p_size") > 10)
        .select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    )
    return skew_join(lines, parts, ["l_partkey"]).select(
        "l_orderkey", "l_linenumber", "p_brand"
    )


# ----------------------------------------------------------------------- training table


@register(
    "training_features",
    f"{TRAINING_SQL} SELECT {', '.join(TRAINING.names)} FROM training",
)
def training_features(spark: SparkSession, root: str) -> DataFrame:
    return training(spark, root)


@register(
    "training_features_mature",
    f"""{TRAINING_SQL} SELECT {', '.join('t.' + c for c in TRAINING.names)} FROM training t
    JOIN img ON img.id = t.image_id
    WHERE img.uploaded_at + INTERVAL 24 HOUR <= TIMESTAMP '2024-01-20'""",
)
def training_features_mature(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return training_table(log, mature_at=F.lit(AS_OF))


DAYS = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (8, 14, 19)]


@register(
    "training_daily_job",
    f"""{TRAINING_SQL} SELECT {', '.join('t.' + c for c in TRAINING.names)} FROM training t
    JOIN img ON img.id = t.image_id
    WHERE img.uploaded_at >= TIMESTAMP '2024-01-08' AND img.uploaded_at < TIMESTAMP '2024-01-19'""",
)
def training_daily_job(spark: SparkSession, root: str) -> DataFrame:
    """The daily job over overlapping ranges of days: every row once, history outside not read."""
    log = eventlog.load_log(spark, root)
    events = staged(eventlog.engagement(log), "engagement")
    name = "daily_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'daily')}'")
    first, middle, last = DAYS
    for start, end in ((first, middle), (first, last), (middle, last)):
        daily.run_daily(
            eventlog.users(log),
            eventlog.images(log),
            flagged(events),
            win.tumbling_counts(events, TRAIN),
            start,
            end,
            f"{name}.training",
            TRAIN,
        )
    return spark.table(f"{name}.training").select(*TRAINING.names)


@register(
    "a18_leakage_found",
    f"""{TRAINING_SQL} SELECT image_id FROM training WHERE decision_point_minutes = 0 AND user_image_count % 2 = 0""",
)
def a18_leakage_found(spark: SparkSession, root: str) -> DataFrame:
    """Views slipped into every second count of images, at all decision points."""
    leaky = F.when(F.col("user_image_count") % 2 == 0, F.col("views_1hr") + 1).otherwise(F.col("views_1hr"))
    return q.leakage(training(spark, root).withColumn("views_1hr", leaky)).select("image_id")


@register(
    "a18_leakage",
    f"""{TRAINING_SQL} SELECT image_id FROM training WHERE decision_point_minutes = 0
    AND views_5min + views_1hr + comments_5min + comments_1hr > 0""",
)
def a18_leakage(spark: SparkSession, root: str) -> DataFrame:
    return q.leakage(training(spark, root)).select("image_id")


@register(
    "a19_inconsistent_features",
    f"""{TRAINING_SQL} SELECT image_id, decision_point_minutes FROM training
    WHERE category = 'Rice'""",
)
def a19_inconsistent_features(spark: SparkSession, root: str) -> DataFrame:
    """A training table in which one category's velocity was shifted."""
    shifted = training(spark, root).withColumn(
        "view_velocity_per_min",
        F.col("view_velocity_per_min")
        + F.when(F.col("category") == "Rice", 0.5).otherwise(0.0),
    )
    return q.inconsistent_features(shifted, TRAIN).select(
        "image_id", "decision_point_minutes"
    )


# ------------------------------------------------------------------------------ features


@register(
    "f2_time_features",
    f"""{MODEL_SQL} SELECT img.id, CAST(hour(uploaded_at) AS INTEGER) AS hour_of_day,
    CAST(isodow(uploaded_at) - 1 AS INTEGER) AS day_of_week,
    CAST(isodow(uploaded_at) >= 6 AS INTEGER) AS is_weekend,
    CAST(trunc(({US_SQL} * 60 * 37 + up - created_us) / CAST({US_SQL} AS DOUBLE)) AS BIGINT) AS seconds,
    CAST(trunc((created_us - up) / CAST(86400 * {US_SQL} AS DOUBLE)) AS INTEGER) AS days_back
    FROM img JOIN usr ON usr.id = img.user_id""",
)
def f2_time_features(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    rows = tt.with_users(eventlog.images(log), eventlog.users(log))
    up, born = F.col("uploaded_at"), F.col("user_created_at")
    return rows.select(
        "id",
        fx.hour_of_day(up).alias("hour_of_day"),
        fx.day_of_week(up).alias("day_of_week"),
        fx.is_weekend(up).alias("is_weekend"),
        fx.seconds_between(born, after(up, 37 * 60)).alias("seconds"),
        fx.days_between(up, born).alias("days_back"),
    )


@register(
    "f6_derived_features",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) / CAST(5 AS DOUBLE) AS view_velocity_per_min,
    CAST(l_linenumber AS BIGINT) / CAST(greatest(CAST(l_quantity AS BIGINT) - 20, 1) AS DOUBLE) AS comment_to_view_ratio,
    CAST(CAST(l_quantity AS BIGINT) + 5 * l_linenumber AS DOUBLE) AS recent_engagement_score FROM lineitem""",
)
def f6_derived_features(spark: SparkSession, root: str) -> DataFrame:
    """Velocity, ratio and engagement at volume, with the default settings."""
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    quantity = F.col("l_quantity").cast("long")
    counts = lines.select(
        "l_orderkey",
        "l_linenumber",
        quantity.alias("views_5min"),
        (quantity - 20).alias("views_1hr"),
        F.col("l_linenumber").cast("long").alias("comments_5min"),
        F.col("l_linenumber").cast("long").alias("comments_1hr"),
    )
    return fx.add_derived(counts).select(
        "l_orderkey",
        "l_linenumber",
        "view_velocity_per_min",
        "comment_to_view_ratio",
        "recent_engagement_score",
    )


@register(
    "f9_caption_features",
    """SELECT doc_id, CAST(length(coalesce(text, '')) AS INTEGER) AS caption_length,
    CAST(length(coalesce(text, '')) > 0 AS INTEGER) AS has_caption FROM documents""",
)
def f9_caption_features(spark: SparkSession, root: str) -> DataFrame:
    """Code-point lengths over whole multi-byte texts."""
    docs = spark.read.parquet(f"{root}/documents.parquet")
    return docs.select(
        "doc_id",
        fx.caption_length(F.col("text")).alias("caption_length"),
        fx.has_caption(F.col("text")).alias("has_caption"),
    )


@register(
    "f12_category_flags",
    f"""{MODEL_SQL} SELECT id, {", ".join(
        f"CAST(coalesce(category = '{v}', false) AS INTEGER) AS {c.replace('/', '_')}"
        for v, c in zip(CATEGORIES, CATEGORY_COLUMNS))} FROM img""",
)
def f12_category_flags(spark: SparkSession, root: str) -> DataFrame:
    images = eventlog.images(eventlog.load_log(spark, root))
    padded = F.concat(F.lit(" "), F.col("category"), F.lit(" "))
    return images.select("id", *fx.category_flags(padded))


@register(
    "f23_category_decode",
    f"{MODEL_SQL} SELECT id, coalesce(category, 'Unknown') AS decoded FROM img",
)
def f23_category_decode(spark: SparkSession, root: str) -> DataFrame:
    images = eventlog.images(eventlog.load_log(spark, root))
    flagged = images.select("id", *fx.category_flags(F.col("category")))
    return flagged.select("id", fx.category_of().alias("decoded"))


def _sql_features(source: str) -> str:
    flags_sql = ", ".join(
        f"CAST(category = '{v}' AS DOUBLE) AS {c}"
        for v, c in zip(CATEGORIES, CATEGORY_COLUMNS)
    )
    scalars = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in SCALAR_FEATURES)
    return (
        f"vec AS (SELECT image_id, decision_point_minutes, {scalars}, {flags_sql} FROM {source})"
    )


@register(
    "f13_feature_vector",
    f"""{TRAINING_SQL}, {_sql_features("training")}
    SELECT image_id, decision_point_minutes, 26 AS size, {FEATURES[0]} AS first_value,
    {" + ".join(f"{f} * {i}" for i, f in enumerate(FEATURES, 1))} AS weighted FROM vec""",
)
def f13_feature_vector(spark: SparkSession, root: str) -> DataFrame:
    """Vector entries against the columns, through a position-weighted sum."""
    from pyspark.ml.functions import vector_to_array

    rows = fx.feature_vector(training(spark, root)).withColumn(
        "a", vector_to_array("features")
    )
    weighted = reduce(
        lambda x, y: x + y, [F.col("a")[i - 1] * i for i in range(1, len(FEATURES) + 1)]
    )
    return rows.select(
        "image_id",
        "decision_point_minutes",
        F.size("a").alias("size"),
        F.col("a")[0].alias("first_value"),
        weighted.alias("weighted"),
    )


@register(
    "f14_finite_values",
    f"""{MODEL_SQL} SELECT event_id, CASE k % 4 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN CAST(1000000 AS DOUBLE)
    WHEN 2 THEN CAST(-1000000 AS DOUBLE) ELSE value END AS clean FROM log""",
)
def f14_finite_values(spark: SparkSession, root: str) -> DataFrame:
    form = F.col("k") % 4
    raw = (
        F.when(form == 0, float("nan"))
        .when(form == 1, float("inf"))
        .when(form == 2, float("-inf"))
        .otherwise(F.col("value"))
    )
    return eventlog.load_log(spark, root).select("event_id", fx.finite(raw).alias("clean"))


@register(
    "f15_feature_map",
    f"""{TRAINING_SQL}, {_sql_features("training")}
    SELECT image_id, decision_point_minutes, {", ".join(FEATURES)} FROM vec""",
)
def f15_feature_map(spark: SparkSession, root: str) -> DataFrame:
    named = fx.feature_vector(training(spark, root)).withColumn("m", fx.feature_map())
    keys = [F.col("m")[f].alias(f) for f in FEATURES]
    return named.select("image_id", "decision_point_minutes", *keys)


def _summary_sql(compact: bool) -> str:
    lines = []
    for i, f in enumerate(FEATURES):
        shown = (
            f"CASE WHEN {f} = 1 THEN 'Yes' ELSE 'No' END"
            if f in CATEGORY_COLUMNS
            else f"CAST(CAST(trunc({f}) AS BIGINT) AS VARCHAR)"
        )
        line = f"'  [{i:2d}] {f:30s} = ' || {shown}"
        lines.append(f"CASE WHEN {f} <> 0 THEN {line} END" if compact else line)
    return "array_to_string([" + ", ".join(lines) + "], chr(10))"


@register(
    "f16_feature_summary",
    f"""{TRAINING_SQL}, {_sql_features("training")}
    SELECT image_id, decision_point_minutes, {_summary_sql(True)} AS compact, {_summary_sql(False)} AS full_text
    FROM vec""",
)
def f16_feature_summary(spark: SparkSession, root: str) -> DataFrame:
    rows = fx.feature_columns(training(spark, root))
    return rows.select(
        "image_id",
        "decision_point_minutes",
        fx.feature_summary(compact=True).alias("compact"),
        fx.feature_summary().alias("full_text"),
    )


# ------------------------------------------------------------------------------- scoring

# Rolling rows stretched so that every rule fires on some of them.
_RULES_SQL = f"""{ROLLING_SQL}, x AS (
  SELECT event_id, CAST(total_flags % 3 AS DOUBLE) AS total_flags, CAST(comments_1min * 6 AS DOUBLE) AS comments_1min,
    comments_1hr / CAST(greatest(views_1hr * 2, 1) AS DOUBLE) AS comment_to_view_ratio,
    CAST(total_comments * 5 AS DOUBLE) AS total_comments, CAST(total_views * 8 AS DOUBLE) AS total_views,
    views_5min * CAST(7.25 AS DOUBLE) AS view_velocity_per_min,
    CAST(views_5min * 30 + comments_5min * 5 AS DOUBLE) AS recent_engagement_score,
    CAST(total_views AS DOUBLE) AS user_image_count
  FROM rolling),
fired AS (SELECT *, total_flags > 0 AS r1, comments_1min > 10 AS r2, comment_to_view_ratio > 0.5 AS r3,
    total_comments > 50 AND total_views < 100 AS r4, view_velocity_per_min > 20 AS r5,
    recent_engagement_score > 100 AS r6, user_image_count > 10 AS r7 FROM x),
scored AS (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), CAST(0.3 AS DOUBLE)
    + CASE WHEN r1 THEN CAST(0.4 AS DOUBLE) ELSE 0 END + CASE WHEN r2 THEN CAST(0.3 AS DOUBLE) ELSE 0 END
    + CASE WHEN r3 THEN CAST(0.2 AS DOUBLE) ELSE 0 END + CASE WHEN r4 THEN CAST(0.3 AS DOUBLE) ELSE 0 END
    + CASE WHEN r5 THEN CAST(0.2 AS DOUBLE) ELSE 0 END + CASE WHEN r6 THEN CAST(0.15 AS DOUBLE) ELSE 0 END
    + CASE WHEN r7 THEN CAST(-0.1 AS DOUBLE) ELSE 0 END)) AS p FROM fired),
rated AS (SELECT *, CASE WHEN p < CAST(0.3 AS DOUBLE) THEN 'SAFE' WHEN p < CAST(0.7 AS DOUBLE) THEN 'REVIEW' ELSE 'FLAG' END AS rec,
    array_to_string([
      CASE WHEN r1 THEN '[HIGH RISK] Content has been flagged ' || CAST(total_flags AS BIGINT) || ' time(s)' END,
      CASE WHEN r2 THEN '[HIGH RISK] Unusual comment activity (' || CAST(comments_1min AS BIGINT) || ' comments in 1 minute)' END,
      CASE WHEN r3 THEN '[HIGH RISK] High comment-to-view ratio (' || printf('%.2f', CAST(CAST(comment_to_view_ratio AS FLOAT) AS DOUBLE)) || ')' END,
      CASE WHEN r4 THEN '[HIGH RISK] Suspicious pattern: ' || CAST(total_comments AS BIGINT) || ' comments but only ' || CAST(total_views AS BIGINT) || ' views' END,
      CASE WHEN r5 THEN '[MEDIUM RISK] Viral content (' || printf('%.1f', view_velocity_per_min) || ' views/min) - may need review' END,
      CASE WHEN r6 THEN '[MEDIUM RISK] High recent activity (score: ' || CAST(recent_engagement_score AS BIGINT) || ')' END,
      CASE WHEN r7 THEN '[LOW RISK] Established user (' || CAST(user_image_count AS BIGINT) || ' images)' END], '|') AS signals
  FROM scored),
reasoned AS (SELECT *, CASE WHEN signals <> '' THEN signals
    WHEN total_flags = 0 AND total_comments < 5 THEN '[LOW RISK] Normal activity, no flags'
    ELSE 'No significant risk signals detected' END AS reasons FROM rated)"""


def _rule_inputs(log: DataFrame) -> DataFrame:
    r = rolling(log)
    return r.select(
        "event_id",
        (F.col("total_flags") % 3).alias("total_flags"),
        (F.col("comments_1min") * 6).alias("comments_1min"),
        fx.comment_ratio(F.col("comments_1hr"), F.col("views_1hr") * 2).alias(
            "comment_to_view_ratio"
        ),
        (F.col("total_comments") * 5).alias("total_comments"),
        (F.col("total_views") * 8).alias("total_views"),
        (F.col("views_5min") * 7.25).alias("view_velocity_per_min"),
        (F.col("views_5min") * 30 + F.col("comments_5min") * 5).alias(
            "recent_engagement_score"
        ),
        F.col("total_views").alias("user_image_count"),
    )


@register(
    "h_heuristic_scores",
    f"""{_RULES_SQL} SELECT event_id, p AS moderation_probability, rec AS recommendation, reasons
    FROM reasoned JOIN (SELECT event_id FROM rolling WHERE event_type <> 'flag') USING (event_id)""",
)
def h_heuristic_scores(spark: SparkSession, root: str) -> DataFrame:
    scored = score_heuristic(_rule_inputs(eventlog.load_log(spark, root)))
    return scored.select(
        "event_id",
        "moderation_probability",
        "recommendation",
        F.array_join("reasoning", "|").alias("reasons"),
    )


# Order of the contributions by size: fixed, because the weights are.
_RANKED = (
    ("r1", "flags_reported", "0.4"),
    ("true", "base", "0.3"),
    ("r2", "comment_spam", "0.3"),
    ("r4", "bot_pattern", "0.3"),
    ("r3", "unusual_engagement", "0.2"),
    ("r5", "viral_content", "0.2"),
    ("r6", "high_activity", "0.15"),
    ("r7", "established_user", "-0.1"),
)


@register(
    "o6_ranked_factors",
    f"""{_RULES_SQL} SELECT event_id, array_to_string([{", ".join(
        f"CASE WHEN {r} THEN '{name}={weight}' END" for r, name, weight in _RANKED)}], ',') AS factors
    FROM reasoned JOIN (SELECT event_id FROM rolling WHERE event_type <> 'flag') USING (event_id)""",
)
def o6_ranked_factors(spark: SparkSession, root: str) -> DataFrame:
    scored = score_heuristic(_rule_inputs(eventlog.load_log(spark, root)))
    pairs = F.transform(
        ranked_factors(),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return scored.select("event_id", F.array_join(pairs, ",").alias("factors"))


def _explained_sql() -> str:
    bar = "=" * 70
    lines = []
    for rule, name, weight in _RANKED:
        sign = "+" if float(weight) >= 0 else ""
        lines.append(f"CASE WHEN {rule} THEN '  {name:25s}: {sign}{float(weight):+.2f}' END")
    parts = [
        f"'{bar}'",
        "'MODERATION PREDICTION'",
        f"'{bar}'",
        "'Probability: ' || printf('%.3f', p)",
        "'Recommendation: ' || rec",
        "''",
        "'Reasoning:'",
        "'  ' || replace(reasons, '|', chr(10) || '  ')",
        "''",
        "'Risk Factor Contributions:'",
        *lines,
        "''",
        "'Final Score: ' || printf('%.3f', p)",
        f"'{bar}'",
    ]
    return "array_to_string([" + ", ".join(parts) + "], chr(10))"


@register(
    "f22_explanations",
    f"""{_RULES_SQL} SELECT event_id, {_explained_sql()} AS explanation
    FROM reasoned JOIN (SELECT event_id FROM rolling WHERE event_type <> 'flag') USING (event_id)""",
)
def f22_explanations(spark: SparkSession, root: str) -> DataFrame:
    scored = score_heuristic(_rule_inputs(eventlog.load_log(spark, root)))
    return scored.select("event_id", explanation().alias("explanation"))


@register(
    "f19_recommendations",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 < CAST(0.3 AS DOUBLE) THEN 'SAFE'
    WHEN l_discount * 10 < CAST(0.7 AS DOUBLE) THEN 'REVIEW' ELSE 'FLAG' END AS recommendation FROM lineitem""",
)
def f19_recommendations(spark: SparkSession, root: str) -> DataFrame:
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        recommendation(F.col("l_discount") * 10).alias("recommendation"),
    )


# ------------------------------------------------------------------ serving and decisions


def _requests(events: DataFrame) -> DataFrame:
    """Every flag asks for a decision on its image half an hour later."""
    return events.where(F.col("event_type") == "flag").select(
        "image_id",
        "event_id",
        after(F.col("ts"), 1800).alias("ts"),
        F.lit("flagged").alias("trigger"),
    )


_COUNT_AT = (
    "(SELECT count(*) FROM eng e WHERE e.image_id = r.image_id AND e.event_type = '{kind}' "
    "AND e.us <= r.us AND e.us >= r.us - {width})"
)


def _serving_sql() -> str:
    forever = 10**17
    counts = []
    for kind in ("view", "comment"):
        for size, seconds in TRAIN.rolling:
            counts.append(
                _COUNT_AT.format(kind=kind, width=seconds * US) + f" AS {kind}s_{size}"
            )
    for kind in win.COUNTED:
        counts.append(_COUNT_AT.format(kind=kind, width=forever) + f" AS total_{kind}s")
    return f"""{MODEL_SQL}, request AS (
  SELECT image_id, event_id, us + 1800 * {US_SQL} AS us FROM eng WHERE event_type = 'flag'),
online AS (SELECT r.*, {", ".join(counts)} FROM request r),
served AS (
  SELECT o.*, coalesce(i.category, 'Unknown') AS category,
    (SELECT count(*) FROM img x WHERE x.user_id = i.user_id) AS user_image_count,
    CAST(trunc((o.us - i.up) / CAST({US_SQL} AS DOUBLE)) AS BIGINT) AS time_since_upload_seconds,
    CAST(trunc((o.us - u.created_us) / CAST(86400 * {US_SQL} AS DOUBLE)) AS INTEGER) AS user_age_days,
    CAST(length(coalesce(i.caption, '')) AS INTEGER) AS caption_length,
    views_5min / CAST({TRAIN.window_5min / 60.0} AS DOUBLE) AS view_velocity_per_min,
    comments_1hr / CAST(greatest(views_1hr, 1) AS DOUBLE) AS comment_to_view_ratio,
    CAST(views_5min + 5 * comments_5min AS DOUBLE) AS recent_engagement_score
  FROM online o JOIN img i ON i.id = o.image_id JOIN usr u ON u.id = i.user_id)"""


SERVING_SQL = _serving_sql()
_SERVED_COLUMNS = (
    "event_id",
    "image_id",
    "views_5min",
    "views_1hr",
    "comments_1min",
    "comments_5min",
    "comments_1hr",
    "total_views",
    "total_comments",
    "total_flags",
    "category",
    "user_image_count",
    "time_since_upload_seconds",
    "user_age_days",
    "caption_length",
    "view_velocity_per_min",
    "comment_to_view_ratio",
    "recent_engagement_score",
)


def _served(log: DataFrame) -> DataFrame:
    events = staged(eventlog.engagement(log), "engagement")
    return serving.serving_features(
        _requests(events),
        events,
        eventlog.images(log),
        eventlog.users(log),
        TRAIN,
    )


@register("j9_serving_features", f"{SERVING_SQL} SELECT {', '.join(_SERVED_COLUMNS)} FROM served")
def j9_serving_features(spark: SparkSession, root: str) -> DataFrame:
    return _served(eventlog.load_log(spark, root)).select(*_SERVED_COLUMNS)


@register(
    "j9_missing_requests",
    f"""{MODEL_SQL} SELECT image_id, event_id, 'Image not found' AS error FROM eng
    WHERE event_type = 'flag' AND image_id NOT IN (SELECT id FROM img WHERE k % 3 <> 0)""",
)
def j9_missing_requests(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    known = eventlog.images(log.where(F.col("k") % 3 != 0))
    requests = _requests(eventlog.engagement(log))
    return serving.missing_requests(requests, known).select(
        "image_id", "event_id", "error"
    )


_DECISION_SQL = f"""{SERVING_SQL}, decided AS (SELECT event_id, image_id, CAST(0.3 AS DOUBLE)
    + CASE WHEN total_flags > 0 THEN CAST(0.4 AS DOUBLE) ELSE 0 END
    + CASE WHEN comments_1min > 10 THEN CAST(0.3 AS DOUBLE) ELSE 0 END
    + CASE WHEN comment_to_view_ratio > 0.5 THEN CAST(0.2 AS DOUBLE) ELSE 0 END
    + CASE WHEN total_comments > 50 AND total_views < 100 THEN CAST(0.3 AS DOUBLE) ELSE 0 END
    + CASE WHEN view_velocity_per_min > 20 THEN CAST(0.2 AS DOUBLE) ELSE 0 END
    + CASE WHEN recent_engagement_score > 100 THEN CAST(0.15 AS DOUBLE) ELSE 0 END
    + CASE WHEN user_image_count > 10 THEN CAST(-0.1 AS DOUBLE) ELSE 0 END AS p FROM served),
final AS (SELECT event_id, image_id, p, CASE WHEN p < CAST(0.3 AS DOUBLE) THEN 'SAFE'
    WHEN p < CAST(0.7 AS DOUBLE) THEN 'REVIEW' ELSE 'FLAG' END AS rec FROM decided)"""


@register(
    "t11_decisions",
    f"""{_DECISION_SQL} SELECT event_id, image_id, 'heuristic' AS inference_mode,
    p AS moderation_probability, rec AS recommendation FROM final""",
)
def t11_decisions(spark: SparkSession, root: str) -> DataFrame:
    decided = serving.decide(_served(eventlog.load_log(spark, root)), TRAIN)
    return decided.select(
        "event_id",
        "image_id",
        "inference_mode",
        "moderation_probability",
        "recommendation",
    )


@register(
    "a8_decision_statistics",
    f"""{_DECISION_SQL} SELECT 'heuristic_fallback' AS inference_mode, count(*) AS total,
    round(avg(p), 6) AS avg_probability, count(*) FILTER (WHERE rec = 'SAFE') AS safe,
    count(*) FILTER (WHERE rec = 'REVIEW') AS review, count(*) FILTER (WHERE rec = 'FLAG') AS flag FROM final""",
)
def a8_decision_statistics(spark: SparkSession, root: str) -> DataFrame:
    """A model run without a model: all decisions are fallbacks."""
    decided = serving.decide(
        _served(eventlog.load_log(spark, root)), TRAIN, use_model=True
    )
    return q.decision_statistics(decided).withColumn(
        "avg_probability", F.round("avg_probability", 6)
    )


_NOW = "epoch_us(TIMESTAMP '2024-01-20')"


@register(
    "t10_feature_snapshot",
    f"""{MODEL_SQL}, counts AS (SELECT image_id, {", ".join(
        f"count(*) FILTER (WHERE event_type = '{kind}' AND us >= {_NOW} - {seconds * US}) AS {kind}s_{size}"
        for kind in ("view", "comment")
        for size, seconds in (("5min", TRAIN.window_5min), ("1hr", TRAIN.window_1hr)))},
      {", ".join(f"count(*) FILTER (WHERE event_type = '{kind}') AS total_{kind}s" for kind in win.COUNTED)}
      FROM eng WHERE us <= {_NOW} GROUP BY image_id)
    SELECT i.id AS image_id, coalesce(views_5min, 0) AS views_5min, coalesce(views_1hr, 0) AS views_1hr,
      coalesce(comments_5min, 0) AS comments_5min, coalesce(comments_1hr, 0) AS comments_1hr,
      coalesce(total_views, 0) AS total_views, coalesce(total_comments, 0) AS total_comments,
      coalesce(total_flags, 0) AS total_flags,
      coalesce(views_5min, 0) / CAST({TRAIN.window_5min / 60.0} AS DOUBLE) AS view_velocity,
      coalesce(total_comments, 0) / CAST(greatest(coalesce(total_views, 0), 1) AS DOUBLE) AS comment_ratio,
      coalesce(views_5min, 0) + 5 * coalesce(comments_5min, 0) AS recent_engagement,
      CAST(length(coalesce(caption, '')) AS INTEGER) AS caption_length,
      CAST(length(coalesce(caption, '')) > 0 AS INTEGER) AS has_caption,
      CAST(trunc(({_NOW} - up) / CAST({US_SQL} AS DOUBLE)) AS BIGINT) AS time_since_upload_seconds,
      uploaded_at, coalesce(category, 'unknown') AS category, user_id
    FROM img i LEFT JOIN counts c ON c.image_id = i.id WHERE up <= {_NOW}""",
)
def t10_feature_snapshot(spark: SparkSession, root: str) -> DataFrame:
    log = eventlog.load_log(spark, root)
    return ntz(
        serving.feature_snapshot(eventlog.engagement(log), upload_rows(log), AS_OF, TRAIN)
    )


# --------------------------------------------------------------------------------- model


def _trained(spark: SparkSession, root: str, numeric_only: bool = False):
    """Training reads the stored table, so its passes do not rebuild the features."""
    path = scratch_dir(spark, "training") + "/table"
    writers.overwrite_snapshot(training(spark, root), path)
    rows = readers.read_snapshot(spark, path, TRAINING)
    return rows, model.train(rows, numeric_only=numeric_only)


@register("m2_model_scores")
def m2_model_scores(spark: SparkSession, root: str) -> DataFrame:
    """Train on the training table, save, load through the pointer, score the same rows."""
    rows, fitted = _trained(spark, root)
    store = scratch_dir(spark, "models")
    writers.save_model(fitted, store, 1)
    loaded, pointer = writers.load_latest_model(spark, store)
    scored = serving.decide(rows, TRAIN, True, loaded, pointer["version"])
    return scored.select(
        "image_id",
        "decision_point_minutes",
        "inference_mode",
        "model_version",
        F.round("moderation_probability", 4).alias("moderation_probability"),
        "recommendation",
    )


@register("m3_numeric_model_scores")
def m3_numeric_model_scores(spark: SparkSession, root: str) -> DataFrame:
    rows, fitted = _trained(spark, root, numeric_only=True)
    return model.score_model(fitted, rows, TRAIN, numeric_only=True).select(
        "image_id", "decision_point_minutes", "recommendation"
    )


@register(
    "m1_prepared_rows",
    f"""{TRAINING_SQL} SELECT image_id, decision_point_minutes, CAST(is_weekend AS VARCHAR) AS is_weekend,
    CAST(has_caption AS VARCHAR) AS has_caption, category, CAST(views_1hr AS DOUBLE) AS views_1hr,
    CASE WHEN user_image_count % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(user_image_count AS DOUBLE) END AS user_image_count
    FROM training""",
)
def m1_prepared_rows(spark: SparkSession, root: str) -> DataFrame:
    holes = training(spark, root).withColumn(
        "user_image_count",
        F.when(F.col("user_image_count") % 2 != 0, F.col("user_image_count")),
    )
    return model.prepare(holes).select(
        "image_id",
        "decision_point_minutes",
        "is_weekend",
        "has_caption",
        "category",
        "views_1hr",
        "user_image_count",
    )
