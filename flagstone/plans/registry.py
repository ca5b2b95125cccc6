"""Named queries over the driver tables, each with the SQL that must give the same rows.

The event log is read as the data model (see `sources.eventlog`). Its activity is sparse,
so windows and thresholds are scaled: the formulas and interval edges are the same.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.config import CATEGORIES, Settings
from flagstone.operators import alerts as al
from flagstone.operators import windows as win
from flagstone.plans import training_table as tt
from flagstone.sources import eventlog
from flagstone.sources.scratch import staged

Query = Callable[[SparkSession, str], DataFrame]

HOUR, DAY = 3600, 86_400

# Training features: 6 h buckets, decision points at 0, 1 and 3 days.
TRAIN = Settings(
    window_1min=6 * HOUR,
    window_5min=6 * HOUR,
    window_1hr=3 * DAY,
    bucket_seconds=6 * HOUR,
    decision_points=(0, 1440, 4320),
)
# Alerts with the user as the counted item.
ALERT = Settings(
    window_1min=6 * HOUR,
    window_5min=DAY,
    window_1hr=3 * DAY,
    viral_views_5min=3,
    suspicious_comments_1min=2,
    popular_views_1hr=4,
    milestones=(5, 10, 20),
)
AS_OF = datetime(2024, 1, 20, tzinfo=timezone.utc)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def ntz(df: DataFrame) -> DataFrame:
    """Instants as plain UTC timestamps, the type the oracle has."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name)
            if kind == "timestamp"
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# --------------------------------------------------------------------- oracle fragments

_CATEGORY_LIST = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"

MODEL_SQL = f"""
WITH log AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n, ts, epoch_us(ts) AS us,
         CAST(user_id AS VARCHAR) AS user_id, event_type AS raw_type, value, props,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events),
typed AS (
  SELECT *, CASE raw_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'comment'
                          WHEN 'error' THEN 'flag' END AS event_type FROM log),
placed AS (
  SELECT *, last_value(CASE WHEN raw_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY us, n
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS image_id
  FROM typed),
facts AS (SELECT event_id, n, event_type, user_id, ts, us, value, k, image_id
          FROM placed WHERE event_type IS NOT NULL),
eng AS (SELECT * FROM facts WHERE image_id IS NOT NULL),
usr AS (SELECT user_id AS id, min(ts) AS created_at, min(us) AS created_us
        FROM log GROUP BY user_id),
img AS (
  SELECT event_id AS id, user_id, 'store/' || event_id AS s3_url,
         CASE WHEN k % 5 <> 0 THEN props END AS caption,
         CASE WHEN k % 12 < 11 THEN ({_CATEGORY_LIST})[k % 12 + 1] END AS category,
         ts AS uploaded_at, us AS up, k
  FROM log WHERE raw_type = 'signup'),
byuser AS (SELECT user_id AS image_id, event_id, n, event_type, ts, us
           FROM typed WHERE event_type IS NOT NULL)"""

US = 1_000_000
US_SQL = "CAST(1000000 AS BIGINT)"


def rolling_sql(source: str, settings: Settings, name: str = "rolling") -> str:
    """Window counts by SQL range frames: own kind (t-w, t], other kind [t-w, t]."""
    parts = []
    for kind in ("view", "comment"):
        for size, seconds in settings.rolling:
            width = seconds * US

            def frame(low: int, kind: str = kind) -> str:
                return (
                    f"count(*) FILTER (WHERE event_type = '{kind}') OVER (PARTITION BY image_id "
                    f"ORDER BY us RANGE BETWEEN {low} PRECEDING AND CURRENT ROW)"
                )

            parts.append(
                f"CASE WHEN event_type = '{kind}' THEN {frame(width - 1)} "
                f"ELSE {frame(width)} END AS {kind}s_{size}"
            )
    for kind in win.COUNTED:
        parts.append(
            f"count(*) FILTER (WHERE event_type = '{kind}') OVER (PARTITION BY image_id "
            f"ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_{kind}s"
        )
    return (
        f"{name} AS (SELECT image_id, event_id, n, event_type, ts, us, "
        + ", ".join(parts)
        + f" FROM {source})"
    )


ROLLING_COLUMNS = ", ".join(
    [f"{kind}s_{size}" for kind in ("view", "comment") for size, _ in ALERT.rolling]
    + [f"total_{kind}s" for kind in win.COUNTED]
)
ALERT_ROWS_SQL = f"""
crossing AS (
  SELECT image_id, n, ts, 'viral' AS alert_type, views_5min AS observed,
         CAST({ALERT.viral_views_5min} AS BIGINT) AS threshold
  FROM rolling WHERE event_type IN ('view', 'comment') AND views_5min >= {ALERT.viral_views_5min}
  UNION ALL
  SELECT image_id, n, ts, 'suspicious', comments_1min, CAST({ALERT.suspicious_comments_1min} AS BIGINT)
  FROM rolling WHERE event_type = 'comment' AND comments_1min >= {ALERT.suspicious_comments_1min}
  UNION ALL
  SELECT image_id, n, ts, 'popular', views_1hr, CAST({ALERT.popular_views_1hr} AS BIGINT)
  FROM rolling WHERE event_type IN ('view', 'comment') AND views_1hr >= {ALERT.popular_views_1hr}),
alert AS (
  SELECT image_id, alert_type, ts AS alert_ts, observed, threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY image_id, alert_type ORDER BY ts, n) AS rn FROM crossing)
  WHERE rn = 1)"""
MILESTONE_SQL = f"""
milestone AS (
  SELECT image_id, 'views' AS milestone_type, CAST(rn AS INTEGER) AS milestone_value, ts AS reached_at
  FROM (SELECT image_id, ts, row_number() OVER (PARTITION BY image_id ORDER BY us, n) AS rn
        FROM byuser WHERE event_type = 'view')
  WHERE rn IN {ALERT.milestones})"""
BUCKET = TRAIN.bucket_seconds * US
WINDOWS_SQL = f"""
windows AS (
  SELECT image_id, event_type, make_timestamp(us - us % {BUCKET}) AS window_start,
         make_timestamp(us - us % {BUCKET} + {BUCKET}) AS window_end,
         us - us % {BUCKET} AS ws, us - us % {BUCKET} + {BUCKET} AS we, count(*) AS event_count
  FROM eng GROUP BY image_id, event_type, us - us % {BUCKET})"""


def training_sql() -> str:
    short, long = TRAIN.window_5min * US, TRAIN.window_1hr * US

    def total(kind: str, width: int) -> str:
        return (
            f"CAST(coalesce(sum(w.event_count) FILTER (WHERE w.event_type = '{kind}' "
            f"AND w.we > p.cutoff - {width}), 0) AS BIGINT)"
        )

    points = ", ".join(f"({m})" for m in TRAIN.decision_points)
    return f"""
points AS (
  SELECT i.*, u.created_us, p.m, i.up + p.m * 60 * {US_SQL} AS cutoff
  FROM img i JOIN usr u ON u.id = i.user_id, (VALUES {points}) AS p(m)),
sums AS (
  SELECT p.id, p.m, {total("view", short)} AS views_5min, {total("view", long)} AS views_1hr,
         {total("comment", short)} AS comments_5min, {total("comment", long)} AS comments_1hr
  FROM points p LEFT JOIN windows w
    ON w.image_id = p.id AND w.ws >= p.up AND w.we <= p.cutoff
  GROUP BY p.id, p.m),
flagged AS (
  SELECT DISTINCT i.id FROM img i JOIN eng f
    ON f.image_id = i.id AND f.event_type = 'flag' AND f.us >= i.up AND f.us <= i.up + 86400 * {US_SQL}),
user_asof AS (
  SELECT p.id, p.m, count(*) AS user_image_count
  FROM points p JOIN img o ON o.user_id = p.user_id AND o.up <= p.cutoff GROUP BY p.id, p.m),
training AS (
  SELECT p.id AS image_id, CAST(p.m AS INTEGER) AS decision_point_minutes,
         CAST(p.m * 60 AS INTEGER) AS time_since_upload_seconds,
         CAST(hour(p.uploaded_at) AS INTEGER) AS hour_of_day,
         CAST(isodow(p.uploaded_at) - 1 AS INTEGER) AS day_of_week,
         CAST(isodow(p.uploaded_at) >= 6 AS INTEGER) AS is_weekend,
         s.views_5min, s.views_1hr, s.comments_5min, s.comments_1hr,
         s.views_5min / CAST({TRAIN.window_5min / 60.0} AS DOUBLE) AS view_velocity_per_min,
         s.comments_1hr / CAST(greatest(s.views_1hr, 1) AS DOUBLE) AS comment_to_view_ratio,
         CAST(s.views_5min + 5 * s.comments_5min AS DOUBLE) AS recent_engagement_score,
         CAST(length(coalesce(p.caption, '')) AS INTEGER) AS caption_length,
         CAST(length(coalesce(p.caption, '')) > 0 AS INTEGER) AS has_caption,
         a.user_image_count,
         CAST(trunc((p.up - p.created_us) / CAST(86400 * {US_SQL} AS DOUBLE)) AS INTEGER) AS user_age_days,
         coalesce(p.category, 'Unknown') AS category,
         CAST(p.id IN (SELECT id FROM flagged) AS INTEGER) AS label_needs_moderation_24h
  FROM points p JOIN sums s ON s.id = p.id AND s.m = p.m JOIN user_asof a ON a.id = p.id AND a.m = p.m)"""


TRAINING_SQL = f"{MODEL_SQL}, {WINDOWS_SQL}, {training_sql()}"
ROLLING_SQL = f"{MODEL_SQL}, {rolling_sql('byuser', ALERT)}"
ALERT_SQL = f"{ROLLING_SQL}, {ALERT_ROWS_SQL}, {MILESTONE_SQL}"


def grain_sql(seconds: int) -> str:
    """Rolling counts over events cut to a grain."""
    grain = seconds * US
    return f"""{MODEL_SQL}, grain AS (
  SELECT image_id, event_id, n, event_type, us - us % {grain} AS us,
         make_timestamp(us - us % {grain}) AS ts FROM byuser),
{rolling_sql("grain", ALERT)}"""


GRAIN_ALERT_SQL = f"""{grain_sql(1)}, {ALERT_ROWS_SQL}, {MILESTONE_SQL.replace("byuser", "grain")}"""


# ---------------------------------------------------------------- shared Spark fragments


def windows(log: DataFrame) -> DataFrame:
    return win.tumbling_counts(eventlog.engagement(log), TRAIN)


def rolling(log: DataFrame) -> DataFrame:
    return win.rolling_counts(eventlog.by_user(log), ALERT)


def alerts(log: DataFrame) -> DataFrame:
    return al.first_alerts(rolling(log), ALERT)


def views(log: DataFrame) -> DataFrame:
    return eventlog.by_user(log).where(F.col("event_type") == "view")


def milestones(log: DataFrame) -> DataFrame:
    return al.milestone_crossings(views(log), ALERT)


def flagged(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "flag").select(
        "image_id", F.col("ts").alias("created_at")
    )


def flags(log: DataFrame) -> DataFrame:
    return flagged(eventlog.engagement(log))


def training(spark: SparkSession, root: str) -> DataFrame:
    return training_table(eventlog.load_log(spark, root))


def training_table(log: DataFrame, **options) -> DataFrame:
    """Attribution is done once and stored, as the windows and labels both read it."""
    events = staged(eventlog.engagement(log), "engagement")
    return tt.build_training_data(
        eventlog.users(log),
        eventlog.images(log),
        flagged(events),
        windows=win.tumbling_counts(events, TRAIN),
        settings=TRAIN,
        **options,
    )


def messages(log: DataFrame, damage: bool = False) -> DataFrame:
    """The log as raw messages, as a broker would deliver them."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.coalesce(
        F.when(F.col("event_type") == "view", "view"),
        F.when(F.col("event_type") == "click", "comment"),
        F.when(F.col("event_type") == "error", "flag"),
        F.when(F.col("event_type") == "signup", "upload"),
        F.col("event_type"),
    )
    body = F.to_json(
        F.struct(
            kind.alias("event_type"),
            F.when(F.col("k") % 10 != 3, F.col("user_id")).alias("image_id"),
            F.when(kind == "comment", F.col("event_id")).alias("comment_id"),
            F.when(kind == "flag", F.col("event_id")).alias("flag_id"),
            "user_id",
            F.when(kind == "view", stamp).alias("viewed_at"),
            F.when(kind.isin("comment", "flag"), F.concat(stamp, F.lit("+00:00"))).alias(
                "created_at"
            ),
            F.when(kind == "upload", F.concat(stamp, F.lit("Z"))).alias("uploaded_at"),
        )
    )
    if damage:
        body = F.when(F.col("k") == 7, F.substring(body, 1, 20)).otherwise(body)
    return log.select(
        F.concat(kind, F.lit("s")).alias("topic"),
        (F.col("k") % 4).alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ts").alias("timestamp"),
        body.alias("value"),
    )


MESSAGE_SQL = f"""{MODEL_SQL},
message AS (
  SELECT n, ts, us, k, user_id, event_id,
         CASE raw_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'comment' WHEN 'error' THEN 'flag'
                       WHEN 'signup' THEN 'upload' ELSE raw_type END AS event_type,
         CASE WHEN k % 10 <> 3 THEN user_id END AS image_id
  FROM log),
checked AS (
  SELECT *, CASE WHEN event_type NOT IN ('view', 'comment', 'upload', 'flag') THEN 'unknown_type'
                 WHEN event_type = 'flag' AND image_id IS NULL THEN 'no_target'
                 WHEN image_id IS NULL THEN 'missing_key' END AS reject_reason FROM message)"""
