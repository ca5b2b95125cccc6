"""Declared schemas of every stream and table. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.TimestampType(),
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The shape of a message-queue source; files stand in for it where no connector is installed.
ENVELOPE = _schema(topic=S, partition=I, offset=L, timestamp=TS, value=S)

# All event payloads share one schema; each event type fills its own fields.
PAYLOAD = _schema(
    event_type=S,
    image_id=S,
    comment_id=S,
    flag_id=S,
    user_id=S,
    viewed_at=S,
    created_at=S,
    uploaded_at=S,
    timestamp=D,
    content=S,
    reason=S,
    category=S,
    caption=S,
    s3_url=S,
    _corrupt_record=S,
)
REQUEST = T.StructType(
    [
        T.StructField("image_id", S),
        T.StructField("trigger", S),
        T.StructField("context", T.MapType(S, L)),
        T.StructField("timestamp", D),
    ]
)

USERS = _schema(id=S, username=S, created_at=TS)
IMAGES = _schema(
    id=S, user_id=S, s3_url=S, caption=S, category=S, uploaded_at=TS, views=I
)
COMMENTS = _schema(id=S, image_id=S, user_id=S, content=S, created_at=TS)
FLAGS = _schema(id=S, user_id=S, image_id=S, comment_id=S, reason=S, created_at=TS)
MILESTONES = _schema(
    id=S, image_id=S, milestone_type=S, milestone_value=I, reached_at=TS
)
DECISIONS = _schema(
    id=S,
    image_id=S,
    inference_mode=S,
    moderation_probability=D,
    recommendation=S,
    trigger_type=S,
    created_at=TS,
)
ENTITY_TABLES = {
    "users": USERS,
    "images": IMAGES,
    "comments": COMMENTS,
    "flags": FLAGS,
    "image_milestones": MILESTONES,
}

# Events after parsing; `ts` is the event time, `event_id` orders events of equal time.
EVENTS = _schema(event_id=S, event_type=S, image_id=S, user_id=S, ts=TS)
WINDOWS = _schema(
    image_id=S,
    event_type=S,
    window_start=TS,
    window_end=TS,
    event_count=L,
    processed_at=TS,
)
ALERTS = _schema(image_id=S, alert_type=S, alert_ts=TS, observed=L, threshold=L)
TRAINING = _schema(
    image_id=S,
    decision_point_minutes=I,
    time_since_upload_seconds=I,
    hour_of_day=I,
    day_of_week=I,
    is_weekend=I,
    views_5min=L,
    views_1hr=L,
    comments_5min=L,
    comments_1hr=L,
    view_velocity_per_min=D,
    comment_to_view_ratio=D,
    recent_engagement_score=D,
    caption_length=I,
    has_caption=I,
    user_image_count=L,
    user_age_days=I,
    category=S,
    label_needs_moderation_24h=I,
)
