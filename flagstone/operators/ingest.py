"""From raw messages to validated events, and back to messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.functions.features import caption_length
from flagstone.functions.times import parse_instant
from flagstone.operators.skew import HOT_ROWS, skew_join
from flagstone.schemas import PAYLOAD, REQUEST

KNOWN = ("view", "comment", "upload", "flag")


def parse_envelopes(raw: DataFrame) -> DataFrame:
    """Parse the JSON `value`; a malformed one leaves `_corrupt_record` set.

    The parsed struct goes through `inline`, across which the optimizer does not copy
    expressions: otherwise every later filter would parse the text again.
    """
    parsed = F.from_json(
        F.col("value").cast("string"),
        PAYLOAD,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return raw.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("arrived_at"),
        F.inline(F.array(parsed)),
    )


def event_time(arrival: Column | None = None) -> Column:
    """Event time by type: viewed_at, created_at or uploaded_at, else a numeric timestamp.

    A streaming caller passes the arrival time, used only when an event has no time at
    all. Text that is no instant stays null in both forms.
    """
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.col("viewed_at"))
        .when(kind.isin("comment", "flag"), F.col("created_at"))
        .when(kind == "upload", F.col("uploaded_at"))
    )
    missing = F.timestamp_seconds(F.col("timestamp"))
    if arrival is not None:
        missing = F.coalesce(missing, arrival, F.current_timestamp())
    return F.when(text.isNull() | (text == ""), missing).otherwise(parse_instant(text))


def _absent(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def validate(parsed: DataFrame, arrival_fallback: bool = False) -> DataFrame:
    """Add `ts`, `event_id` and `reject_reason` (null for a good event).

    Comments and flags are identified by their own id, other events by their position in
    the topic.
    """
    kind = F.col("event_type")
    position = F.concat_ws("-", "topic", "partition", "offset")
    timed = parsed.withColumn(
        "ts", event_time(F.col("arrived_at") if arrival_fallback else None)
    ).withColumn(
        "event_id",
        F.coalesce(
            F.when(kind == "comment", F.col("comment_id")),
            F.when(kind == "flag", F.col("flag_id")),
            position,
        ),
    )
    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), "bad_json")
        .when(~F.coalesce(kind.isin(*KNOWN), F.lit(False)), "unknown_type")
        .when((kind == "flag") & _absent("image_id") & _absent("comment_id"), "no_target")
        .when((kind == "flag") & _absent("image_id"), "comment_flag")
        .when(_absent("image_id"), "missing_key")
        .when((kind == "comment") & _absent("comment_id"), "missing_key")
        .when(F.col("ts").isNull(), "bad_time")
    )
    return timed.withColumn("reject_reason", reason)


def good(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_reason").isNull())


def quarantine(validated: DataFrame) -> DataFrame:
    """Rejected records; the job goes on without them."""
    return validated.where(F.col("reject_reason").isNotNull())


def route(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type)


def union_topics(*streams: DataFrame) -> DataFrame:
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), streams
    )


def flag_has_target(flags: DataFrame) -> DataFrame:
    return flags.where("image_id is not null or comment_id is not null")


def accepted(events: DataFrame, images: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Events on known images."""
    ids = images.select(F.col("id").alias("image_id"))
    return skew_join(events, ids, ["image_id"], "left_semi", limit)


def rejected(events: DataFrame, images: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Events on unknown images."""
    ids = images.select(F.col("id").alias("image_id"))
    return skew_join(events, ids, ["image_id"], "left_anti", limit)


def first_user_per_name(users: DataFrame) -> DataFrame:
    """The first row of each username; later sign-ups return it."""
    rest = [c for c in users.columns if c not in ("username", "created_at", "id")]
    return (
        users.groupBy("username")
        .agg(F.min(F.struct("created_at", "id", *rest)).alias("first"))
        .select("username", "first.*")
    )


def upload_metadata(uploads: DataFrame) -> DataFrame:
    """Upload rows with the defaults of the online metadata."""
    return uploads.select(
        "image_id",
        "event_id",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        caption_length(F.col("caption")).alias("caption_length"),
        F.coalesce("ts", F.current_timestamp()).alias("ts"),
        F.coalesce("user_id", F.lit("")).alias("user_id"),
    )


def parse_requests(raw: DataFrame) -> DataFrame:
    """Moderation requests of envelopes. A request's id is its position in its topic."""
    return (
        raw.select(
            F.concat_ws("-", "topic", "partition", "offset").alias("event_id"),
            F.from_json(F.col("value").cast("string"), REQUEST).alias("r"),
        )
        .select("event_id", "r.*")
        .where(F.col("image_id").isNotNull())
        .withColumns(
            {
                "trigger": F.coalesce("trigger", F.lit("unknown")),
                # to the microsecond nearest to the number, not the one below
                "ts": F.timestamp_micros(F.round(F.col("timestamp") * 1e6).cast("long")),
            }
        )
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC with microseconds and offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def to_messages(df: DataFrame, topic: str | Column, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Rows as JSON messages for a topic; null fields are left out."""
    fields = [c for c in df.columns if c not in exclude]
    name = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(name.alias("topic"), F.to_json(F.struct(*fields)).alias("value"))


def view_messages(views: DataFrame) -> DataFrame:
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return to_messages(
        views.select(F.lit("view").alias("event_type"), "image_id", naive.alias("viewed_at")),
        "views",
    )


def comment_messages(comments: DataFrame) -> DataFrame:
    return to_messages(
        comments.select(
            F.lit("comment").alias("event_type"),
            F.col("id").alias("comment_id"),
            "image_id",
            "user_id",
            "content",
            iso_utc(F.col("created_at")).alias("created_at"),
        ),
        "comments",
    )


def upload_messages(images: DataFrame) -> DataFrame:
    return to_messages(
        images.select(
            F.lit("upload").alias("event_type"),
            F.col("id").alias("image_id"),
            "user_id",
            "category",
            "caption",
            iso_utc(F.col("uploaded_at")).alias("uploaded_at"),
            "s3_url",
        ),
        "uploads",
    )


def flag_messages(flags: DataFrame) -> DataFrame:
    return to_messages(
        flags.select(
            F.lit("flag").alias("event_type"),
            F.col("id").alias("flag_id"),
            "user_id",
            "image_id",
            "comment_id",
            "reason",
            iso_utc(F.col("created_at")).alias("created_at"),
        ),
        "flags",
    )
