"""The training table: one row per image and decision point, as of that point."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.config import LABEL, Settings
from flagstone.functions import features as fx
from flagstone.functions.times import SECOND, micros
from flagstone.operators.asof import attach_latest
from flagstone.operators.skew import FIND, hot_keys, running, skew_join
from flagstone.schemas import TRAINING

METRICS = ("view", "comment")


def with_users(
    images: DataFrame,
    users: DataFrame,
    settings: Settings = Settings(),
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Images with their user's creation time; images of unknown users are dropped."""
    people = users.select(
        F.col("id").alias("user_id"), F.col("created_at").alias("user_created_at")
    )
    return skew_join(images, people, ["user_id"], "inner", settings.hot_rows, hot)


def decision_rows(images: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per image and decision point, with its cutoff."""
    points = F.array(*[F.lit(m) for m in settings.decision_points])
    return images.withColumn(
        "decision_point_minutes", F.explode(points)
    ).withColumn(
        "cutoff_us",
        micros("uploaded_at")
        + F.col("decision_point_minutes").cast("long") * 60 * SECOND,
    )


def user_image_counts(
    images: DataFrame,
    settings: Settings = Settings(),
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Decision rows with the number of images the user had uploaded by the cutoff.

    Uploads and cutoffs share one time line per user and the uploads are summed along it,
    instead of joining a user's images with each other.
    """
    points = F.array(F.lit(None).cast("int"), *[F.lit(m) for m in settings.decision_points])
    minutes = F.coalesce("decision_point_minutes", F.lit(0)).cast("long")
    line = images.withColumn("decision_point_minutes", F.explode(points)).withColumn(
        "cutoff_us", micros("uploaded_at") + minutes * 60 * SECOND
    )
    upload = F.col("decision_point_minutes").isNull()  # the row without a decision point
    counted = running(
        line,
        ["user_id"],
        "cutoff_us",
        sums={"user_image_count": F.when(upload, 1).otherwise(0)},
        limit=settings.hot_rows,
        hot=hot,
    )
    return counted.where(~upload)


def window_sums(
    images: DataFrame, windows: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Short and long window sums of each image at every decision point, as arrays.

    A window counts if it lies wholly between upload and cutoff and ends after cutoff - w.
    All event types and decision points go through one join and one aggregation. There is
    one window row per image, type and bucket, so a busy image is bounded by its time span.
    """
    windows = windows.where(F.col("event_type").isin(*METRICS))
    last_point = max(settings.decision_points) * 60 * SECOND
    uploads = images.select(
        F.col("id").alias("image_id"), micros("uploaded_at").alias("upload_us")
    )
    start, end = micros("window_start"), micros("window_end")
    contained = (
        windows.join(uploads, "image_id")
        .where((start >= F.col("upload_us")) & (end <= F.col("upload_us") + last_point))
        .withColumn("end_us", end)
    )
    aggregates = []
    for kind in METRICS:
        for size, seconds in (
            ("5min", settings.window_5min),
            ("1hr", settings.window_1hr),
        ):
            at_points = []
            for minutes in settings.decision_points:
                cutoff = F.col("upload_us") + minutes * 60 * SECOND
                inside = (
                    (F.col("event_type") == kind)
                    & (F.col("end_us") <= cutoff)
                    & (F.col("end_us") > cutoff - seconds * SECOND)
                )
                at_points.append(
                    F.coalesce(F.sum(F.when(inside, F.col("event_count"))), F.lit(0))
                )
            aggregates.append(F.array(*at_points).alias(f"{kind}s_{size}"))
    return contained.groupBy("image_id").agg(*aggregates)


def labels(
    images: DataFrame, flags: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Images flagged within the label horizon after upload, both ends included.

    Flags are first reduced to the earliest and latest of each image and horizon-sized
    bucket. No bucket is longer than the horizon, so one of the two lies inside the
    interval exactly when any flag of the bucket does.
    """
    horizon = settings.label_hours * 3600 * SECOND
    us = micros("created_at")
    buckets = (
        flags.where(F.col("image_id").isNotNull())
        .groupBy("image_id", (us - F.pmod(us, F.lit(horizon))).alias("bucket"))
        .agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"))
    )
    uploads = images.select(
        F.col("id").alias("image_id"), micros("uploaded_at").alias("upload_us")
    )
    return (
        buckets.join(uploads, "image_id")
        .where(
            (F.col("last_us") >= F.col("upload_us"))
            & (F.col("first_us") <= F.col("upload_us") + horizon)
        )
        .select("image_id")
        .distinct()
    )


def window_union(view_windows: DataFrame, comment_windows: DataFrame) -> DataFrame:
    """The two window tables as one, with the event type as a column."""
    columns = ("image_id", "window_start", "window_end", "event_count")
    return view_windows.select(*columns, F.lit("view").alias("event_type")).unionByName(
        comment_windows.select(*columns, F.lit("comment").alias("event_type"))
    )


def milestone_features(
    rows: DataFrame,
    comments: DataFrame,
    milestones: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Window features for a lake without window tables: comment counts since upload and
    the largest view milestone by the cutoff; short windows are estimated from the long.
    """
    probes = rows.withColumn("cutoff", F.timestamp_micros("cutoff_us"))
    reached = (
        milestones.where(F.col("milestone_type") == "views")
        .groupBy(F.col("image_id").alias("id"), "reached_at")
        .agg(F.max("milestone_value").alias("milestone_value"))
    )
    reached = running(
        reached.withColumn("us", micros("reached_at")),
        ["id"],
        "us",
        latest={"views_1hr": F.col("milestone_value").cast("long")},
        limit=settings.hot_rows,
    ).select("id", "reached_at", "views_1hr")
    probes = attach_latest(
        probes, reached, ["id"], "cutoff", "reached_at", limit=settings.hot_rows
    )

    # Comments up to the cutoff minus comments before the upload, on one time line.
    ends = F.array(
        F.struct(F.lit(1).alias("sign"), F.col("cutoff_us").alias("us")),
        F.struct(F.lit(-1).alias("sign"), (micros("uploaded_at") - 1).alias("us")),
    )
    line = (
        probes.select("id", "decision_point_minutes", F.inline(ends))
        .unionByName(
            comments.select(
                F.col("image_id").alias("id"),
                micros("created_at").alias("us"),
                F.lit(1).cast("long").alias("n"),
            ),
            allowMissingColumns=True,
        )
    )
    spans = (
        running(line, ["id"], "us", sums={"so_far": F.col("n")}, limit=settings.hot_rows)
        .where(F.col("sign").isNotNull())
        .groupBy("id", "decision_point_minutes")
        .agg(
            F.sum(F.col("sign") * F.coalesce("so_far", F.lit(0))).alias("comments_1hr")
        )
    )
    minutes = F.col("decision_point_minutes")
    return (
        probes.join(spans, ["id", "decision_point_minutes"], "left")
        .withColumns(
            {
                "views_1hr": F.coalesce("views_1hr", F.lit(0)).cast("long"),
                "comments_1hr": F.coalesce("comments_1hr", F.lit(0)).cast("long"),
            }
        )
        .withColumns(
            {
                "views_5min": fx.estimate_short_count(F.col("views_1hr"), minutes, settings),
                "comments_5min": fx.estimate_short_count(
                    F.col("comments_1hr"), minutes, settings
                ),
            }
        )
        .drop("cutoff", "reached_at")
    )


def _within(df: DataFrame, column: str, start: datetime, end: datetime, closed: bool = False) -> DataFrame:
    upto = F.col(column) <= end if closed else F.col(column) < end
    return df.where((F.col(column) >= start) & upto)


def upload_range(images: DataFrame) -> tuple[datetime, datetime] | None:
    """The half-open range of the upload times of a batch of images, gathered once; None for none."""
    ends = images.agg(F.min("uploaded_at").alias("low"), F.max("uploaded_at").alias("high")).first()
    return None if ends.low is None else (ends.low, ends.high + timedelta(microseconds=1))


def build_training_data(
    users: DataFrame,
    images: DataFrame,
    flags: DataFrame,
    view_windows: DataFrame | None = None,
    comment_windows: DataFrame | None = None,
    settings: Settings = Settings(),
    mode: str = "windows",
    comments: DataFrame | None = None,
    milestones: DataFrame | None = None,
    mature_at: object | None = None,
    windows: DataFrame | None = None,
    uploaded: tuple[datetime, datetime] | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """All 19 columns of the training table, as one lazy plan.

    `uploaded` keeps the images of [start, end); windows and flags that none of them can use are
    then left out by filters on their times, which reach their scans (see `upload_range` for the range
    of a batch of images). The users' image counts still see all images. `extra` columns
    of the images' rows, such as `uploaded_at`, follow the 19.

    Window counts come from the two window tables or, with an event_type column, from
    `windows`.
    `mode="milestone"` uses raw comments and milestones instead of window tables.
    `mature_at` keeps only images whose label horizon has passed by that instant.
    """
    slim = images.select("id", "user_id", "caption", "category", "uploaded_at")
    busy = settings.hot_rows // (1 + len(settings.decision_points))
    hot = hot_keys(slim, ["user_id"], busy)
    known = with_users(slim, users, settings, hot)
    rows = user_image_counts(known, settings, hot)
    if mature_at is not None:
        horizon = F.expr(f"interval {settings.label_hours} hours")
        rows = rows.where(F.col("uploaded_at") + horizon <= mature_at)

    if uploaded is not None:
        first, last = uploaded
        rows, slim = _within(rows, "uploaded_at", first, last), _within(slim, "uploaded_at", first, last)
        flags = _within(flags, "created_at", first, last + timedelta(hours=settings.label_hours), True)

    if mode == "windows":
        if windows is None:
            windows = window_union(view_windows, comment_windows)
        if uploaded is not None:
            reach = last + timedelta(minutes=max(settings.decision_points))
            windows = _within(windows, "window_start", first, reach)
        sums = window_sums(slim, windows, settings)
        points = F.array(*[F.lit(m) for m in settings.decision_points])
        at = F.array_position(points, F.col("decision_point_minutes"))
        rows = rows.join(sums.withColumnRenamed("image_id", "id"), "id", "left")
        rows = rows.withColumns(
            {
                name: F.coalesce(F.element_at(name, at.cast("int")), F.lit(0))
                for name in ("views_5min", "views_1hr", "comments_5min", "comments_1hr")
            }
        )
    elif mode == "milestone":
        rows = milestone_features(rows, comments, milestones, settings)
    else:
        raise ValueError(f"unknown mode: {mode}")

    flagged = labels(slim, flags, settings).select(
        F.col("image_id").alias("id"), F.lit(1).alias(LABEL)
    )
    rows = rows.join(flagged, "id", "left")
    ts = F.col("uploaded_at")
    rows = fx.add_derived(rows, settings).withColumns(
        {
            "image_id": F.col("id"),
            "time_since_upload_seconds": F.col("decision_point_minutes") * 60,
            "hour_of_day": fx.hour_of_day(ts),
            "day_of_week": fx.day_of_week(ts),
            "is_weekend": fx.is_weekend(ts),
            "caption_length": fx.caption_length(F.col("caption")),
            "has_caption": fx.has_caption(F.col("caption")),
            "user_age_days": fx.days_between(F.col("user_created_at"), ts),
            "category": fx.known_category(F.col("category")),
            LABEL: F.coalesce(LABEL, F.lit(0)),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in TRAINING], *extra)
