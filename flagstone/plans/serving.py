"""Online features and decisions: requests are answered as of their own time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.functions import features as fx
from flagstone.functions.scoring import score_heuristic
from flagstone.functions.times import SECOND, micros
from flagstone.operators.skew import restrict, skew_join
from flagstone.operators.windows import PLURAL, rolling_counts
from flagstone.plans.model import score_model


def image_metadata(
    images: DataFrame, users: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Per image: content, upload time, user's age basis and the user's image count."""
    people = users.select(
        F.col("id").alias("user_id"), F.col("created_at").alias("user_created_at")
    )
    counts = images.groupBy("user_id").agg(F.count("*").alias("user_image_count"))
    category = F.when(F.col("category") != "", F.col("category"))
    return skew_join(
        images.select(
            F.col("id").alias("image_id"),
            "user_id",
            "caption",
            fx.known_category(category).alias("category"),
            "uploaded_at",
        ),
        people.join(counts, "user_id"),
        ["user_id"],
        "inner",
        settings.hot_rows,
    )


def missing_requests(
    requests: DataFrame, images: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Requests on images that are not in the database; they get no decision."""
    ids = images.select(F.col("id").alias("image_id"))
    return skew_join(
        requests, ids, ["image_id"], "left_anti", settings.hot_rows
    ).withColumn("error", F.lit("Image not found"))


def merge_features(online: DataFrame, metadata: DataFrame) -> DataFrame:
    """Outer merge on image_id; where both have a column the metadata wins."""
    both = [c for c in online.columns if c in metadata.columns and c != "image_id"]
    renamed = online.withColumnsRenamed({c: f"_online_{c}" for c in both})
    joined = renamed.join(metadata, "image_id", "full_outer")
    return joined.withColumns(
        {c: F.coalesce(c, f"_online_{c}") for c in both}
    ).drop(*[f"_online_{c}" for c in both])


def recent_events(
    events: DataFrame, requests: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """The events that a window of any request can reach: the filter goes into the scan."""
    oldest = requests.agg(F.min("ts")).first()[0]
    longest = timedelta(seconds=max(seconds for _, seconds in settings.rolling))
    return events.where(F.col("ts") >= F.lit(oldest - longest)) if oldest else events.limit(0)


def totals_at_requests(
    counted: DataFrame, recent: DataFrame, totals: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Replace the running totals over `recent` events by totals over the whole history.

    `totals` holds what a stream has counted for each image up to its event at `last_ts`, in the order
    of time. Before the recent events lie total less the recent events up to `last_ts`; that
    is one number an image, to which the running totals of its recent events are added.
    """
    names = [f"total_{plural}" for plural in PLURAL.values()]
    upto = restrict(recent, totals, ["image_id"]).join(totals.select("image_id", "last_ts"), "image_id")
    upto = upto.where(F.col("ts") <= F.col("last_ts")).groupBy("image_id").agg(
        *[F.count_if(F.col("event_type") == kind).alias(f"_{name}") for kind, name in zip(PLURAL, names)]
    )
    before = totals.join(upto, "image_id", "left").select(
        "image_id", *[(F.col(n) - F.coalesce(f"_{n}", F.lit(0))).alias(f"_{n}") for n in names]
    )
    joined = skew_join(counted, before, ["image_id"], "left", settings.hot_rows)
    return joined.withColumns(
        {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in names}
    ).drop(*[f"_{n}" for n in names])


def serving_features(
    requests: DataFrame,
    events: DataFrame,
    images: DataFrame,
    users: DataFrame,
    settings: Settings = Settings(),
    totals: DataFrame | None = None,
) -> DataFrame:
    """Full feature row of each request (image_id, event_id, trigger, ts).

    Counts are those at the request's time, windows closed at both ends. Requests on
    unknown images drop out; see `missing_requests`. A short list of requested images
    cuts the events down before anything is shuffled. With `totals` (see `buckets.read_totals`) only
    events that a window of a request can reach are read.
    """
    if totals is not None:
        events = recent_events(events, requests, settings)
        totals = restrict(totals, requests, ["image_id"])
    asked = restrict(events, requests, ["image_id"])
    online = rolling_counts(asked, settings, probes=requests, limit=settings.hot_rows)
    if totals is not None:
        online = totals_at_requests(online, asked, totals, settings)
    known = skew_join(
        online,
        image_metadata(images, users, settings),
        ["image_id"],
        "inner",
        settings.hot_rows,
    )
    uploaded, now = F.col("uploaded_at"), F.col("ts")
    return fx.add_derived(known, settings).withColumns(
        {
            "time_since_upload_seconds": fx.seconds_between(uploaded, now),
            "hour_of_day": fx.hour_of_day(uploaded),
            "day_of_week": fx.day_of_week(uploaded),
            "is_weekend": fx.is_weekend(uploaded),
            "caption_length": fx.caption_length(F.col("caption")),
            "has_caption": fx.has_caption(F.col("caption")),
            "user_age_days": fx.days_between(F.col("user_created_at"), now),
        }
    )


def feature_snapshot(
    events: DataFrame,
    uploads: DataFrame,
    as_of: datetime | Column,
    settings: Settings = Settings(),
) -> DataFrame:
    """The 16 online fields of every image at one instant, in a single aggregation.

    Counts are combined before the shuffle, so a busy image is one row per map task.
    `uploads` comes from `upload_metadata`.
    """
    now = F.lit(as_of) if isinstance(as_of, datetime) else as_of
    merged = events.select("image_id", "event_type", "ts").unionByName(
        uploads.select(
            "image_id",
            F.lit("upload").alias("event_type"),
            "ts",
            F.struct(
                "ts", "event_id", "category", "caption_length", "user_id"
            ).alias("meta"),
        ),
        allowMissingColumns=True,
    )
    kind, age = F.col("event_type"), micros(now) - micros("ts")
    aggregates = [F.max("meta").alias("meta")]
    for metric in ("view", "comment"):
        for size, seconds in (
            ("5min", settings.window_5min),
            ("1hr", settings.window_1hr),
        ):
            aggregates.append(
                F.count_if((kind == metric) & (age <= seconds * SECOND)).alias(
                    f"{PLURAL[metric]}_{size}"
                )
            )
    for metric, plural in PLURAL.items():
        aggregates.append(F.count_if(kind == metric).alias(f"total_{plural}"))
    seen = (
        merged.where(F.col("image_id").isNotNull() & (F.col("ts") <= now))
        .groupBy("image_id")
        .agg(*aggregates)
    )
    length = F.coalesce("meta.caption_length", F.lit(0))
    return seen.select(
        "image_id",
        "views_5min",
        "views_1hr",
        "comments_5min",
        "comments_1hr",
        "total_views",
        "total_comments",
        "total_flags",
        fx.view_velocity(F.col("views_5min"), settings).alias("view_velocity"),
        fx.comment_ratio(F.col("total_comments"), F.col("total_views")).alias(
            "comment_ratio"
        ),
        (F.col("views_5min") + F.col("comments_5min") * settings.comment_weight).alias(
            "recent_engagement"
        ),
        length.alias("caption_length"),
        (length > 0).cast("int").alias("has_caption"),
        F.coalesce(fx.seconds_between(F.col("meta.ts"), now), F.lit(0)).alias(
            "time_since_upload_seconds"
        ),
        F.col("meta.ts").alias("uploaded_at"),
        F.coalesce("meta.category", F.lit("unknown")).alias("category"),
        F.coalesce("meta.user_id", F.lit("")).alias("user_id"),
    )


def decide(
    features: DataFrame,
    settings: Settings = Settings(),
    use_model: bool = False,
    model: PipelineModel | None = None,
    version: int | None = None,
) -> DataFrame:
    """Score feature rows. Without a model a model run falls back to the rules."""
    if use_model and model is not None:
        return score_model(model, features, settings, version).withColumn(
            "inference_mode", F.lit("model")
        )
    mode = "heuristic_fallback" if use_model else "heuristic"
    return (
        score_heuristic(features, settings)
        .withColumn("model_version", F.lit(None).cast("int"))
        .withColumn("inference_mode", F.lit(mode))
    )
