"""Counts per item: tumbling buckets, rolling windows at each event, totals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.functions.times import SECOND, micros
from flagstone.operators.skew import HOT_ROWS, hot_keys, running

COUNTED = ("view", "comment", "flag")
PLURAL = {"view": "views", "comment": "comments", "flag": "flags"}


def in_range(
    events: DataFrame,
    start: datetime | Column | None = None,
    end: datetime | Column | None = None,
    time: str = "ts",
) -> DataFrame:
    """Rows with start <= time < end. The comparison is on the bare column, so it reaches the scan."""
    if start is not None:
        events = events.where(F.col(time) >= start)
    if end is not None:
        events = events.where(F.col(time) < end)
    return events


def tumbling_counts(
    events: DataFrame,
    settings: Settings = Settings(),
    start: datetime | Column | None = None,
    end: datetime | Column | None = None,
) -> DataFrame:
    """Events per (image, type, bucket) in one pass over all types.

    The counts are combined before the shuffle, so a busy image costs one row per bucket
    and map task.
    """
    bucket = F.window("ts", f"{settings.bucket_seconds} seconds")
    return (
        in_range(events, start, end)
        .where(F.col("event_type").isin(*COUNTED) & F.col("image_id").isNotNull())
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


def window_table(counts: DataFrame, event_type: str) -> DataFrame:
    """The window table of one event type, stamped with the processing time."""
    return (
        counts.where(F.col("event_type") == event_type)
        .drop("event_type")
        .withColumn("processed_at", F.current_timestamp())
    )


def totals(events: DataFrame) -> DataFrame:
    """Lifetime views, comments and flags of each image."""
    return (
        events.where(
            F.col("event_type").isin(*COUNTED) & F.col("image_id").isNotNull()
        )
        .groupBy("image_id")
        .agg(
            *[
                F.count_if(F.col("event_type") == kind).alias(f"total_{PLURAL[kind]}")
                for kind in COUNTED
            ]
        )
    )


def flag_totals(flags: DataFrame) -> DataFrame:
    """Flags per image; flags on comments only carry no image and are left out."""
    return (
        flags.where(F.col("image_id").isNotNull() & (F.col("image_id") != ""))
        .groupBy("image_id")
        .agg(F.count("*").alias("total_flags"))
    )


def with_view_counter(images: DataFrame, views: DataFrame) -> DataFrame:
    """Images with their `views` counter recomputed from accepted view events."""
    counter = views.groupBy("image_id").agg(F.count("*").alias("_views"))
    return (
        images.drop("views")
        .join(counter.withColumnRenamed("image_id", "id"), "id", "left")
        .withColumn("views", F.coalesce("_views", F.lit(0)).cast("int"))
        .drop("_views")
    )


def window_counts(
    events: DataFrame, as_of: datetime | Column, settings: Settings = Settings()
) -> DataFrame:
    """Counts per image over [as_of - w, as_of] for every window: the read-time form."""
    now = F.lit(as_of) if isinstance(as_of, datetime) else as_of
    age = micros(now) - micros("ts")
    columns = []
    for kind in ("view", "comment"):
        for name, seconds in settings.rolling:
            columns.append(
                F.count_if(
                    (F.col("event_type") == kind)
                    & (age >= 0)
                    & (age <= seconds * SECOND)
                ).alias(f"{PLURAL[kind]}_{name}")
            )
    return (
        events.where(F.col("image_id").isNotNull()).groupBy("image_id").agg(*columns)
    )


def rolling_counts(
    events: DataFrame,
    settings: Settings = Settings(),
    probes: DataFrame | None = None,
    limit: int = HOT_ROWS,
) -> DataFrame:
    """Rolling window counts and running totals at each view and comment event.

    `events` has image_id, event_id, event_type and ts. At an event of its own kind a
    window of length w covers (t - w, t]; counts of the other kind cover [t - w, t].
    Events of equal time see each other. A comment delivered twice (same id and time)
    counts once in the windows and twice in the totals, and gives one output row.

    `probes` (image_id, event_id, ts and any other columns) are instants to evaluate at
    without counting themselves; all their windows are closed. With probes only they are
    returned.

    Each event is counted in at its time and out again when it leaves each window, so
    every window length costs one running sum and an event is shuffled once per window
    plus once.
    """
    known = events.where(
        F.col("event_type").isin(*COUNTED) & F.col("image_id").isNotNull()
    ).select("image_id", "event_id", "event_type", "ts")
    comments = (
        known.where(F.col("event_type") == "comment")
        .groupBy("image_id", "event_id", "event_type", "ts")
        .agg(F.count("*").alias("copies"))
    )
    points = (
        known.where(F.col("event_type") != "comment")
        .withColumn("copies", F.lit(1).cast("long"))
        .unionByName(comments)
        .withColumn("extra", F.lit(None).cast("string"))
    )
    carried: list[str] = []
    if probes is not None:
        carried = [
            c for c in probes.columns if c not in ("image_id", "event_id", "ts")
        ]
        extra = F.struct(*carried) if carried else F.lit(True)
        points = points.drop("extra").unionByName(
            probes.select(
                "image_id",
                "event_id",
                F.lit("probe").alias("event_type"),
                "ts",
                F.lit(0).cast("long").alias("copies"),
                extra.alias("extra"),
            ),
            allowMissingColumns=True,
        )

    # An event becomes one row and one more per window, so this many events make a hot key.
    seen = known.select("image_id")
    if probes is not None:
        seen = seen.unionByName(probes.select("image_id"))
    hot = hot_keys(seen, ["image_id"], limit // (1 + len(settings.rolling)))

    # step 0 is the event itself, step i its expiry from window i
    kind, step = F.col("event_type"), F.col("step")
    arrival = F.array(F.struct(F.lit(0).alias("step"), F.lit(0).alias("seconds")))
    expiries = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(seconds).alias("seconds"))
            for i, (_, seconds) in enumerate(settings.rolling, start=1)
        ]
    )
    line = points.withColumn(
        "move",
        F.explode(
            F.when(
                kind.isin("view", "comment"), F.concat(arrival, expiries)
            ).otherwise(arrival)
        ),
    ).select(
        "image_id",
        F.when(F.col("move.step") == 0, F.col("event_id")).alias("event_id"),
        "event_type",
        "copies",
        "extra",
        F.col("move.step").alias("step"),
        (micros("ts") + F.col("move.seconds").cast("long") * SECOND).alias("us"),
    )

    sums, peers = {}, {}
    for metric in ("view", "comment"):
        mine = kind == metric
        for i, (name, _) in enumerate(settings.rolling, start=1):
            column = f"{PLURAL[metric]}_{name}"
            sums[column] = F.when(mine & (step == 0), 1).when(mine & (step == i), -1)
            peers[f"_edge_{column}"] = F.when(mine & (step == i), 1)
    for metric in COUNTED:
        sums[f"total_{PLURAL[metric]}"] = F.when(
            (kind == metric) & (step == 0), F.col("copies")
        )

    if hot is None:
        # Shuffle the narrow rows; the columns to sum are computed on the other side.
        line = line.repartition("image_id")
    counted = running(line, ["image_id"], "us", sums=sums, peers=peers, limit=limit, hot=hot)
    wanted = ["probe"] if probes is not None else ["view", "comment"]
    out = counted.where((step == 0) & kind.isin(*wanted))
    columns = []
    for metric in ("view", "comment"):
        for name, _ in settings.rolling:
            column = f"{PLURAL[metric]}_{name}"
            at_edge = F.when(
                kind != metric, F.coalesce(f"_edge_{column}", F.lit(0))
            ).otherwise(0)
            columns.append((F.coalesce(column, F.lit(0)) + at_edge).alias(column))
    columns += [
        F.coalesce(f"total_{PLURAL[m]}", F.lit(0)).alias(f"total_{PLURAL[m]}")
        for m in COUNTED
    ]
    head = ["image_id", "event_id"]
    if probes is None:
        head.append("event_type")
    return out.select(
        *head,
        F.timestamp_micros("us").alias("ts"),
        *columns,
        *[F.col("extra").getField(c).alias(c) for c in carried],
    )


def running_total(
    events: DataFrame, event_type: str = "view", limit: int = HOT_ROWS
) -> DataFrame:
    """Running total of one event type at each of its events, in order of (ts, event)."""
    mine = events.where(
        (F.col("event_type") == event_type) & F.col("image_id").isNotNull()
    ).withColumn("_us", micros("ts"))
    return running(
        mine,
        ["image_id"],
        "_us",
        sums={"total": F.lit(1).cast("long")},
        tie="event_id",
        limit=limit,
    ).drop("_us")


def progress_rows(
    totals_at_events: DataFrame, settings: Settings = Settings(), every: int = 10
) -> DataFrame:
    """Running totals worth reporting: each `every`-th one and the milestones."""
    return totals_at_events.where(
        (F.col("total") % every == 0) | F.col("total").isin(*settings.milestones)
    )


def latest_metadata(uploads: DataFrame) -> DataFrame:
    """Last upload row of each image; a later event id wins among equal times."""
    payload = [c for c in uploads.columns if c not in ("image_id", "ts", "event_id")]
    return (
        uploads.where(F.col("image_id").isNotNull() & (F.col("image_id") != ""))
        .groupBy("image_id")
        .agg(F.max(F.struct("ts", "event_id", *payload)).alias("last"))
        .select("image_id", "last.*")
    )
