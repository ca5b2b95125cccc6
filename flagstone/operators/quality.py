"""Reports and data-quality checks over the tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.config import LABEL, Settings
from flagstone.functions import features as fx
from flagstone.functions.text import short_id
from flagstone.operators import selection
from flagstone.schemas import TRAINING


def value_counts(df: DataFrame, column: str = LABEL) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def decision_statistics(decisions: DataFrame) -> DataFrame:
    """Per inference mode: decisions, mean probability, decisions by recommendation."""
    rec = F.col("recommendation")
    return decisions.groupBy("inference_mode").agg(
        F.count("*").alias("total"),
        F.avg("moderation_probability").alias("avg_probability"),
        F.count_if(rec == "SAFE").alias("safe"),
        F.count_if(rec == "REVIEW").alias("review"),
        F.count_if(rec == "FLAG").alias("flag"),
    )


def milestone_distribution(milestones: DataFrame) -> DataFrame:
    return (
        milestones.where(F.col("milestone_type") == "views")
        .groupBy("milestone_value")
        .agg(F.count("*").alias("n"))
        .orderBy("milestone_value")
    )


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def rows_per_image(df: DataFrame) -> DataFrame:
    return df.groupBy("image_id").agg(F.count("*").alias("n"))


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic; the total has topic `all`."""
    return (
        messages.rollup("topic")
        .agg(F.count("*").alias("n"), F.grouping("topic").alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, "all").otherwise(F.col("topic")).alias("topic"),
            "n",
        )
    )


def latency_summary(
    df: DataFrame,
    column: str = "latency_ms",
    target_ms: float = 50.0,
    accuracy: int = 10_000,
) -> DataFrame:
    """Mean, min, max and exact interpolated p50/p95/p99, and whether p99 meets the target.

    One scan sketches the percentiles with the basics, a second one counts what the sketch
    brackets; more are only needed where brackets may hold over `selection.BOUND` values.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    fractions = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    points = [p for f in fractions.values() for p in selection.sketch_points(f, accuracy)]
    basics = values.agg(
        F.count("*").alias("n"),
        F.avg("v").alias("mean_ms"),
        F.min("v").alias("min_ms"),
        F.max("v").alias("max_ms"),
        F.percentile_approx("v", points, accuracy).alias("ends"),
    ).first()
    percentiles = dict.fromkeys(fractions)
    if basics.n:
        places = {name: f * (basics.n - 1) for name, f in fractions.items()}
        ranks = {name: (math.floor(p), math.ceil(p)) for name, p in places.items()}
        brackets = {}
        if basics.n > 4 * accuracy:  # fewer rows are counted as they are
            for i, pair in enumerate(ranks.values()):
                brackets |= dict.fromkeys(pair, tuple(basics.ends[2 * i : 2 * i + 2]))
        found = selection.order_statistics(
            values, {r for pair in ranks.values() for r in pair}, basics.min_ms, basics.max_ms,
            basics.n, brackets, accuracy,
        )
        for name, (a, b) in ranks.items():
            percentiles[name] = found[a] + (found[b] - found[a]) * (places[name] - a)
    passed = basics.n > 0 and percentiles["p99_ms"] < target_ms
    row = (basics.mean_ms, basics.min_ms, basics.max_ms, *percentiles.values(), passed)
    names = ("mean_ms", "min_ms", "max_ms", *fractions)
    schema = ", ".join(f"{n} double" for n in names) + ", meets_target boolean"
    return df.sparkSession.createDataFrame([row], schema)


def reconcile(counts: DataFrame, events: DataFrame) -> DataFrame:
    """(image, type) whose window sums and raw event counts differ."""
    summed = counts.groupBy("image_id", "event_type").agg(
        F.sum("event_count").alias("windowed")
    )
    raw = events.groupBy("image_id", "event_type").agg(F.count("*").alias("raw"))
    return (
        summed.join(raw, ["image_id", "event_type"], "full_outer")
        .na.fill(0, ["windowed", "raw"])
        .where(F.col("windowed") != F.col("raw"))
    )


def schema_problems(
    df: DataFrame,
    required: Sequence[str] = tuple(TRAINING.names),
    forbidden: Sequence[str] = ("views_1min", "comments_1min"),
) -> list[tuple[str, str]]:
    """Columns missing from, or not allowed in, a training table."""
    present = set(df.columns)
    return [(c, "missing") for c in required if c not in present] + [
        (c, "forbidden") for c in forbidden if c in present
    ]


def leakage(training: DataFrame) -> DataFrame:
    """Rows at the upload instant that already have activity; there must be none."""
    active = F.lit(False)
    for column in ("views_5min", "views_1hr", "comments_5min", "comments_1hr"):
        active = active | (F.col(column) > 0)
    return training.where((F.col("decision_point_minutes") == 0) & active)


def inconsistent_features(
    training: DataFrame, settings: Settings = Settings(), tolerance: float = 0.001
) -> DataFrame:
    """Rows whose derived features differ from a recomputation."""
    derived = ("view_velocity_per_min", "comment_to_view_ratio", "recent_engagement_score")
    stored = training.withColumnsRenamed({c: f"stored_{c}" for c in derived})
    off = F.lit(False)
    for column in derived:
        off = off | (F.abs(F.col(column) - F.col(f"stored_{column}")) >= tolerance)
    return fx.add_derived(stored, settings).where(off)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def latest_decisions(decisions: DataFrame, n: int = 10) -> DataFrame:
    return decisions.orderBy(F.desc("created_at"), "id").limit(n)


def most_recent_active(images: DataFrame, n: int = 1) -> DataFrame:
    """Newest images that have views."""
    return (
        images.where(F.col("views") > 0).orderBy(F.desc("uploaded_at"), "id").limit(n)
    )


def milestone_timeline(milestones: DataFrame, image_id: str | None = None) -> DataFrame:
    """Milestones in the order they were reached, of one image or of all."""
    if image_id is not None:
        milestones = milestones.where(F.col("image_id") == image_id)
    return milestones.orderBy("reached_at", "image_id", "milestone_value")


def recent_milestones(milestones: DataFrame, n: int = 10) -> DataFrame:
    return (
        milestones.orderBy(F.desc("reached_at"), "image_id", "milestone_value")
        .limit(n)
        .withColumn("image_id", short_id(F.col("image_id")))
    )


def random_image(images: DataFrame, seed: int = 42) -> DataFrame:
    """One image drawn by a seeded hash: repeatable whatever the partitioning."""
    return images.orderBy(F.md5(F.concat("id", F.lit(f":{seed}"))), "id").limit(1)


def table_report(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows by key; `table_schema` has columns, types and the count."""
    return df.orderBy(*key).limit(n)


def table_schema(df: DataFrame) -> DataFrame:
    """One row a column: position, column_name, data_type, and the table's n_rows."""
    columns = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for i, f in enumerate(df.schema, start=1)
    ]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(F.array(*columns)), "n_rows")
