"""Feature formulas as column expressions, shared by training and serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.config import CATEGORIES, CATEGORY_COLUMNS, FEATURES, Settings
from flagstone.functions.times import DAY, SECOND, micros

UNKNOWN = "Unknown"


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds, cut toward zero."""
    return ((micros(end) - micros(start)) / F.lit(SECOND)).cast("long")


def days_between(start: Column, end: Column) -> Column:
    """Whole days of 86,400 s, cut toward zero; negative if `end` comes first."""
    return ((micros(end) - micros(start)) / F.lit(DAY)).cast("int")


def view_velocity(views_short: Column, settings: Settings = Settings()) -> Column:
    """Views per minute over the short window."""
    return views_short / F.lit(settings.window_5min / 60.0)


def comment_ratio(comments: Column, views: Column) -> Column:
    return comments / F.greatest(views, F.lit(1))


def engagement(
    views: Column, comments: Column, settings: Settings = Settings()
) -> Column:
    return (views + comments * settings.comment_weight).cast("double")


def caption_length(caption: Column) -> Column:
    """Length in code points; null counts as empty."""
    return F.length(F.coalesce(caption, F.lit("")))


def has_caption(caption: Column) -> Column:
    return (caption_length(caption) > 0).cast("int")


def known_category(category: Column) -> Column:
    return F.coalesce(category, F.lit(UNKNOWN))


def category_flags(category: Column) -> list[Column]:
    """One 0/1 column per class; a category outside the list sets none."""
    name = F.trim(F.coalesce(category, F.lit(UNKNOWN)))
    return [
        (name == value).cast("int").alias(column)
        for value, column in zip(CATEGORIES, CATEGORY_COLUMNS)
    ]


def category_of(flags: Sequence[Column] | None = None) -> Column:
    """Class name from the one-hot columns, `Unknown` when none is set."""
    flags = flags or [F.col(c) for c in CATEGORY_COLUMNS]
    return F.coalesce(
        *[F.when(flag == 1, value) for value, flag in zip(CATEGORIES, flags)],
        F.lit(UNKNOWN),
    )


def finite(value: Column) -> Column:
    """NaN to 0 and infinities to plus or minus a million."""
    value = F.nanvl(value.cast("double"), F.lit(0.0))
    return (
        F.when(value == float("inf"), 1e6)
        .when(value == float("-inf"), -1e6)
        .otherwise(value)
    )


def add_derived(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Velocity, ratio and engagement from the four window counts."""
    return df.withColumns(
        {
            "view_velocity_per_min": view_velocity(F.col("views_5min"), settings),
            "comment_to_view_ratio": comment_ratio(
                F.col("comments_1hr"), F.col("views_1hr")
            ),
            "recent_engagement_score": engagement(
                F.col("views_5min"), F.col("comments_5min"), settings
            ),
        }
    )


def feature_columns(df: DataFrame) -> DataFrame:
    """The 26 features as clean doubles in vector order, next to the other columns."""
    flags = dict(zip(CATEGORY_COLUMNS, category_flags(F.col("category"))))
    missing = [f for f in FEATURES if f not in flags and f not in df.columns]
    if missing:
        raise ValueError(f"features missing: {missing}")
    clean = {
        name: finite(F.coalesce(flags.get(name, F.col(name)).cast("double"), F.lit(0.0)))
        for name in FEATURES
    }
    return df.withColumns(clean)


def feature_vector(df: DataFrame, output: str = "features") -> DataFrame:
    """Add the feature vector; every row has one entry per feature name."""
    assembler = VectorAssembler(
        inputCols=list(FEATURES), outputCol=output, handleInvalid="keep"
    )
    return assembler.transform(feature_columns(df))


def feature_map(vector: Column | str = "features") -> Column:
    """Feature name to value."""
    names = F.array(*[F.lit(n) for n in FEATURES])
    return F.map_from_arrays(names, vector_to_array(vector))


def feature_summary(values: Sequence[Column] | None = None, compact: bool = False) -> Column:
    """One text line per feature, cut to whole numbers; `compact` leaves out the zeros."""
    values = values or [F.col(f) for f in FEATURES]
    lines = []
    for i, (name, value) in enumerate(zip(FEATURES, values)):
        if name in CATEGORY_COLUMNS:
            shown = F.when(value == 1, "Yes").otherwise("No")
        else:
            shown = value.cast("long").cast("string")
        line = F.format_string("  [%2d] %-30s = %s", F.lit(i), F.lit(name), shown)
        lines.append(F.when(value != 0, line) if compact else line)
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def fixed(value: Column, digits: int) -> Column:
    """Decimal text of a single-precision value, exact ties rounded to even."""
    exact = value.cast("float").cast("double").cast("decimal(38,18)")
    return F.format_string(f"%.{digits}f", F.bround(exact, digits).cast("double"))


def estimate_short_count(long_count: Column, minutes: Column, settings: Settings = Settings()) -> Column:
    """Short-window count guessed from the long one, for tables without window counts."""
    short = settings.window_5min / 60.0
    share = F.greatest(minutes / F.lit(short), F.lit(1.0))
    return F.when(minutes >= short, (long_count / share).cast("long")).otherwise(long_count)
