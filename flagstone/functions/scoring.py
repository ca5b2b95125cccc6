"""Rule-based moderation score with reasons, and the cut-offs shared with the model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.functions.features import fixed

# Inputs of the rules; a missing one counts as 0.
RULE_INPUTS = (
    "total_flags",
    "comments_1min",
    "comment_to_view_ratio",
    "total_comments",
    "total_views",
    "view_velocity_per_min",
    "recent_engagement_score",
    "user_image_count",
)

# Base score, then rule key and weight in the order they are added.
BASE = 0.3
WEIGHTS = (
    ("flags_reported", 0.4),
    ("comment_spam", 0.3),
    ("unusual_engagement", 0.2),
    ("bot_pattern", 0.3),
    ("viral_content", 0.2),
    ("high_activity", 0.15),
    ("established_user", -0.1),
)

# Reason texts.
REASONS = {
    "flags_reported": "[HIGH RISK] Content has been flagged %d time(s)",
    "comment_spam": "[HIGH RISK] Unusual comment activity (%d comments in 1 minute)",
    "unusual_engagement": "[HIGH RISK] High comment-to-view ratio (%s)",
    "bot_pattern": "[HIGH RISK] Suspicious pattern: %d comments but only %d views",
    "viral_content": "[MEDIUM RISK] Viral content (%s views/min) - may need review",
    "high_activity": "[MEDIUM RISK] High recent activity (score: %d)",
    "established_user": "[LOW RISK] Established user (%d images)",
}
QUIET = "[LOW RISK] Normal activity, no flags"
NOTHING = "No significant risk signals detected"


def recommendation(
    score: Column, settings: Settings = Settings(), threshold: float | None = None
) -> Column:
    return (
        F.when(score < settings.safe_below, "SAFE")
        .when(score < (threshold or settings.flag_from), "REVIEW")
        .otherwise("FLAG")
    )


def score_heuristic(
    df: DataFrame, settings: Settings = Settings(), threshold: float | None = None
) -> DataFrame:
    """Add moderation_probability, recommendation, reasoning and risk_factors.

    Only built-in expressions; rows are independent, so nothing is shuffled.
    """
    value = {
        name: (
            F.coalesce(F.col(name).cast("double"), F.lit(0.0))
            if name in df.columns
            else F.lit(0.0)
        )
        for name in RULE_INPUTS
    }
    whole = {name: v.cast("long") for name, v in value.items()}
    fires = {
        "flags_reported": value["total_flags"] > 0,
        "comment_spam": value["comments_1min"] > 10,
        "unusual_engagement": value["comment_to_view_ratio"] > 0.5,
        "bot_pattern": (value["total_comments"] > 50) & (value["total_views"] < 100),
        "viral_content": value["view_velocity_per_min"] > 20,
        "high_activity": value["recent_engagement_score"] > 100,
        "established_user": value["user_image_count"] > 10,
    }
    shown = {
        "flags_reported": [whole["total_flags"]],
        "comment_spam": [whole["comments_1min"]],
        "unusual_engagement": [fixed(value["comment_to_view_ratio"], 2)],
        "bot_pattern": [whole["total_comments"], whole["total_views"]],
        "viral_content": [fixed(value["view_velocity_per_min"], 1)],
        "high_activity": [whole["recent_engagement_score"]],
        "established_user": [whole["user_image_count"]],
    }

    # Added left to right in double, so that sums on a cut-off come out the same everywhere.
    score = F.lit(BASE)
    for key, weight in WEIGHTS:
        score = score + F.when(fires[key], F.lit(weight)).otherwise(F.lit(0.0))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))

    reasons = F.array_compact(
        F.array(
            *[
                F.when(fires[key], F.format_string(REASONS[key], *shown[key]))
                for key, _ in WEIGHTS
            ]
        )
    )
    quiet = (value["total_flags"] == 0) & (value["total_comments"] < 5)
    factors = F.map_filter(
        F.create_map(
            F.lit("base"),
            F.lit(BASE),
            *[
                part
                for key, weight in WEIGHTS
                for part in (F.lit(key), F.when(fires[key], F.lit(weight)))
            ],
        ),
        lambda _, v: v.isNotNull(),
    )
    return (
        df.withColumn("moderation_probability", score)
        .withColumn(
            "recommendation",
            recommendation(F.col("moderation_probability"), settings, threshold),
        )
        .withColumn("reasoning", reasons)
        .withColumn(
            "reasoning",
            F.when(F.size("reasoning") > 0, F.col("reasoning"))
            .when(quiet, F.array(F.lit(QUIET)))
            .otherwise(F.array(F.lit(NOTHING))),
        )
        .withColumn("risk_factors", factors)
    )


def ranked_factors(factors: Column | str = "risk_factors") -> Column:
    """Risk factors by size of contribution, largest first; ties keep their order."""
    entries = F.map_entries(factors)
    indexed = F.transform(
        entries,
        lambda e, i: F.struct((-F.abs(e["value"])).alias("rank"), i, e["key"], e["value"]),
    )
    return F.transform(
        F.array_sort(indexed), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    )


def explanation() -> Column:
    """Multi-line text of a scored row."""
    bar = "=" * 70
    score = fixed_half_even(F.col("moderation_probability"), 3)
    reasons = F.transform("reasoning", lambda r: F.concat(F.lit("  "), r))
    # Non-negative contributions carry two plus signs: the fixed format of these lines.
    factors = F.transform(
        ranked_factors(),
        lambda e: F.concat(
            F.format_string("  %-25s: ", e["key"]),
            F.when(e["value"] >= 0, "+").otherwise(""),
            F.format_string("%+.2f", e["value"]),
        ),
    )
    return F.array_join(
        F.concat(
            F.array(
                F.lit(bar),
                F.lit("MODERATION PREDICTION"),
                F.lit(bar),
                F.concat(F.lit("Probability: "), score),
                F.concat(F.lit("Recommendation: "), F.col("recommendation")),
                F.lit(""),
                F.lit("Reasoning:"),
            ),
            reasons,
            F.array(F.lit(""), F.lit("Risk Factor Contributions:")),
            factors,
            F.array(
                F.lit(""), F.concat(F.lit("Final Score: "), score), F.lit(bar)
            ),
        ),
        "\n",
    )


def fixed_half_even(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", F.bround(value.cast("decimal(38,18)"), digits).cast("double"))
