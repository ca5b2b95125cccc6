"""Windows, thresholds, decision points and feature names, all in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Class names in class-index order, and the names of their one-hot columns.
CATEGORIES = (
    "Bread",
    "Dairy product",
    "Dessert",
    "Egg",
    "Fried food",
    "Meat",
    "Noodles/Pasta",
    "Rice",
    "Seafood",
    "Soup",
    "Vegetable/Fruit",
)
CATEGORY_COLUMNS = (
    "category_Bread",
    "category_Dairy",
    "category_Dessert",
    "category_Egg",
    "category_Fried",
    "category_Meat",
    "category_Noodles",
    "category_Rice",
    "category_Seafood",
    "category_Soup",
    "category_Veggie",
)

# The scalar features in vector order.
SCALAR_FEATURES = (
    "time_since_upload_seconds",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "views_5min",
    "views_1hr",
    "comments_5min",
    "comments_1hr",
    "view_velocity_per_min",
    "comment_to_view_ratio",
    "recent_engagement_score",
    "caption_length",
    "has_caption",
    "user_image_count",
    "user_age_days",
)
FEATURES = SCALAR_FEATURES + CATEGORY_COLUMNS

# The model treats the two 0/1 flags and the category as categories.
MODEL_CATEGORICAL = ("is_weekend", "has_caption", "category")
MODEL_NUMERIC = tuple(f for f in SCALAR_FEATURES if f not in MODEL_CATEGORICAL)
LABEL = "label_needs_moderation_24h"

TOPICS = ("views", "comments", "uploads", "flags")


@dataclass(frozen=True)
class Settings:
    """Every constant of the library. The defaults are the production values."""

    # Rolling windows in seconds; they fill the columns *_1min, *_5min and *_1hr.
    window_1min: int = 60
    window_5min: int = 300
    window_1hr: int = 3600

    # Tumbling bucket of the window tables, in seconds.
    bucket_seconds: int = 300

    # Alerts fire at or above these counts.
    viral_views_5min: int = 100
    suspicious_comments_1min: int = 10
    popular_views_1hr: int = 50
    milestones: tuple[int, ...] = (10, 100, 1000)

    # Training table.
    decision_points: tuple[int, ...] = (0, 5, 30)
    label_hours: int = 24
    comment_weight: int = 5

    # Recommendation cut-offs.
    safe_below: float = 0.3
    flag_from: float = 0.7

    # A key with more rows than this is split over several tasks.
    hot_rows: int = 2_000_000

    @property
    def rolling(self) -> tuple[tuple[str, int], ...]:
        return (
            ("1min", self.window_1min),
            ("5min", self.window_5min),
            ("1hr", self.window_1hr),
        )
