import pytest
from pyspark.sql import functions as F

from flagstone.config import FEATURES
from flagstone.functions import features as fx
from flagstone.functions.scoring import RULE_INPUTS, explanation, score_heuristic


def score(spark, threshold=None, **values):
    names = list(values) or ["x"]
    df = spark.createDataFrame([tuple(float(v) for v in values.values()) or (0.0,)], names)
    return score_heuristic(df, threshold=threshold).withColumn("text", explanation()).first()


@pytest.mark.parametrize(
    "values, probability, recommendation",
    [
        ({}, 0.3, "REVIEW"),
        ({"view_velocity_per_min": 30, "recent_engagement_score": 190}, 0.65, "REVIEW"),
        ({"comment_to_view_ratio": 0.75}, 0.5, "REVIEW"),
        ({"comment_to_view_ratio": 0.75, "comments_1min": 15}, 0.8, "FLAG"),
        ({"total_flags": 2}, 0.7, "FLAG"),
        ({"comments_1min": 10}, 0.3, "REVIEW"),
        ({"comments_1min": 11}, 0.6, "REVIEW"),
        ({"comment_to_view_ratio": 0.5}, 0.3, "REVIEW"),
        ({"total_comments": 51, "total_views": 99}, 0.6, "REVIEW"),
        ({"total_comments": 51, "total_views": 100}, 0.3, "REVIEW"),
        ({"total_comments": 50, "total_views": 0}, 0.3, "REVIEW"),
        ({"view_velocity_per_min": 20, "recent_engagement_score": 100}, 0.3, "REVIEW"),
        ({"user_image_count": 10}, 0.3, "REVIEW"),
        ({"user_image_count": 11}, 0.2, "SAFE"),
        ({"comment_to_view_ratio": 1, "view_velocity_per_min": 21}, 0.7, "FLAG"),
        (dict.fromkeys(RULE_INPUTS, 60), 1.0, "FLAG"),
    ],
)
def test_rules(spark, values, probability, recommendation):
    row = score(spark, **values)
    assert row.moderation_probability == pytest.approx(probability)
    assert row.recommendation == recommendation


def test_threshold(spark):
    assert score(spark, threshold=0.6, comments_1min=11).recommendation == "FLAG"
    assert score(spark, threshold=0, comments_1min=11).recommendation == "REVIEW"


def test_reasons_and_factors(spark):
    assert score(spark).reasoning == ["[LOW RISK] Normal activity, no flags"]
    assert score(spark, total_comments=5).reasoning == ["No significant risk signals detected"]
    row = score(spark, comment_to_view_ratio=0.625, user_image_count=12)
    assert row.reasoning == [
        "[HIGH RISK] High comment-to-view ratio (0.62)",
        "[LOW RISK] Established user (12 images)",
    ]
    assert row.risk_factors == {"base": 0.3, "unusual_engagement": 0.2, "established_user": -0.1}


def test_explanation(spark):
    lines = score(spark, total_flags=1, user_image_count=20).text.split("\n")
    assert lines[3:5] == ["Probability: 0.600", "Recommendation: REVIEW"]
    assert lines[-7:-2] == [
        "Risk Factor Contributions:",
        "  flags_reported           : ++0.40",
        "  base                     : ++0.30",
        "  established_user         : -0.10",
        "",
    ]


def test_feature_vector(spark):
    values = {f: float(i) for i, f in enumerate(FEATURES[:15])} | {"category": " Rice "}
    values["views_1hr"] = float("nan")
    values["user_age_days"] = float("-inf")
    row = fx.feature_vector(spark.createDataFrame([tuple(values.values())], list(values))).first()
    vector = row.features.toArray()
    assert len(vector) == 26
    assert vector[5] == 0 and vector[14] == -1e6
    assert vector[15:].tolist() == [0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    with pytest.raises(ValueError):
        fx.feature_vector(spark.createDataFrame([(1, "Rice")], ["views_5min", "category"]))


def test_captions(spark):
    df = spark.createDataFrame([(None, 0, 0), ("", 0, 0), ("né🍞", 3, 1)], "c string, n int, has int")
    wrong = df.where((fx.caption_length(F.col("c")) != F.col("n")) | (fx.has_caption(F.col("c")) != F.col("has")))
    assert wrong.count() == 0
