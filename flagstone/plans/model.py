"""Logistic moderation model: preprocessing, distributed training, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.config import LABEL, MODEL_CATEGORICAL, MODEL_NUMERIC, Settings
from flagstone.functions.features import UNKNOWN
from flagstone.functions.scoring import recommendation

HASHED = 1 << 10  # columns that the categories are hashed to


def prepare(df: DataFrame, numeric_only: bool = False) -> DataFrame:
    """Missing numbers become 0, missing categories `Unknown`; categories become text."""
    columns = {
        name: F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        for name in MODEL_NUMERIC
    }
    if not numeric_only:
        columns |= {
            name: F.coalesce(F.col(name).cast("string"), F.lit(UNKNOWN))
            for name in MODEL_CATEGORICAL
        }
    return df.withColumns(columns)


def train(
    df: DataFrame,
    numeric_only: bool = False,
    regularization: float = 1e-4,
    max_iter: int = 50,
    label: str = LABEL,
) -> PipelineModel:
    """Fit scaler, encoder and classifier on all rows, distributed.

    `numeric_only` is the small variant: unscaled numeric features only.
    """
    rows = prepare(df, numeric_only).withColumn(label, F.col(label).cast("double"))
    numeric = VectorAssembler(inputCols=list(MODEL_NUMERIC), outputCol="numeric")
    if numeric_only:
        stages = [
            numeric,
            LogisticRegression(
                featuresCol="numeric",
                labelCol=label,
                regParam=regularization,
                maxIter=max_iter,
                standardization=False,
            ),
        ]
        return Pipeline(stages=stages).fit(rows)
    stages = [
        numeric,
        StandardScaler(
            inputCol="numeric", outputCol="scaled", withMean=True, withStd=True
        ),
        # Fixed width: no list of categories is gathered, however many there are.
        FeatureHasher(
            inputCols=list(MODEL_CATEGORICAL), outputCol="encoded", numFeatures=HASHED
        ),
        VectorAssembler(inputCols=["scaled", "encoded"], outputCol="inputs"),
        LogisticRegression(
            featuresCol="inputs",
            labelCol=label,
            regParam=regularization,
            maxIter=max_iter,
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def score_model(
    model: PipelineModel,
    df: DataFrame,
    settings: Settings = Settings(),
    version: int | None = None,
    numeric_only: bool = False,
) -> DataFrame:
    """Add moderation_probability, recommendation and model_version to feature rows."""
    replaced = [c for c in (*MODEL_NUMERIC, *MODEL_CATEGORICAL) if c in df.columns]
    keep = df.withColumn("_row", F.struct(*replaced))
    scored = model.transform(prepare(keep, numeric_only))
    probability = vector_to_array("probability")[1]
    others = [c for c in df.columns if c not in replaced]
    return scored.select(
        *others,
        "_row.*",
        probability.alias("moderation_probability"),
        recommendation(probability, settings).alias("recommendation"),
        F.lit(version).cast("int").alias("model_version"),
    )
