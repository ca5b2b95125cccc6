"""Reads a generic event log (event_id, ts, user_id, event_type, props) as the data model.

signup events become uploads of an image; view, click and error events become views,
comments and flags on the user's latest image. Events before the first upload have no
image and are the rejected ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.config import CATEGORIES
from flagstone.operators.asof import attach_latest

KINDS = {"view": "view", "click": "comment", "error": "flag"}


def load_log(spark: SparkSession, root: str) -> DataFrame:
    """The event log with string ids and `ts` as an instant in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{root}/events.parquet").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "value",
        "props",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def users(log: DataFrame) -> DataFrame:
    return log.groupBy(F.col("user_id").alias("id")).agg(
        F.min("ts").alias("created_at")
    )


def images(log: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    return log.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.concat_ws("/", F.lit("store"), F.col("event_id")).alias("s3_url"),
        F.when(F.col("k") % 5 != 0, F.col("props")).alias("caption"),
        F.try_element_at(names, F.col("k") % 12 + 1).alias("category"),
        F.col("ts").alias("uploaded_at"),
    )


def attributed(log: DataFrame) -> DataFrame:
    """Views, comments and flags with the image they belong to (null if none yet)."""
    kind = F.coalesce(
        *[F.when(F.col("event_type") == k, v) for k, v in KINDS.items()]
    )
    facts = log.where(F.col("event_type").isin(*KINDS)).select(
        "event_id", kind.alias("event_type"), "user_id", "ts", "value", "k"
    )
    uploads = log.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("uploaded_at"), F.col("event_id").alias("image_id")
    )
    return attach_latest(facts, uploads, ["user_id"], "ts", "uploaded_at")


def engagement(log: DataFrame) -> DataFrame:
    """Accepted events only."""
    return attributed(log).where(F.col("image_id").isNotNull())


def by_user(log: DataFrame) -> DataFrame:
    """The same events with the user as the counted item, for busier timelines."""
    kind = F.coalesce(
        *[F.when(F.col("event_type") == k, v) for k, v in KINDS.items()]
    )
    return log.where(F.col("event_type").isin(*KINDS)).select(
        F.col("user_id").alias("image_id"), "event_id", kind.alias("event_type"), "ts"
    )
