"""Where streams keep checkpoints and staged tables: the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under `spark.checkpoint.dir`.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there.

    The copy is columnar, so readers prune columns and filters, and it outlives executors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name) + "/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
