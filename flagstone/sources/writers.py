"""Sinks: topics, snapshots, lake tables, keyed tables, CSV and model artefacts."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.operators.skew import restrict
from flagstone.sources.readers import read_database_table
from flagstone.sources.scratch import staged


def publish(
    messages: DataFrame, servers: str, compression: str = "gzip", acks: str = "1"
) -> None:
    """Send (topic, value) rows to a broker."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", compression)
        .option("kafka.acks", acks)
        .save()
    )


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def extract_tables(
    spark: SparkSession,
    url: str,
    tables: Sequence[str],
    out_dir: str,
    splits: dict[str, tuple[str, tuple[object, object]]] | None = None,
) -> None:
    """Copy database tables to snapshots; `splits` gives a table its column and bounds."""
    for table in tables:
        column, bounds = (splits or {}).get(table, (None, None))
        overwrite_snapshot(
            read_database_table(spark, url, table, column, bounds),
            f"{out_dir}/raw/{table}/latest.parquet",
        )


def _ensure_namespace(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def append_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    idempotent: bool = True,
) -> None:
    """Create the table if needed, then add rows.

    A partitioned table is written idempotently: the partitions present in `df` replace
    the old ones, so running the same hour twice leaves one copy.
    """
    spark = df.sparkSession
    _ensure_namespace(spark, table)
    if partition_by:
        # few files per partition; a partition too large for one task is split
        df = df.hint("rebalance", *partition_by)
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(table)
        return
    writer = df.select(*spark.table(table).columns).write
    if not (partition_by and idempotent):
        writer.mode("append").insertInto(table)
        return
    # insertInto takes the overwrite mode from the session, not from a write option
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        writer.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)


def replace_table(df: DataFrame, table: str) -> None:
    _ensure_namespace(df.sparkSession, table)
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def new_rows(
    df: DataFrame, existing: DataFrame | None, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key, the first by `order`, for keys that `existing` does not have."""
    rest = [c for c in df.columns if c not in (*key, *order)]
    first = (
        df.groupBy(*key)
        .agg(F.min(F.struct(*order, *rest)).alias("first"))
        .select(*key, "first.*")
        .select(*df.columns)
    )
    if existing is None:
        return first
    # Written once: it is read twice, and values such as random ids must not change between.
    first = staged(first, "new-rows")
    known = restrict(existing.select(*key), first, key)
    return first.join(known, list(key), "left_anti").select(*df.columns)


def insert_if_absent(
    df: DataFrame,
    path: str,
    key: Sequence[str] = ("image_id", "milestone_type", "milestone_value"),
    order: Sequence[str] = ("reached_at",),
) -> None:
    """Append the rows whose key is not in the table yet. Repeating a call adds nothing."""
    spark = df.sparkSession
    existing = (
        spark.read.schema(df.schema).parquet(path) if path_exists(spark, path) else None
    )
    new_rows(df, existing, key, order).write.mode("append").parquet(path)


def decision_rows(scored: DataFrame) -> DataFrame:
    """Decisions in table form, with id and creation time filled in."""
    return scored.select(
        F.uuid().alias("id"),
        "image_id",
        "inference_mode",
        "moderation_probability",
        "recommendation",
        F.col("trigger").alias("trigger_type"),
        F.current_timestamp().alias("created_at"),
    )


BASE = "base"  # the run id of compacted rows


def run_id(spark: SparkSession) -> str:
    """The id of the running stream: kept in its checkpoint, new with a new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def write_batch(
    df: DataFrame, path: str, batch_id: int, run: str | None = None
) -> str:
    """Write one micro-batch to a folder of its run and batch; a replay replaces it.

    Batch numbers start anew with a new checkpoint; the run id keeps such batches apart, and
    the start of a run is marked, so that readers know the newest one. Returns the folder.
    """
    run = run or run_id(df.sparkSession)
    if run not in runs(df.sparkSession, path):
        _files(df.sparkSession, f"{path}/_runs")[0].mkdirs(
            _files(df.sparkSession, f"{path}/_runs/{time.time_ns() // 1000:018d}-{run}")[1]
        )
    folder = f"{path}/run_id={run}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def _files(spark: SparkSession, path: str):
    """File system and location of a path."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def runs(spark: SparkSession, path: str) -> list[str]:
    """The runs that wrote batches to a folder, by their start; compacted rows come first."""
    system, location = _files(spark, f"{path}/_runs")
    if not system.exists(location):
        return []
    marks = sorted(status.getPath().getName() for status in system.listStatus(location))
    names = [mark.split("-", 1)[1] for mark in marks]
    return sorted(dict.fromkeys(names), key=lambda name: name != BASE)


def read_run(
    spark: SparkSession, path: str, schema: T.StructType | str, run: str | None = None
) -> DataFrame:
    """All batches of one run, the newest if none is named.

    For outputs that add up (counts, requests, decisions): after a reset, a stream with a new
    checkpoint reads its input again, and its rows take the place of the run before.
    """
    known = runs(spark, path)
    folders = [f"{path}/run_id={run or known[-1]}"] if run or known else []
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def put_latest(df: DataFrame, path: str, batch_id: int) -> None:
    """Add changed rows to a latest-state table. Nothing old is rewritten."""
    write_batch(df, path, batch_id)


def get_latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str | Sequence[str] = "image_id",
    order: Sequence[str] = ("ts",),
    prefix: str | None = None,
) -> DataFrame:
    """Current row of each key, optionally of keys whose first column starts with `prefix`.

    The choice is a maximum over a struct, combined before the shuffle. Of equal order values
    that of the run started last counts, and of its last batch.
    """
    key = [key] if isinstance(key, str) else list(key)
    place = ("_started", "batch_id")
    stored = T.StructType(
        [
            *schema.fields,
            T.StructField("run_id", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    rows = spark.read.schema(stored).option("basePath", path).parquet(path)
    started = F.array(*[F.lit(name) for name in runs(spark, path)]).cast("array<string>")
    rows = rows.withColumn("_started", F.array_position(started, F.col("run_id"))).drop("run_id")
    if prefix is not None:
        rows = rows.where(F.col(key[0]).startswith(prefix))
    rest = [c for c in rows.columns if c not in (*key, *order, *place)]
    return (
        rows.groupBy(*key)
        .agg(F.max(F.struct(*order, *place, *rest)).alias("last"))
        .select(*key, "last.*")
        .select(*schema.names)
    )


def compact_latest(
    spark: SparkSession, path: str, target: str, schema: T.StructType, **choose
) -> None:
    """Rewrite a latest-state table to one row per key in a new place; streams may go on there."""
    write_batch(get_latest(spark, path, schema, **choose), target, 0, run=BASE)


def append_csv(df: DataFrame, path: str) -> None:
    """Add rows as CSV files that each carry the header."""
    df.write.mode("append").option("header", True).csv(path)


def save_model(
    model: PipelineModel, root: str, version: int, algorithm: str = "LogisticRegression"
) -> dict[str, object]:
    """Store a model version, then move the pointer to it."""
    spark = SparkSession.getActiveSession()
    now = datetime.now(timezone.utc).isoformat()
    model.write().overwrite().save(f"{root}/version={version}")
    pointer = {
        "version": version,
        "trained_at": now,
        "updated_at": now,
        "algorithm": algorithm,
    }
    spark.createDataFrame([(json.dumps(pointer),)], "value string").coalesce(
        1
    ).write.mode("overwrite").text(f"{root}/metadata.json")
    return pointer


def load_latest_model(
    spark: SparkSession, root: str, known: dict[str, object] | None = None
) -> tuple[PipelineModel | None, dict[str, object] | None]:
    """The model the pointer names; (None, known) while it is missing or unchanged."""
    if not path_exists(spark, f"{root}/metadata.json/_SUCCESS"):
        return None, known
    pointer = json.loads(spark.read.text(f"{root}/metadata.json").first()["value"])
    if known and known["updated_at"] == pointer["updated_at"]:
        return None, known
    return PipelineModel.load(f"{root}/version={pointer['version']}"), pointer
