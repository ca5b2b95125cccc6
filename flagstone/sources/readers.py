"""Sources: message topics, database tables, snapshots, lake tables, image folders."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstone.config import TOPICS
from flagstone.functions.text import category_from_path
from flagstone.schemas import ENTITY_TABLES, ENVELOPE

ENVELOPE_FIELDS = tuple(ENVELOPE.names)


def _envelope(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in ENVELOPE])


def first_start(spark: SparkSession, checkpoint: str) -> int:
    """Microseconds of the first start with this checkpoint, kept in a table next to it."""
    path = f"{checkpoint.rstrip('/')}-start"
    now = int(datetime.now(timezone.utc).timestamp() * 1_000_000)
    table = spark.createDataFrame([(now,)], "start long").coalesce(1)
    table.write.mode("ignore").parquet(path)
    row = spark.read.schema(table.schema).parquet(path).first()
    if row is None:  # the first start broke off while it wrote
        table.write.mode("overwrite").parquet(path)
    return row["start"] if row else now


def stream_topics(
    spark: SparkSession,
    topics: Sequence[str] = TOPICS,
    servers: str | None = None,
    path: str | None = None,
    starting: str = "earliest",
    per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Subscribe to several topics as one stream of envelopes.

    With `servers` from a broker; with `path` from a folder of envelope files, where
    `per_trigger` limits files instead of offsets and `latest` means messages stamped
    from now on. Give the query's `checkpoint` with it: a restart then goes on from the first
    start, as a broker's offsets do; without it a restart drops what came in between.
    """
    if servers is not None:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
        )
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return _envelope(reader.load())
    reader = spark.readStream.schema(ENVELOPE)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    messages = reader.parquet(path).where(F.col("topic").isin(*topics))
    if starting == "latest":
        start = datetime.now(timezone.utc)
        if checkpoint:
            start = F.timestamp_micros(F.lit(first_start(spark, checkpoint)))
        messages = messages.where(F.col("timestamp") >= start)
    return messages


def stream_requests(
    spark: SparkSession,
    servers: str | None = None,
    path: str | None = None,
    topic: str = "moderation_requests",
    checkpoint: str | None = None,
) -> DataFrame:
    """Requests that arrive from now on; with `checkpoint`, from the first start with it."""
    return stream_topics(
        spark, [topic], servers=servers, path=path, starting="latest", checkpoint=checkpoint
    )


MESSAGE_INDEX = "file string, topic string, partition int, first timestamp, last timestamp, n long"


def _unindexed(messages: DataFrame, entries: DataFrame) -> set[str]:
    """Files of a folder that its index does not have; both lists are the folder's file names."""
    return set(messages.inputFiles()) - {r.file for r in entries.select("file").distinct().collect()}


def index_messages(spark: SparkSession, path: str, index: str) -> int:
    """Bring the index of a message folder up to date; returns the number of files added.

    One entry a file, topic and partition, with its first and last arrival. Only files that
    the index lacks are read. Files are taken as final, as message files are.
    """
    messages = spark.read.schema(ENVELOPE).parquet(path)
    spark.createDataFrame([], MESSAGE_INDEX).write.mode("append").parquet(index)
    new = sorted(_unindexed(messages, spark.read.schema(MESSAGE_INDEX).parquet(index)))
    if new:
        rows = spark.read.schema(ENVELOPE).option("basePath", path).parquet(*new)
        rows = rows.select(F.input_file_name().alias("file"), "topic", "partition", "timestamp")
        entries = rows.groupBy("file", "topic", "partition").agg(
            F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count("*").alias("n")
        )
        entries.write.mode("append").parquet(index)
    return len(new)


def read_topics_between(
    spark: SparkSession,
    start: datetime,
    end: datetime,
    topics: Sequence[str] = TOPICS,
    servers: str | None = None,
    path: str | None = None,
    index: str | None = None,
) -> DataFrame:
    """Bounded replay of messages that arrived in [start, end).

    A message is published after its event, so callers that select by event time add
    slack to `end` and filter exactly afterwards. With the `index` of a folder (`index_messages`) only
    files that can hold the range are opened, as a broker seeks offsets by time; files that are
    not indexed yet are read as well.
    """
    if servers is not None:
        reader = (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .option("startingTimestamp", int(start.timestamp() * 1000))
            .option("endingTimestamp", int(end.timestamp() * 1000))
            .option("startingOffsetsByTimestampStrategy", "latest")
        )
        return _envelope(reader.load())
    messages = spark.read.schema(ENVELOPE).parquet(path)
    if index is not None:
        entries = spark.read.schema(MESSAGE_INDEX).parquet(index)
        held = (F.col("first") < end) & (F.col("last") >= start) & F.col("topic").isin(*topics)
        within = {r.file for r in entries.where(held).select("file").distinct().collect()}
        files = sorted(within | _unindexed(messages, entries))
        messages = spark.createDataFrame([], ENVELOPE)
        if files:
            messages = spark.read.schema(ENVELOPE).option("basePath", path).parquet(*files)
    return (
        messages.where(F.col("topic").isin(*topics))
        .where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    )


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole database table, read in parallel slices of a numeric or time column."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", 10_000)
        .options(**dict(properties or {}))
    )
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_entities(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The latest snapshot of every entity table under a folder."""
    return {
        name: read_snapshot(spark, f"{root}/{name}/latest.parquet", schema)
        for name, schema in ENTITY_TABLES.items()
    }


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply a function to columnar batches; no task ever holds a whole partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)


def image_folder(spark: SparkSession, path: str) -> DataFrame:
    """Image files below a folder with the class label taken from the path; no bytes are read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    return files.withColumn("category", category_from_path(F.col("path")))
