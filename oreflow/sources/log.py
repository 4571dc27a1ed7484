"""Message log: topics as streams or as bounded reads.

Broker topics need Spark's Kafka module on the session. Files holding the same
row shape (``schemas.LOG_RECORD``) stand in for it: archives, backfills, tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.schemas import LOG_RECORD

COLUMNS = LOG_RECORD.fieldNames()


def _subscription(topic: str | None, pattern: str | None) -> tuple[str, str]:
    if (topic is None) == (pattern is None):
        raise ValueError("name either one topic or one topic pattern")
    return ("subscribe", topic) if topic is not None else ("subscribePattern", pattern)


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    start: str = "earliest",
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Unbounded read of one topic, or of all topics matching a pattern.

    ``per_trigger`` bounds the records of one batch; without it a batch takes
    all there is. ``min_partitions`` splits a hot broker partition over several
    tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option(*_subscription(topic, pattern))
        .option("startingOffsets", start)
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select(*COLUMNS)


def topic_batch(
    spark: SparkSession, servers: str, topic: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Everything a topic still holds, as a bounded frame."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option(*_subscription(topic, pattern))
        .option("startingOffsets", "earliest")
        .load()
        .select(*COLUMNS)
    )


def _matching(records: DataFrame, topic: str | None, pattern: str | None) -> DataFrame:
    kind, value = _subscription(topic, pattern)
    if kind == "subscribe":
        return records.where(F.col("topic") == value)
    return records.where(F.col("topic").rlike(f"^(?:{value})$"))


def file_stream(
    spark: SparkSession,
    path: str,
    topic: str | None = None,
    pattern: str | None = None,
    files_per_trigger: int | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Unbounded read of log files. ``since`` is the start position by arrival time."""
    reader = spark.readStream.schema(LOG_RECORD)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    records = _matching(reader.parquet(path), topic, pattern)
    return records if since is None else records.where(F.col("timestamp") >= since)


def file_batch(
    spark: SparkSession, path: str, topic: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Bounded read of log files."""
    return _matching(spark.read.schema(LOG_RECORD).parquet(path), topic, pattern)
