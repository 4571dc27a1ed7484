"""Upkeep: compaction, dead-letter archive and replay."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.wire import JSON, Payload, decode_clicks
from oreflow.plans.bronze import bronze_events
from oreflow.schemas import DLQ_ARCHIVE, TARGET_FILE_BYTES
from oreflow.sources.files import Files
from oreflow.sources.swaps import Watcher, quiet, replace_files, settle
from oreflow.sources.tables import file_inventory

POSITION = ["kafka_partition", "kafka_offset"]


def compact(
    rows: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    mode: str = "overwrite",
) -> int:
    """Rewrite many small files as few of about ``target_bytes``.

    ``rows`` is read from files; ``target`` is another folder. Returns the
    number of parts asked for. With partition columns the rebalance keeps each
    value together, but splits a value that holds most of the data.
    """
    size = file_inventory(rows).agg(F.sum("file_size")).first()[0] or 0
    parts = max(1, -(-int(size) // target_bytes))
    if partition_by:
        spread = rows.hint("rebalance", parts, *partition_by)
        spread.write.mode(mode).partitionBy(*partition_by).parquet(target)
    else:
        rows.repartition(parts).write.mode(mode).parquet(target)
    return parts


def compact_small_files(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    small: float = 0.75,
    watch: Watcher = quiet,
) -> dict[str, int]:
    """Merge the small files of each partition folder in place; large ones stay as they are.

    Small is below ``small`` of the target, and a folder needs two such files.
    A swap left by a job that died is settled first, and this one can die at
    any step: the next run finishes or undoes it, so no row is lost or doubled.
    Plain readers can meet the swap half-way; run it on closed partitions or
    read with ``read_settled``. Returns the files read and written.
    """
    settle(spark, path)
    files = file_inventory(spark.read.parquet(path)).where(
        F.col("file_size") < small * target_bytes).withColumn(
        "folder", F.regexp_extract("file_path", r"^(.*)/[^/]+$", 1))
    crowded = files.groupBy("folder").agg(F.count("*").alias("n")).where("n > 1")
    # File names only; the listing they come from lies on the driver as well.
    chosen = files.join(crowded, "folder").select("file_path", "file_size").collect()
    if not chosen:
        return {"read": 0, "written": 0}
    parts = max(1, -(-sum(r["file_size"] for r in chosen) // target_bytes))
    rows = spark.read.option("basePath", path).parquet(*[r["file_path"] for r in chosen])

    def write(aside: str) -> None:
        if partition_by:
            rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(aside)
        else:
            rows.repartition(parts).write.parquet(aside)

    folder = Files(spark, path)
    old = [folder.relative(r["file_path"]) for r in chosen]
    return {"read": len(old), "written": replace_files(spark, path, old, write, watch)}


def new_dead_letters(dead: DataFrame, archive: DataFrame | None) -> DataFrame:
    """Archive rows that are not archived yet, by log position."""
    return dead if archive is None else dead.join(archive.select(*POSITION), POSITION, "left_anti")


def archive_dead_letters(spark: SparkSession, dead: DataFrame, path: str) -> None:
    """Append what is new. Rows stay after the topic itself has forgotten them."""
    spark.createDataFrame([], DLQ_ARCHIVE).write.mode("append").parquet(path)
    # Only archive rows as young as the oldest record of the topic can match.
    oldest = dead.agg(F.min("kafka_ts")).scalar()
    archive = spark.read.schema(DLQ_ARCHIVE).parquet(path).where(F.col("kafka_ts") >= oldest)
    new_dead_letters(dead, archive).write.mode("append").parquet(path)


def _as_records(archive: DataFrame) -> DataFrame:
    return archive.select(
        F.col("key").cast("binary").alias("key"),
        "value",
        F.lit(None).cast("string").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_ts").alias("timestamp"),
    )


def replay(
    archive: DataFrame,
    repair: Callable[[DataFrame], DataFrame],
    landed_ids: DataFrame,
    payload: Payload = JSON,
) -> DataFrame:
    """Archived records decoded again after a fix, each with its outcome.

    Outcomes: ``recovered``, ``already landed`` (the event is in bronze), and
    ``still bad``. ``repair`` rewrites the log records before decoding.
    """
    decoded = decode_clicks(repair(_as_records(archive)), payload)
    landed = landed_ids.select("event_id").distinct().withColumn("landed", F.lit(True))
    outcome = (
        F.when(~F.col("is_valid"), "still bad")
        .when(F.col("landed"), "already landed")
        .otherwise("recovered")
    )
    # Invalid records have no id; a key of their own keeps them from piling up on null.
    own = F.concat_ws(":", F.lit("!"), "partition", "offset")
    keyed = decoded.withColumn(
        "event_id", F.when(F.col("is_valid"), F.col("e.event_id")).otherwise(own)
    )
    return keyed.join(landed, "event_id", "left").withColumn("outcome", outcome)


def replay_report(replayed: DataFrame) -> DataFrame:
    return replayed.groupBy("outcome").agg(F.count("*").alias("records"))


def recovered_events(replayed: DataFrame) -> DataFrame:
    """Bronze rows to append: what the replay recovered."""
    return bronze_events(replayed.where(F.col("outcome") == "recovered"))
