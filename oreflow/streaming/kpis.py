"""Live figures: watermarked windows, late data, versioned output."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreflow.functions.columns import prop
from oreflow.functions.wire import JSON, Payload, decode_clicks
from oreflow.operators.keyed import latest_version
from oreflow.operators.windows import session_sketches, sessions_per, top_per_window, window_kpis
from oreflow.plans.bronze import valid_payloads
from oreflow.schemas import KPI_WATERMARK, KPI_WINDOW, SESSION_GAP_MINUTES
from oreflow.streaming.ingest import Run

BatchWriter = Callable[[DataFrame, int], None]
VERSION_FOLDERS = ("day", "run", "batch")


def live_events(clicks: DataFrame, payload: Payload = JSON) -> DataFrame:
    """Valid events of the click topic, watermarked by event time."""
    events = valid_payloads(decode_clicks(clicks, payload))
    return events.withWatermark("event_ts", KPI_WATERMARK)


def once_per_event(events: DataFrame) -> DataFrame:
    """Drop repeats of an event id that arrive within the watermark."""
    return events.dropDuplicatesWithinWatermark(["event_id"])


def _run_number(started: datetime | None) -> int:
    return int((started or datetime.now(timezone.utc)).timestamp() * 1_000_000)


def versioned_files(path: str, started: datetime | None = None) -> BatchWriter:
    """Batch writer that appends each batch as one version of its rows.

    A version is (start of the run, batch): a run that lost its checkpoint
    counts batches from 0 again, but starts later, so it neither overwrites
    earlier files nor loses against them. A batch that is run again within a
    run replaces its own files. Files lie under the day of their windows.
    """
    run = _run_number(started)

    def write(rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumns({
            "day": F.to_date("window_start"), "run": F.lit(run), "batch": F.lit(batch_id),
            "updated_at": F.current_timestamp(),
        })
        (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*VERSION_FOLDERS).parquet(path))

    return write


def versioned_rows(rows: DataFrame, run: int, batch_id: int) -> DataFrame:
    """Rows of a batch as one version, for a table that has no folders."""
    return rows.withColumns({
        "run": F.lit(run).cast("bigint"), "batch": F.lit(batch_id).cast("bigint"),
        "updated_at": F.current_timestamp(),
    })


def database_rows(
    url: str, table: str, properties: dict[str, str], started: datetime | None = None
) -> BatchWriter:
    """Batch writer that appends to a database table, from the executors.

    Rows carry (run, batch) as the files of ``versioned_files`` do, so a run that
    lost its checkpoint wins against earlier ones, and a batch that was written
    twice is read once (``keyed.latest_version``).
    """
    run = _run_number(started)

    def write(rows: DataFrame, batch_id: int) -> None:
        versioned_rows(rows, run, batch_id).write.mode("append").jdbc(url, table, properties=properties)

    return write


def read_versions(spark: SparkSession, *paths: str, since: date | None = None) -> DataFrame:
    """Every version in one or more folders; ``since`` prunes the days before it."""
    frames = []
    for path in paths:
        rows = spark.read.parquet(path)
        frames.append(rows.withColumns({
            "day": F.col("day").cast("date"), "run": F.col("run").cast("bigint"),
            "batch": F.col("batch").cast("bigint"),
        }))
    rows = reduce(DataFrame.unionByName, frames)
    return rows if since is None else rows.where(F.col("day") >= F.lit(since))


def fold_days(
    spark: SparkSession, path: str, closed: str, before: date, keys: Sequence[str] = ("window_start",)
) -> None:
    """Copy the newest versions of all days before ``before`` to ``closed``, one set per day.

    Folding again replaces the days. Readers that name both folders see the
    same rows before and after; the days can then go from ``path``.
    """
    old = read_versions(spark, path).where(F.col("day") < F.lit(before))
    (latest_version(old, keys, ["run", "batch"]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(closed))


def read_kpis(spark: SparkSession, *paths: str, since: date | None = None) -> DataFrame:
    """KPI rows with the newest version of each window."""
    rows = read_versions(spark, *paths, since=since)
    return latest_version(rows, ["window_start"], ["run", "batch"])


def run_kpis(
    clicks: DataFrame, write: BatchWriter, run: Run, payload: Payload = JSON, once: bool = False
) -> StreamingQuery:
    """Per-minute KPIs in update mode: late data sends its window again.

    With ``once`` repeats of an event count once. ``accounts`` then tells what was
    left out, so the figures can be reconciled with bronze.
    """
    events = live_events(clicks, payload)
    kpis = window_kpis(once_per_event(events) if once else events, KPI_WINDOW)
    writer = kpis.writeStream.outputMode("update").foreachBatch(write)
    return run.start(writer, "kpis")


def run_session_sketches(
    clicks: DataFrame, write: BatchWriter, run: Run, payload: Payload = JSON
) -> StreamingQuery:
    """Per-minute session sketches in update mode, to be counted by the hour or the day."""
    sketches = session_sketches(live_events(clicks, payload), KPI_WINDOW)
    writer = sketches.writeStream.outputMode("update").foreachBatch(write)
    return run.start(writer, "session_sketches")


def read_sessions(
    spark: SparkSession, *paths: str, width: str = "1 hour", since: date | None = None
) -> DataFrame:
    """Sessions per ``width`` from the newest version of each minute's sketch."""
    newest = latest_version(read_versions(spark, *paths, since=since), ["window_start"], ["run", "batch"])
    return sessions_per(newest, width)


def run_product_counts(
    clicks: DataFrame, write: BatchWriter, run: Run, payload: Payload = JSON
) -> StreamingQuery:
    """Events per minute and product in update mode.

    State ends with the watermark, so a ranking cannot be kept in the stream;
    it is taken when the totals are read (``read_top_products``).
    """
    counts = (
        live_events(clicks, payload)
        .withColumn("product_id", prop("product_id"))
        .where(F.col("product_id").isNotNull())
        .groupBy(F.window("event_ts", KPI_WINDOW).alias("w"), "product_id")
        .agg(F.count("*").alias("events"))
        .select(F.col("w.start").alias("window_start"), "product_id", "events")
    )
    return run.start(counts.writeStream.outputMode("update").foreachBatch(write), "product_counts")


def read_top_products(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """Leading products of every minute, from the newest version of each total."""
    totals = latest_version(
        read_versions(spark, path), ["window_start", "product_id"], ["run", "batch"])
    order = [F.desc("events"), F.asc("product_id")]
    return top_per_window(totals.drop(*VERSION_FOLDERS, "updated_at"), ["window_start"], order, n)


def session_stream(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Sessions by inactivity gap; each is emitted once, when the watermark passes it."""
    return (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id", F.session_window("event_ts", f"{gap_minutes} minutes").alias("w"))
        .agg(F.count("*").alias("events"))
        .select(
            "session_id",
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "events",
        )
    )


def run_sessions(
    clicks: DataFrame, path: str, run: Run, gap_minutes: int = SESSION_GAP_MINUTES,
    payload: Payload = JSON,
) -> StreamingQuery:
    rows = session_stream(live_events(clicks, payload), gap_minutes)
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return run.start(writer, "sessions")
