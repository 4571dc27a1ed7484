"""Continuous ingest: clicks and changes to bronze, bad clicks to quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from oreflow.functions.wire import JSON, Payload, decode_clicks
from oreflow.plans.bronze import bronze_cdc, bronze_events, quarantine
from oreflow.schemas import TRIGGER_INTERVAL
from oreflow.session import checkpoint_dir


@dataclass(frozen=True)
class Run:
    """How often a query runs, and where it keeps its progress.

    ``interval=None`` works off everything available and stops.
    """

    checkpoint_root: str
    interval: str | None = TRIGGER_INTERVAL

    @classmethod
    def of_session(
        cls, spark: SparkSession, application: str, interval: str | None = TRIGGER_INTERVAL
    ) -> Run:
        """Progress under the shared checkpoint folder of the session."""
        return cls(f"{checkpoint_dir(spark)}/{application}", interval)

    def start(self, writer: DataStreamWriter, name: str) -> StreamingQuery:
        writer = writer.option("checkpointLocation", f"{self.checkpoint_root}/{name}")
        if self.interval is None:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.interval)
        return writer.queryName(name).start()


def land_events(clicks: DataFrame, path: str, run: Run, payload: Payload = JSON) -> StreamingQuery:
    """Valid clicks to bronze files, one folder per event day."""
    rows = bronze_events(decode_clicks(clicks, payload)).withColumn(
        "event_date", F.to_date("event_ts")
    )
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return run.start(writer.partitionBy("event_date"), "events")


def land_quarantine(clicks: DataFrame, path: str, run: Run, payload: Payload = JSON) -> StreamingQuery:
    """Invalid clicks to files, with their log position; bytes stay as they are."""
    rows = decode_clicks(clicks, payload).where(~F.col("is_valid")).drop("e", "is_valid")
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return run.start(writer, "quarantine")


def send_quarantine(
    clicks: DataFrame, servers: str, topic: str, run: Run, payload: Payload = JSON
) -> StreamingQuery:
    """Invalid clicks to the dead-letter topic of a broker."""
    writer = (
        quarantine(decode_clicks(clicks, payload))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
    return run.start(writer, "quarantine")


def land_changes(changes: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Change records of all tables to bronze files, one folder per topic."""
    writer = (
        bronze_cdc(changes)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy("topic")
    )
    return run.start(writer, "changes")


def land_in_catalog(
    rows: DataFrame, table: str, run: Run, name: str, table_format: str
) -> StreamingQuery:
    """Append any bronze frame to a table of a lakehouse catalog."""
    writer = (
        rows.writeStream.outputMode("append")
        .format(table_format)
        .option("checkpointLocation", f"{run.checkpoint_root}/{name}")
        .queryName(name)
    )
    if run.interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=run.interval)
    return writer.toTable(table)


def run_ingest(
    clicks: DataFrame, changes: DataFrame, bronze_root: str, run: Run, payload: Payload = JSON
) -> list[StreamingQuery]:
    """Start the three queries of the ingest application."""
    return [
        land_events(clicks, f"{bronze_root}/events", run, payload),
        land_quarantine(clicks, f"{bronze_root}/quarantine", run, payload),
        land_changes(changes, f"{bronze_root}/cdc_raw", run),
    ]


def wait(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Block until all are done; the first failure stops the others and is raised."""
    while any(q.isActive for q in queries):
        try:
            spark.streams.awaitAnyTermination()
        except Exception:
            for query in queries:
                query.stop()
            raise
        spark.streams.resetTerminated()
    for query in queries:
        failure = query.exception()
        if failure is not None:
            raise failure
