"""What streams leave out: rows behind the watermark and repeats, kept per batch.

Spark counts both in the progress of every batch. A listener stores the counts,
one small file for each batch of each run, so the figures of a stream can be
reconciled with the rows in bronze.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from oreflow.sources.files import Files

ACCOUNT = "query string, run string, batch bigint, read bigint, late bigint, repeats bigint"


class Accounts(StreamingQueryListener):
    """Stores (query, run, batch, read, late, repeats) under ``path``.

    ``late`` are rows that a deduplication or another row-wise stateful step
    dropped because the watermark had passed them; behind an aggregation alone
    Spark counts rows that were combined before. ``repeats`` are rows dropped as
    duplicates. A batch that reports again is stored once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        row = {
            "query": progress.name, "run": str(progress.runId), "batch": progress.batchId,
            "read": progress.numInputRows,
            "late": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
            "repeats": sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in progress.stateOperators),
        }
        try:
            self.files.write_new(f"{progress.name}-{progress.runId}-{progress.batchId}.json", json.dumps(row))
        except FileExistsError:
            pass


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACCOUNT).json(path)


def reconciled(accounts: DataFrame, counted: DataFrame, bronze: DataFrame, query: str) -> DataFrame:
    """One row: events the stream counted, dropped late, dropped as repeats, and bronze rows.

    ``counted`` is the newest version of each window with its ``events``. All is
    accounted for when ``unexplained`` is 0. A batch that a restarted run did again
    counts as the last run reported it.
    """
    last = accounts.where(F.col("query") == query).groupBy("batch").agg(
        F.max_by(F.struct("late", "repeats"), F.col("read")).alias("x"))
    left = last.agg(F.coalesce(F.sum("x.late"), F.lit(0)).alias("late"),
                    F.coalesce(F.sum("x.repeats"), F.lit(0)).alias("repeats"))
    whole = counted.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("counted"))
    rows = bronze.agg(F.count("*").alias("bronze_rows"))
    # One row each.
    both = left.withColumns({"counted": whole.select("counted").scalar(), "bronze_rows": rows.select("bronze_rows").scalar()})
    return both.select("counted", "late", "repeats", "bronze_rows", (
        F.col("bronze_rows") - F.col("counted") - F.col("late") - F.col("repeats")).alias("unexplained"))
