"""Tables of a lakehouse catalog, where one is configured on the session.

Such a catalog swaps, merges, compacts and expires by itself; these are the
calls. Parquet tables use ``sources.tables`` and ``plans.upkeep`` instead.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oreflow.operators.keyed import latest_change
from oreflow.schemas import (
    BRONZE_CDC,
    BRONZE_EVENTS,
    RETENTION_MIN_SNAPSHOTS,
    TARGET_FILE_BYTES,
)


def create_bronze(spark: SparkSession, catalog: str, table_format: str = "iceberg") -> None:
    """Bronze tables, partitioned by event day and by topic."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.bronze")
    for name, schema, split in (
        ("events", BRONZE_EVENTS, "days(event_ts)"),
        ("cdc_raw", BRONZE_CDC, "topic"),
    ):
        spark.sql(create_statement(f"{catalog}.bronze.{name}", schema, split, table_format))


def create_statement(name: str, schema: T.StructType, split: str, table_format: str) -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {table_format} PARTITIONED BY ({split})"
    )


def read_version(
    spark: SparkSession, name: str, version: int | None = None, at: datetime | None = None
) -> DataFrame:
    """A table as of a snapshot number or a point in time."""
    if (version is None) == (at is None):
        raise ValueError("name either a version or a time")
    if version is not None:
        return spark.sql(f"SELECT * FROM {name} VERSION AS OF {int(version)}")
    return spark.sql(f"SELECT * FROM {name} TIMESTAMP AS OF '{at:%Y-%m-%d %H:%M:%S}'")


def snapshots(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(f"{name}.snapshots")


def files(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(f"{name}.files")


def merge_statement(name: str, key: str, source: str) -> str:
    return (
        f"MERGE INTO {name} t USING {source} s ON s.{key} = t.{key} "
        "WHEN MATCHED AND s.changed_at >= t.changed_at AND s.op = 'd' THEN DELETE "
        "WHEN MATCHED AND s.changed_at >= t.changed_at THEN UPDATE SET * "
        "WHEN NOT MATCHED AND s.op <> 'd' THEN INSERT *"
    )


def merge_changes(history: DataFrame, name: str, key: str) -> None:
    """Apply a batch of changes to a current-state table: upserts and deletes.

    Only the newest change per key counts. Changes older than the stored row
    are ignored, so a batch can be applied again.
    """
    newest = latest_change(history, key)
    columns = newest.sparkSession.table(name).columns
    newest.sparkSession.sql(
        merge_statement(name, key, "{changes}"), changes=newest.select(*columns)
    )


def compact(spark: SparkSession, catalog: str, table: str) -> DataFrame:
    """Rewrite small files to the target size."""
    return spark.sql(compact_statement(catalog, table))


def compact_statement(catalog: str, table: str) -> str:
    return (
        f"CALL {catalog}.system.rewrite_data_files(table => '{table}', "
        f"options => map('target-file-size-bytes', '{TARGET_FILE_BYTES}'))"
    )


def expire(
    spark: SparkSession,
    catalog: str,
    table: str,
    older_than: datetime,
    keep: int = RETENTION_MIN_SNAPSHOTS,
) -> DataFrame | None:
    """Expire old snapshots; a table that does not exist is skipped."""
    if not spark.catalog.tableExists(f"{catalog}.{table}"):
        return None
    return spark.sql(expire_statement(catalog, table, older_than, keep))


def expire_statement(catalog: str, table: str, older_than: datetime, keep: int) -> str:
    return (
        f"CALL {catalog}.system.expire_snapshots(table => '{table}', "
        f"older_than => TIMESTAMP '{older_than:%Y-%m-%d %H:%M:%S}', retain_last => {keep})"
    )
