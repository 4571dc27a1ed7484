"""Bronze: what arrived, plus where and when it arrived. Nothing is cleaned here.

Each function works on a bounded frame and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.wire import JSON, Payload, bad, decode_clicks, good


def _provenance(ingested_at: Column | None) -> list[Column]:
    return [
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_ts"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    ]


def bronze_events(decoded: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Valid click records, flattened."""
    plain = ("event_id", "event_type", "event_ts", "session_id", "customer_id")
    return good(decoded).select(
        *[F.col(f"e.{c}").alias(c) for c in plain],
        *[F.col(f"e.device.{c}").alias(f"device_{c}") for c in ("type", "os", "browser")],
        *[F.col(f"e.{c}").alias(c) for c in ("page_url", "referrer", "properties")],
        *_provenance(ingested_at),
    )


def valid_payloads(decoded: DataFrame) -> DataFrame:
    """The decoded structs of valid records, expanded to columns."""
    return good(decoded).select("e.*")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Invalid click records for the dead-letter topic, byte for byte."""
    return bad(decoded).select("key", "value")


def bronze_cdc(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Change records as text, untouched otherwise."""
    return records.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *_provenance(ingested_at),
    )


def dead_letters(records: DataFrame, archived_at: Column | None = None) -> DataFrame:
    """Records of the dead-letter topic as archive rows."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        "value",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_ts"),
        (F.current_timestamp() if archived_at is None else archived_at).alias("archived_at"),
    )


def split_counts(records: DataFrame, payload: Payload = JSON) -> DataFrame:
    """How many records pass the validity split, and how many do not."""
    return decode_clicks(records, payload).groupBy("is_valid").agg(F.count("*").alias("records"))
