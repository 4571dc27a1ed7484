"""Wire format of the click topic: one zero byte, a 4-byte schema id, the payload."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.schemas import CLICK_PAYLOAD

HEADER_BYTES = 5


@dataclass(frozen=True)
class Payload:
    """Format of the bytes behind the header; Avro needs its reader schema."""

    format: str = "json"
    schema: str | None = None


JSON = Payload()


def has_header(value: Column) -> Column:
    """True when the first byte is zero; never null, so a tombstone is false."""
    return F.coalesce(F.substring(value, 1, 1) == F.lit(bytearray(b"\x00")), F.lit(False))


def body(value: Column) -> Column:
    """The payload bytes behind the header."""
    return F.substring(value, HEADER_BYTES + 1, 2**31 - 1)


def add_header(payload: Column, schema_id: int = 1) -> Column:
    """Put the header in front of payload bytes."""
    return F.concat(F.lit(bytearray(b"\x00" + schema_id.to_bytes(4, "big"))), payload)


_WRAPPED = T.StructType([
    T.StructField("rows", T.ArrayType(CLICK_PAYLOAD)), T.StructField("broken", T.StringType()),
])


def _parse(value: Column, payload: Payload) -> Column:
    """The decoded struct; null where the payload is not exactly one readable record.

    JSON is parsed inside an envelope that has to close again. A payload that
    was cut anywhere, that holds a value of another type, or that goes on
    behind its record, breaks the envelope and is not accepted in parts.
    """
    if payload.format == "json":
        text = F.concat(F.lit('{"rows":['), body(value).cast("string"), F.lit("]}"))
        return F.from_json(
            text, _WRAPPED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    if payload.format == "avro":
        # The codec is a separate Spark module; the session must have loaded it.
        from pyspark.sql.avro.functions import from_avro

        if payload.schema is None:
            raise ValueError("an avro payload needs its reader schema")
        return from_avro(body(value), payload.schema, {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format: {payload.format}")


def decode_clicks(records: DataFrame, payload: Payload = JSON) -> DataFrame:
    """Add ``e`` (decoded struct) and ``is_valid`` (never null) to log records.

    The parse goes through a one-row generator on purpose: filters on ``e``
    cannot be pushed below it, so every payload is parsed exactly once.
    """
    parsed = _parse(F.col("value"), payload)
    decoded = records.select("*", F.explode_outer(F.array(parsed)).alias("e"))
    if payload.format == "json":
        whole = F.col("e.broken").isNull() & (F.size("e.rows") == 1)
        decoded = decoded.withColumn("e", F.when(whole, F.col("e.rows")[0]))
        decoded = decoded.withColumn(
            "e", F.col("e").withField("event_ts", F.timestamp_millis("e.event_ts"))
        )
    valid = has_header(F.col("value")) & F.col("e.event_id").isNotNull()
    return decoded.withColumn("is_valid", valid)


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where("is_valid")


def bad(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("is_valid"))
