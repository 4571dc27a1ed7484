"""Small hand-made frames in the shapes of the layers."""

from __future__ import annotations

import json

from oreflow.schemas import BRONZE_CDC, BRONZE_EVENTS, CDC_TABLES, LOG_RECORD
from tests.conftest import at

HEADER = b"\x00\x00\x00\x00\x01"


def click(event_id, event_type="page_view", ts="10:00:00", session="s1", customer=1, **properties):
    return {
        "event_id": event_id, "event_type": event_type,
        "event_ts": int(at(ts).timestamp() * 1000), "session_id": session,
        "customer_id": customer, "device": {"type": "mobile", "os": "ios", "browser": "x"},
        "page_url": "/", "referrer": None, "properties": {k: str(v) for k, v in properties.items()},
    }


def wire(payload: dict) -> bytearray:
    return bytearray(HEADER + json.dumps(payload).encode())


def record(value, offset, arrival="10:00:00", key=b"k", topic="events", partition=0):
    return (
        None if key is None else bytearray(key),
        None if value is None else bytearray(value), topic, partition, offset, at(arrival),
    )


def records(spark, items):
    return spark.createDataFrame(items, LOG_RECORD)


def change(table, op, ts, before=None, after=None, offset=0, partition=0, **extra):
    body = {"before": before, "after": after, "op": op, "ts_ms": int(at(ts).timestamp() * 1000)}
    return (
        CDC_TABLES[table].topic, "k", json.dumps({**body, **extra}), partition, offset, at(ts), at(ts),
    )


def tombstone(table, ts, offset, partition=0):
    return (CDC_TABLES[table].topic, "k", None, partition, offset, at(ts), at(ts))


def cdc(spark, items):
    return spark.createDataFrame(items, BRONZE_CDC)


def order(order_id, status="pending", total="10.00", customer="7"):
    return {
        "order_id": str(order_id), "customer_id": customer, "status": status, "currency": "USD",
        "total_amount": total, "created_at": "2024-03-01T10:00:00.000000Z",
        "updated_at": "2024-03-01T10:00:00.000000Z",
    }


def event(event_id, event_type="page_view", ts="10:00:00", session="s1", customer=1,
          ingested="10:00:01", offset=0, partition=0, **properties):
    return (
        event_id, event_type, at(ts), session, customer, "mobile", "ios", "x", "/", None,
        {k: str(v) for k, v in properties.items()}, partition, offset, at(ingested), at(ingested),
    )


def events(spark, items):
    return spark.createDataFrame(items, BRONZE_EVENTS)
