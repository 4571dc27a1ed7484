"""Deduplication, change history, current state, merge, masking, drift."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from oreflow.operators import keyed
from oreflow.plans import silver
from oreflow.schemas import CDC_TABLES, SILVER_EVENT_COLUMNS
from tests.builders import cdc, change, event, events, order, tombstone
from tests.conftest import at, rows

ORDERS = CDC_TABLES["orders"]


def feed(spark):
    return cdc(spark, [
        change("orders", "r", "10:00", after=order(1), offset=1),
        change("orders", "u", "10:05", order(1), order(1, "paid", "12.50"), offset=2),
        change("orders", "u", "10:06", order(1, "paid"), order(1, "shipped", customer=None), offset=3),
        change("orders", "c", "10:00", after=order(2), offset=4),
        change("orders", "d", "10:09", before=order(2, "cancelled"), offset=5),
        tombstone("orders", "10:09", 6),
        change("orders", "c", "10:01", after=order(3), offset=7),
        change("orders", "u", "10:02", order(3), order(3, "paid"), offset=8),
        change("orders", "u", "10:02", order(3, "paid"), order(3, "shipped"), offset=9),
        change("orders", "u", "10:02", order(3, "paid"), order(3, "shipped"), offset=9),
        change("orders", "c", "10:03", after={**order(4), "total_amount": "lots"}, offset=10),
        change("products", "c", "10:00", after={"product_id": "1"}, offset=11),
    ])


def test_first_arrival_wins(spark):
    bronze = events(spark, [
        event("a", ingested="10:02", offset=1, session="late"),
        event("a", ingested="10:01", offset=9, session="first"),
        event("b", ingested="10:01", offset=5, session="second"),
        event("b", ingested="10:01", offset=4, session="first"),
        event("c", ingested="10:01", offset=4, partition=1, session="second"),
        event("c", ingested="10:01", offset=4, partition=0, session="first"),
    ])
    out = silver.silver_events(bronze)
    assert out.columns == SILVER_EVENT_COLUMNS
    assert rows(out, "event_id", "session_id") == [(k, "first") for k in "abc"]
    assert rows(silver.duplicate_rate(bronze)) == [(6, 3, 3)]


def test_history_keeps_every_change_once(spark):
    history = silver.cdc_history(feed(spark), ORDERS)
    assert [r.kafka_offset for r in history.orderBy("kafka_offset").collect()] == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    deleted = history.where("op = 'd'").first()
    assert (deleted.order_id, deleted.status) == (2, "cancelled")
    assert history.schema["total_amount"].dataType.simpleString() == "decimal(12,2)"


def test_null_stays_null_and_bad_number_becomes_null(spark):
    history = silver.cdc_history(feed(spark), ORDERS)
    assert history.where("kafka_offset = 3").first().customer_id is None
    assert history.where("kafka_offset = 2").first().total_amount == Decimal("12.50")
    assert history.where("order_id = 4").first().total_amount is None


def test_current_state(spark):
    current = silver.cdc_current(silver.typed_changes(feed(spark), ORDERS), ORDERS)
    assert rows(current, "order_id", "status") == [(1, "shipped"), (3, "shipped"), (4, "pending")]
    assert current.columns == [*ORDERS.columns, "op", "changed_at"]


def test_state_as_of(spark):
    history = silver.cdc_history(feed(spark), ORDERS)
    early = keyed.state_as_of(history, "order_id", F.lit("2024-03-01 10:05:00").cast("timestamp"))
    assert rows(early, "order_id", "status") == [
        (1, "paid"), (2, "pending"), (3, "shipped"), (4, "pending")
    ]


def test_merge_equals_rebuild(spark):
    history = silver.cdc_history(feed(spark), ORDERS)
    full = silver.cdc_current(history, ORDERS)
    for minute in ("09:00", "10:00", "10:02", "10:05", "10:30"):
        mark = F.lit(f"2024-03-01 {minute}:00").cast("timestamp")
        base = keyed.state_as_of(history, "order_id", mark).select(*full.columns)
        merged = keyed.merge_changes(base, history.where(F.col("changed_at") > mark), "order_id")
        assert rows(keyed.live_rows(merged)) == rows(full), minute


def test_merge_inserts_again_after_delete(spark):
    base = silver.cdc_current(silver.typed_changes(feed(spark), ORDERS), ORDERS)
    again = silver.typed_changes(
        cdc(spark, [change("orders", "c", "11:00", after=order(2, "paid"), offset=20)]), ORDERS
    )
    assert (2, "paid") in rows(keyed.merge_changes(base, again, "order_id"), "order_id", "status")


def test_latest_version(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (2, 0, "x")], "w int, v int, p string")
    assert rows(keyed.latest_version(df, ["w"], ["v"]), "w", "p") == [(1, "c"), (2, "x")]


def test_life_line(spark):
    line = silver.life_line(silver.cdc_history(feed(spark), ORDERS), "order_id", ["status"])
    assert [tuple(r) for r in line.where("order_id = 1").orderBy("changed_at").select(
        "status", "seconds_in_state").collect()] == [("pending", 300.0), ("paid", 60.0), ("shipped", None)]


def test_masking(spark):
    df = spark.createDataFrame([(1, "a@b.c", "Ann Lee"), (2, None, None)], "id int, email string, full_name string")
    out = {r.id: r for r in silver.masked_customers(df, "salt").collect()}
    assert len(out[1].email) == 64 and out[1].full_name == "A."
    assert out[2].email is None and out[2].full_name is None
    other = silver.masked_customers(df, "pepper").where("id = 1").first()
    assert other.email != out[1].email


def test_unknown_fields(spark):
    raw = cdc(spark, [
        change("orders", "c", "10:00", after={**order(1), "channel": "web"}, offset=1),
        change("orders", "d", "10:01", before={**order(1), "channel": "web", "x": 1}, offset=2),
        tombstone("orders", "10:01", 3),
        change("products", "c", "10:01", after={"other": 1}, offset=4),
    ])
    assert rows(silver.unknown_fields(raw, ORDERS)) == [("channel", 2), ("x", 1)]


def test_malformed_envelope_is_kept_in_history_only(spark):
    raw = cdc(spark, [change("orders", "c", "10:00", after=order(1), offset=1)])
    broken = raw.withColumn("value", F.lit("{oops")).withColumn("kafka_offset", F.lit(2).cast("long"))
    history = silver.cdc_history(raw.union(broken), ORDERS)
    assert history.count() == 2
    assert rows(silver.cdc_current(history, ORDERS), "order_id") == [(1,)]


def test_stale_rows_see_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "k int, s string")
    right = spark.createDataFrame([(1, "b"), (2, "x"), (3, "c"), (4, None)], "k int, s string")
    assert rows(silver.stale_rows(left, right, "k", "s")) == [(1, "a", "b"), (2, None, "x")]


def test_envelope_timestamps(spark):
    history = silver.cdc_history(feed(spark), ORDERS)
    first = history.where("kafka_offset = 1").first()
    assert first.changed_at == at("10:00").replace(tzinfo=None)
    assert first.created_at == dt.datetime(2024, 3, 1, 10)
    assert json.loads(feed(spark).first().value)["op"] == "r"
