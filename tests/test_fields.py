"""The field registry: feeds that gain fields, and fields that change their type."""

from __future__ import annotations

import pytest

from oreflow.operators.checks import QualityGateError
from oreflow.plans import fields, jobs
from oreflow.schemas import CDC_TABLES
from oreflow.sources import marks
from tests.builders import cdc, change, event, events, order
from tests.conftest import rows

ORDERS = CDC_TABLES["orders"]


def feed_of(*images):
    return [change("orders", "c", "10:00", after=image, offset=i) for i, image in enumerate(images)]


def test_types_of_new_fields(spark, tmp_path):
    known = fields.registry(spark, str(tmp_path / "f"))
    images = [order(1) | {"n": "5", "x": "1.5", "b": "true", "t": "2024-03-01T10:00:00Z", "s": "5a", "o": {"a": 1}, "none": None},
              order(2) | {"n": "-7", "x": "2", "b": None, "t": "2024-03-01", "s": "", "o": [1]}]
    spec, checks = fields.register(known, cdc(spark, feed_of(*images)), ORDERS, "1")
    assert {f: t for f, t in spec.columns.items() if f not in ORDERS.columns} == {
        "n": "bigint", "x": "decimal(38,9)", "b": "boolean", "t": "timestamp", "s": "string", "o": "string"}
    assert list(spec.columns)[:len(ORDERS.columns)] == list(ORDERS.columns)
    assert checks[0].violations.count() == 0
    again, _ = fields.register(known, cdc(spark, feed_of(*images)), ORDERS, "1")
    assert again.columns == spec.columns and known.version().number == 1
    wider, checks = fields.register(known, cdc(spark, feed_of(order(1) | {"n": "x", "late": "1"})), ORDERS, "2")
    assert wider.columns["late"] == "bigint" and wider.columns["n"] == "bigint"
    assert rows(checks[0].violations, "field", "type", "unfit") == [("n", "bigint", 1)]
    assert rows(known.read().groupBy("version").count()) == [(1, 6), (2, 7)]
    assert rows(known.read().where("version = 2 and field in ('n', 'late')"), "field", "since") == [("late", "2"), ("n", "1")]


def test_a_feed_gains_a_field_and_then_changes_a_type(spark, tmp_path):
    root = str(tmp_path / "silver")
    feed = feed_of(order(1), order(2) | {"gift": "1"}, order(3) | {"gift": "2"}, order(4) | {"gift": "yes"},
                   order(5) | {"total_amount": "much"})
    clicks = events(spark, [event("a")])

    def run(n):
        return jobs.hourly_increment(spark, clicks, cdc(spark, feed[:n]), root, "salt", 4, widen=True)

    run(1)
    assert "gift" not in jobs.history(spark, root, "orders").columns
    run(2)
    run(3)
    assert rows(jobs.history(spark, root, "orders"), "order_id", "gift") == [(1, None), (2, 1), (3, 2)]
    before = marks.load(spark, f"{root}/marks")
    with pytest.raises(QualityGateError, match="changed type in orders.*gift"):
        run(4)
    assert marks.load(spark, f"{root}/marks") == before
    assert jobs.history(spark, root, "orders").count() == 3
    # The state keeps its fixed columns throughout.
    assert "gift" not in spark.read.parquet(f"{root}/orders_current").columns
    feed[3] = feed_of(order(4))[0]
    with pytest.raises(QualityGateError, match="total_amount"):
        run(5)
