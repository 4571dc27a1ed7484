"""Staging, dimensions, facts, marts, pulse checks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from oreflow.functions.columns import sku, to_second
from oreflow.plans import gold, pulse
from oreflow.schemas import SNAPSHOTS
from tests.conftest import at, rows


def snap(spark, table, data):
    return spark.createDataFrame(data, SNAPSHOTS[table])


def orders(spark):
    t1, t2 = at("10:00"), at("23:59:59")
    return snap(spark, "orders", [
        (1, 7, "pending", "USD", 10.0, t1, t1, "2024-03-01"),
        (1, 7, "paid", "USD", 10.1, t1, t2, "2024-03-02"),
        (2, None, "shipped", "USD", 20.25, t2, t2, "2024-03-02"),
        (3, 8, "cancelled", "USD", 5.0, t1, t1, "2024-03-02"),
    ])


def items(spark):
    return snap(spark, "order_items", [
        (1, 1, 100, 2, 5.05, "2024-03-02"), (2, 1, 101, 1, 0.1, "2024-03-02"),
        (3, 2, 100, 3, 6.75, "2024-03-02"), (4, 3, 100, 1, 5.0, "2024-03-02"),
        (5, 99, 100, 1, 5.0, "2024-03-02"), (6, 1, 100, 9, 9.0, "2024-03-01"),
    ])


def test_staging_takes_the_newest_day(spark):
    staged = gold.stg_orders(orders(spark))
    assert rows(staged, "order_id", "order_status") == [(1, "paid"), (2, "shipped"), (3, "cancelled")]
    assert staged.schema["total_amount"].dataType.simpleString() == "decimal(18,2)"
    earlier = gold.stg_orders(orders(spark), "2024-03-01")
    assert rows(earlier, "order_id", "order_status") == [(1, "pending")]


def test_facts_and_marts(spark):
    i, o = gold.stg_order_items(items(spark)), gold.stg_orders(orders(spark))
    facts = gold.fct_orders(i, o)
    assert rows(facts, "order_item_id", "revenue") == [
        (1, Decimal("10.10")), (2, Decimal("0.10")), (3, Decimal("20.25")), (4, Decimal("5.00"))
    ]
    day = at("10:00").date()
    expected = [(day, 2, 6, Decimal("30.45"))]
    assert rows(gold.daily_revenue(i, o)) == expected
    assert rows(gold.daily_revenue_from_facts(facts)) == expected
    assert rows(gold.product_performance(facts), "product_id", "units_sold", "orders") == [
        (100, 5, 2), (101, 1, 1)
    ]
    products = spark.createDataFrame([(100, "a"), (101, "b")], "product_id long, category string")
    assert rows(pulse.revenue_by_category(o, i, products)) == [
        ("a", 2, Decimal("30.35")), ("b", 1, Decimal("0.10"))
    ]


def test_other_staging_models(spark):
    t = at("10:00")
    payments = snap(spark, "payments", [(1, 1, "card", "captured", 10.1, t, "2024-03-02")])
    assert gold.stg_payments(payments).columns == [
        "payment_id", "order_id", "payment_method", "payment_status", "amount", "payment_created_at"
    ]
    products = snap(spark, "products", [(1, "s", "n", "c", "sc", 1.5, True, t, t, "2024-03-02")])
    assert rows(gold.dim_product(gold.stg_products(products))) == [
        (1, "s", "n", "c", "sc", Decimal("1.50"), True)
    ]
    customers = snap(spark, "customers", [(7, "e", "n", "DE", True, t, t, "2024-03-02")])
    dim = gold.dim_customer(gold.stg_customers(customers))
    assert rows(dim, "customer_id", "country_code") == [(7, "DE")]
    erased = gold.facts_without_customer(gold.stg_orders(orders(spark)), dim)
    assert rows(erased, "order_id") == [(2,), (3,)]


def test_dim_date_covers_all_days(spark):
    df = spark.createDataFrame([(at("2023-12-30 10:00:00"),), (at("2024-01-02 01:00:00"),)], "t timestamp")
    out = gold.dim_date(df, "t").orderBy("date_key").collect()
    assert [r.date_key for r in out] == [20231230, 20231231, 20240101, 20240102]
    assert [r.iso_weekday for r in out] == [6, 7, 1, 2] and [r.is_weekend for r in out][1:3] == [True, False]


def test_pulse(spark):
    o = gold.stg_orders(orders(spark))
    assert rows(pulse.orders_by_status(o), "order_status", "orders") == [
        ("cancelled", 1), ("paid", 1), ("shipped", 1)
    ]
    assert [r.order_id for r in pulse.last_orders(o, 2).collect()] == [3, 2]
    assert rows(pulse.rows_by_day({"orders": orders(spark)})) == [
        ("orders", "2024-03-01", 1), ("orders", "2024-03-02", 3)
    ]
    empty = o.where("false")
    assert rows(pulse.row_counts({"a": o, "b": empty})) == [("a", 3), ("b", 0)]


def test_offset_lag_counts_unread_partitions(spark):
    schema = "topic string, partition int, offset long"
    log = spark.createDataFrame([("t", 0, 9), ("t", 1, 4), ("u", 0, 1)], schema)
    landed = spark.createDataFrame([("t", 0, 7), ("u", 0, 1)], schema)
    starts = spark.createDataFrame([("t", 0, 0), ("t", 1, 0), ("u", 0, 0)], schema)
    behind = pulse.offset_lag(log, landed, limit=6, starts=starts)
    assert rows(behind) == [("t", 7, True), ("u", 0, False)]
    # Without a start, an unread partition begins at its oldest record.
    assert rows(pulse.offset_lag(log, landed, limit=6)) == [("t", 3, False), ("u", 0, False)]


def test_rounding_to_seconds(spark):
    df = spark.sql("select timestamp '2024-01-01 00:00:00.5' a, timestamp '2024-01-01 00:00:00.499999' b")
    out = df.select(to_second(F.col("a")), to_second(F.col("b"))).first()
    assert [v.second for v in out] == [1, 0]


def test_sku_keeps_long_numbers(spark):
    df = spark.sql("select 'home' c, 'Titan' l, explode(array(7, 12345)) n")
    assert rows(df.select(sku(F.col("c"), F.col("l"), F.col("n")).alias("s"))) == [
        ("HOM-TIT-0007",), ("HOM-TIT-12345",)
    ]


def test_catalog_grid_numbers_without_gaps(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "x"), ("a", "x")], "category string, subcategory string")
    grid = gold.catalog_grid(df, ("P", "Q")).orderBy("number").collect()
    assert [r.number for r in grid] == [1, 2, 3, 4, 5, 6]
    assert [(r.category, r.subcategory, r.label) for r in grid][:3] == [
        ("a", "x", "P"), ("a", "x", "Q"), ("a", "y", "P")
    ]
