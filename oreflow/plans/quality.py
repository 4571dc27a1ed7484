"""The gates: which checks run on silver and on gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import prop
from oreflow.operators.checks import Check, is_any_null
from oreflow.operators.scd import NULL_KEY_SALTS
from oreflow.plans.increments import read_days
from oreflow.schemas import ORDER_STATUSES, RECONCILE_AFTER_MINUTES
from oreflow.sources.versioned import VersionedTable


def has_null_key() -> Column:
    return is_any_null("event_id", "event_ts", "session_id")


def is_purchase_without_order_id() -> Column:
    return (F.col("event_type") == "purchase") & prop("order_id").isNull()


def has_negative_total() -> Column:
    return F.col("total_amount") < 0


def unmatched_purchases(
    events: DataFrame,
    order_changes: DataFrame,
    now: Column | None = None,
    minutes: int = RECONCILE_AFTER_MINUTES,
) -> DataFrame:
    """Purchases older than ``minutes`` whose order never showed up as a change."""
    now = F.current_timestamp() if now is None else now
    oldest_allowed = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    purchases = events.where(
        (F.col("event_type") == "purchase") & (F.col("event_ts") < oldest_allowed)
    ).select("event_id", prop("order_id").alias("order_id"))
    wanted = purchases.withColumn("wanted", F.col("order_id").try_cast("bigint"))
    # Without an order id nothing matches. Such purchases may be many, so they
    # are spread by a salt that no known order has, instead of meeting on null.
    # One key of both: as a column of its own the constant salt of the known
    # orders would become a filter, and spread nothing.
    salt = F.when(F.col("wanted").isNull(), F.pmod(F.xxhash64("event_id"), F.lit(NULL_KEY_SALTS))).otherwise(-1)
    wanted = wanted.withColumn("_key", F.struct(
        F.coalesce("wanted", F.lit(0).cast("bigint")).alias("_wanted"), salt.cast("bigint").alias("_salt")))
    # Distinct first: an order with very many changes is one row after the map side.
    # There are as many rows as orders, so they are never broadcast, however small
    # the files of the feed make them look.
    known = order_changes.where("order_id is not null").select(F.struct(
        F.col("order_id").cast("bigint").alias("_wanted"), F.lit(-1).cast("bigint").alias("_salt"),
    ).alias("_key")).distinct().hint("merge")
    return wanted.join(known, "_key", "left_anti").select(*purchases.columns)


def silver_checks(
    events: DataFrame,
    orders_current: DataFrame,
    orders_history: DataFrame,
    now: Column | None = None,
) -> list[Check]:
    """The five assertions between silver and gold."""
    return [
        Check("duplicate event ids", events, "event_id", unique=True),
        Check("null event keys", events, "event_id", has_null_key()),
        Check("purchase without order id", events, "event_id", is_purchase_without_order_id()),
        Check("negative order totals", orders_current, "order_id", has_negative_total()),
        Check(
            "purchase without matching order",
            unmatched_purchases(events, orders_history, now),
            "event_id",
        ),
    ]


def increment_checks(
    tables: Mapping[str, VersionedTable], revenue_days: Sequence, fact_days: Sequence
) -> list[Check]:
    """Checks of the gold tables over the days and buckets of the last run."""
    revenue = read_days(tables["daily_revenue"], revenue_days)
    facts = tables["event_facts"].read(fact_days)
    checks = [
        Check("unique daily_revenue.order_date", revenue, "order_date", unique=True),
        Check("negative daily revenue", revenue, "order_date", F.col("revenue") < 0),
        Check("unique event_facts.event_id", facts, "event_id", unique=True),
        Check("event facts before their product version", facts, "event_id",
              F.col("product_valid_from") > F.col("event_ts")),
    ]
    for name, key in (("dim_products", "product_key"), ("dim_customers", "customer_key")):
        rows = tables[name].read()
        checks += [
            Check(f"unique {name}.{key}", rows, key, unique=True),
            Check(f"empty interval in {name}", rows, key, F.col("valid_to") <= F.col("valid_from")),
        ]
    return checks


def gold_checks(
    facts: DataFrame, products: DataFrame, customers: DataFrame, revenue: DataFrame
) -> list[Check]:
    """The column tests of the gold models."""
    checks = []
    for table, rows, unique, required in (
        ("fct_orders", facts, ["order_item_id"],
         ["order_item_id", "order_id", "product_id", "revenue"]),
        ("dim_product", products, ["product_id"], ["product_id"]),
        ("dim_customer", customers, ["customer_id"], ["customer_id"]),
        ("mart_daily_revenue", revenue, ["order_date"], ["order_date"]),
    ):
        checks += [Check(f"unique {table}.{c}", rows, c, unique=True) for c in unique]
        checks += [
            Check(f"not null {table}.{c}", rows, unique[0], F.col(c).isNull()) for c in required
        ]
    checks.append(Check(
        "accepted values fct_orders.order_status", facts, "order_status",
        ~F.col("order_status").isin(*ORDER_STATUSES),
    ))
    return checks
