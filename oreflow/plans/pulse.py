"""Pulse checks: counts, statuses, newest rows, rates, lag, freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import micros, to_second
from oreflow.operators.windows import count_per_slot
from oreflow.plans.gold import paid
from oreflow.schemas import DLQ_MAX_PER_SECOND, DLQ_WINDOW_MINUTES, LAG_LIMIT, MONEY


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One row per table: its name and row count."""
    return _stack([
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias(label), "rows")
        for name, df in tables.items()
    ]).orderBy(label)


def rows_by_day(snapshots: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every loaded day of every snapshot table."""
    return _stack([
        df.groupBy("ds").agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "ds", "rows"
        )
        for name, df in snapshots.items()
    ])


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("order_status")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").cast(MONEY).alias("amount"))
        .orderBy("order_status")
    )


def last_orders(orders: DataFrame, n: int = 5) -> DataFrame:
    return orders.orderBy(F.desc("order_id")).limit(n).select(
        "order_id", "customer_id", "order_status", "total_amount",
        to_second(F.col("order_created_at")).alias("created_at"),
    )


def last_days(mart: DataFrame, n: int = 7) -> DataFrame:
    return mart.orderBy(F.desc("order_date")).limit(n)


def revenue_by_category(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders and revenue per product category, paid orders only.

    Lines meet their order first. Then they are combined per category and
    order, so an order counts once and no distinct is needed.
    """
    revenue = (F.col("quantity") * F.col("unit_price_at_purchase")).cast(MONEY)
    return (
        items.join(paid(orders).select("order_id"), "order_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "order_id")
        .agg(F.sum(revenue).alias("revenue"))
        .groupBy("category")
        .agg(F.count("order_id").alias("orders"), F.sum("revenue").cast(MONEY).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def trap_counts(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows a naive report gets wrong: changed prices and orphaned orders."""
    changed = products.where(F.col("updated_at") > F.col("created_at"))
    orphaned = orders.where(F.col("customer_id").isNull())
    return _stack([
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("trap"), "rows")
        for name, df in (("price changed since creation", changed), ("order without customer", orphaned))
    ])


def newest_per_table(tables: Mapping[str, tuple[DataFrame, str]], now: Column) -> DataFrame:
    """Newest event time of each table and its age in seconds at ``now``."""
    return _stack([
        df.agg(F.max(at).alias("newest")).select(F.lit(name).alias("table_name"), "newest")
        for name, (df, at) in tables.items()
    ]).withColumn("age_seconds", (micros(now) - micros(F.col("newest"))) / F.lit(1_000_000.0))


def dead_letter_rate(
    dead: DataFrame,
    at: str = "kafka_ts",
    minutes: int = DLQ_WINDOW_MINUTES,
    limit: float = DLQ_MAX_PER_SECOND,
) -> DataFrame:
    """Slots in which quarantine took in more than ``limit`` records a second."""
    rate = F.col("rows") / F.lit(minutes * 60.0)
    return (
        count_per_slot(dead, at, minutes)
        .withColumn("per_second", F.round(rate, 6))
        .where(rate > limit)
    )


def offset_lag(
    log: DataFrame, handled: DataFrame, limit: int = LAG_LIMIT, starts: DataFrame | None = None
) -> DataFrame:
    """Records of each topic that nothing has handled yet.

    ``handled`` holds the positions of landed and of quarantined records: a bad
    record at the end of a partition is not behind. A partition of which nothing
    was handled is behind from its first offset, which ``starts`` (topic,
    partition, offset) names; without it, the oldest record of ``log`` counts.
    """
    place = ["topic", "partition"]
    head = log.groupBy(*place).agg(F.max("offset").alias("head"), F.min("offset").alias("first"))
    if starts is not None:
        first = starts.select(*place, F.col("offset").alias("start"))
        head = head.join(first, place, "left").withColumn("first", F.coalesce("start", "first"))
    read = handled.groupBy(*place).agg(F.max("offset").alias("read"))
    behind = F.col("head") - F.coalesce(F.col("read"), F.col("first") - 1)
    return (
        head.join(read, place, "left")
        .groupBy("topic")
        .agg(F.sum(behind).alias("lag"))
        .withColumn("too_high", F.col("lag") > limit)
    )


def speed_against_batch(speed: DataFrame, batch: DataFrame, column: str = "events") -> DataFrame:
    """Per window: what the stream reported, what the batch found, the gap."""
    left = speed.select("window_start", F.col(column).alias("speed_value"))
    right = batch.select("window_start", F.col(column).alias("batch_value"))
    missing = F.coalesce(F.col("batch_value"), F.lit(0)) - F.coalesce(F.col("speed_value"), F.lit(0))
    return left.join(right, "window_start", "full_outer").select(
        "window_start", "speed_value", "batch_value", missing.alias("missing")
    )
