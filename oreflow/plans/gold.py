"""Gold: staging models, dimensions, facts and marts.

Models are functions from frames to frames. Whether a model is a view or a
table is decided where it is used (``publish_view`` or ``replace_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.columns import money, prop
from oreflow.operators.ordered import Slicing
from oreflow.operators.scd import NULL_KEY_SALTS, asof_join, scd2
from oreflow.operators.windows import top_per_window
from oreflow.schemas import MONEY, PAID_STATUSES


# ---------------------------------------------------------------------------
# Staging: newest snapshot, renamed and typed
# ---------------------------------------------------------------------------
def latest_snapshot(snapshots: DataFrame, ds: str | None = None) -> DataFrame:
    """Rows of the newest day, or of a given day.

    Every table has its own newest day; pass one ``ds`` to all models to keep a
    partly loaded day out.
    """
    if ds is not None:
        return snapshots.where(F.col("ds") == ds)
    return snapshots.where(F.col("ds") == snapshots.select(F.max("ds")).scalar())


def stg_orders(snapshots: DataFrame, ds: str | None = None) -> DataFrame:
    return latest_snapshot(snapshots, ds).select(
        "order_id",
        "customer_id",
        F.col("status").alias("order_status"),
        "currency",
        money(F.col("total_amount")).alias("total_amount"),
        F.col("created_at").alias("order_created_at"),
        F.col("updated_at").alias("order_updated_at"),
    )


def stg_order_items(snapshots: DataFrame, ds: str | None = None) -> DataFrame:
    return latest_snapshot(snapshots, ds).select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        money(F.col("unit_price_at_purchase")).alias("unit_price_at_purchase"),
    )


def stg_products(snapshots: DataFrame, ds: str | None = None) -> DataFrame:
    """``current_unit_price`` is today's price, not the price of past orders."""
    return latest_snapshot(snapshots, ds).select(
        "product_id",
        "sku",
        F.col("name").alias("product_name"),
        "category",
        "subcategory",
        money(F.col("unit_price")).alias("current_unit_price"),
        "is_active",
    )


def stg_customers(snapshots: DataFrame, ds: str | None = None) -> DataFrame:
    return latest_snapshot(snapshots, ds).select(
        "customer_id",
        "email",
        "full_name",
        "country_code",
        "marketing_opt_in",
        F.col("created_at").alias("customer_created_at"),
    )


def stg_payments(snapshots: DataFrame, ds: str | None = None) -> DataFrame:
    return latest_snapshot(snapshots, ds).select(
        "payment_id",
        "order_id",
        F.col("method").alias("payment_method"),
        F.col("status").alias("payment_status"),
        money(F.col("amount")).alias("amount"),
        F.col("created_at").alias("payment_created_at"),
    )


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------
PRODUCT_TRACKED = ("sku", "name", "category", "subcategory", "unit_price", "is_active")
CUSTOMER_TRACKED = ("email", "full_name", "country_code", "marketing_opt_in")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "sku", "product_name", "category", "subcategory",
        "current_unit_price", "is_active",
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    """Erased customers are simply absent; their facts keep the id."""
    return customers.select(
        "customer_id", "email", "full_name", "country_code", "marketing_opt_in",
        "customer_created_at",
    )


def dim_product_scd2(
    history: DataFrame, slicing: Slicing = Slicing(), measure: DataFrame | None = None
) -> DataFrame:
    return scd2(history, "product_id", PRODUCT_TRACKED, "product_key", slicing, measure)


def dim_customer_scd2(
    history: DataFrame, slicing: Slicing = Slicing(), measure: DataFrame | None = None
) -> DataFrame:
    return scd2(history, "customer_id", CUSTOMER_TRACKED, "customer_key", slicing, measure)


def dim_date(rows: DataFrame, at: str) -> DataFrame:
    """One row per calendar day between the first and the last ``at``."""
    day = F.to_date(at)
    span = rows.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("date")).select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        (F.weekday("date") + 1).alias("iso_weekday"),
        F.weekofyear("date").alias("iso_week"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------
def fct_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order item, valued at the price that was paid."""
    revenue = (F.col("quantity") * F.col("unit_price_at_purchase")).cast(MONEY)
    return items.join(orders, "order_id").select(
        "order_item_id",
        "order_id",
        "customer_id",
        "product_id",
        "order_status",
        "currency",
        "quantity",
        "unit_price_at_purchase",
        revenue.alias("revenue"),
        "order_created_at",
    )


def fct_events(
    events: DataFrame,
    products: DataFrame,
    slicing: Slicing = Slicing(),
    measure: Sequence[DataFrame] | None = None,
    customers: DataFrame | None = None,
    measure_customers: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """One row per event with keys into the date, product and customer dimensions.

    ``products`` and ``customers`` are dimensions with history: an event points
    to the version that was valid when it happened.
    """
    keyed = events.select(
        "event_id", "event_type", "event_ts", "session_id", "customer_id",
        F.date_format("event_ts", "yyyyMMdd").cast("int").alias("date_key"),
        prop("product_id").try_cast("bigint").alias("product_id"),
    )
    version = products.withColumn("product_valid_from", F.col("valid_from"))
    columns = ["product_key", "product_valid_from"]
    facts = asof_join(keyed, version, "product_id", "event_ts", columns, slicing, measure)
    if customers is None:
        return facts
    version = customers.withColumn("customer_valid_from", F.col("valid_from"))
    columns = ["customer_key", "customer_valid_from"]
    return asof_join(
        facts, version, "customer_id", "event_ts", columns, slicing, measure_customers)


def items_at_catalog_price(
    items: DataFrame,
    products: DataFrame,
    slicing: Slicing = Slicing(),
    measure: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Order facts with the catalog price that was valid at order time."""
    return asof_join(
        items, products, "product_id", "order_created_at", ["unit_price"], slicing, measure
    )


def facts_without_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders whose customer is not in the dimension (erased), or that have none.

    Orders without a customer are spread by their id, not gathered on null.
    """
    salt = F.when(F.col("customer_id").isNull(), F.pmod(F.xxhash64("order_id"), F.lit(NULL_KEY_SALTS)))
    wanted = orders.withColumn("_wanted", F.coalesce("customer_id", F.lit(0))).withColumn(
        "_salt", F.coalesce(salt, F.lit(-1)))
    known = customers.where("customer_id is not null").select(
        F.col("customer_id").alias("_wanted"), F.lit(-1).cast("long").alias("_salt")).distinct()
    return wanted.join(known, ["_wanted", "_salt"], "left_anti").select(*orders.columns)


# ---------------------------------------------------------------------------
# Marts
# ---------------------------------------------------------------------------
def paid(rows: DataFrame, status: str = "order_status") -> DataFrame:
    return rows.where(F.col(status).isin(*PAID_STATUSES))


def _per_order(items: DataFrame) -> DataFrame:
    """Units and revenue per order. Combined before the shuffle, so a single
    huge order is a handful of rows by the time it is joined."""
    return items.groupBy("order_id").agg(
        F.sum("quantity").alias("units"),
        F.sum((F.col("quantity") * F.col("unit_price_at_purchase")).cast(MONEY)).alias("revenue"),
    )


def daily_revenue(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, units and revenue per day, paid orders only.

    Items are summed per order before the join, so the day aggregate counts
    orders instead of distinct ids.
    """
    totals = _per_order(items).join(paid(orders), "order_id")
    return totals.groupBy(F.to_date("order_created_at").alias("order_date")).agg(
        F.count("*").alias("orders"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
    )


def daily_revenue_from_facts(facts: DataFrame) -> DataFrame:
    """The same mart from an order fact table that is already there.

    Facts are combined per order first, so orders are rows to count.
    """
    per_order = paid(facts).groupBy(F.to_date("order_created_at").alias("order_date"), "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("revenue").alias("revenue"))
    return per_order.groupBy("order_date").agg(
        F.count("order_id").alias("orders"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
    )


def product_performance(facts: DataFrame) -> DataFrame:
    """Units, revenue, orders and average price per product, paid orders only.

    Facts are combined per (product, order) first, which also makes the order
    count exact. Nearly every such pair is one row, so what a task holds grows
    with its rows: they are dealt to all tasks of a shuffle, which a number keeps
    from being merged into few, and not combined where many orders were joined.
    """
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = paid(facts).select("product_id", "order_id", "quantity", "revenue")
    per_order = rows.repartition(tasks, "product_id", "order_id").groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("revenue").alias("revenue")
    )
    return (
        per_order.groupBy("product_id")
        .agg(
            F.sum("units").alias("units_sold"),
            F.sum("revenue").cast(MONEY).alias("revenue"),
            F.count("*").alias("orders"),
        )
        .withColumn(
            "average_price", F.col("revenue").cast("double") / F.col("units_sold").cast("double")
        )
    )


def top_products(totals: DataFrame, window_column: str, n: int = 3) -> DataFrame:
    """Best-selling products per window from (window, product, revenue) totals."""
    return top_per_window(totals, [window_column], [F.desc("revenue"), F.asc("product_id")], n)


# ---------------------------------------------------------------------------
# Catalog seed
# ---------------------------------------------------------------------------
def catalog_grid(categories: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Every category with every label of a fixed short list, numbered.

    The list is written into the plan, so the grid is one row generator and no
    join. Numbers run by category; the running offset is taken over one row
    per category.
    """
    grid = categories.select("category", "subcategory").distinct().withColumn(
        "label", F.explode(F.array(*[F.lit(x) for x in labels]))
    )
    sizes = grid.groupBy("category").agg(F.count("*").alias("size"))
    before = Window.orderBy("category").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "category", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("category").orderBy("subcategory", "label")
    return (
        grid.withColumn("position", F.row_number().over(inside))
        .join(offsets, "category")
        .select(
            "category", "subcategory", "label",
            (F.col("offset") + F.col("position")).alias("number"),
        )
    )


def publish_view(rows: DataFrame, name: str) -> DataFrame:
    """Materialization ``view``: nothing is stored, readers see the newest load."""
    rows.createOrReplaceTempView(name)
    return rows
