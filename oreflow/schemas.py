"""Explicit schemas of every layer, and the per-table change-feed specs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The data contract of the platform
# ---------------------------------------------------------------------------
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled")
PAID_STATUSES = ("paid", "shipped", "delivered")
FUNNEL_STAGES = ("product_view", "add_to_cart", "begin_checkout", "purchase")

KPI_WINDOW = "1 minute"
KPI_WATERMARK = "2 minutes"
TRIGGER_INTERVAL = "30 seconds"
SESSION_GAP_MINUTES = 30
RECONCILE_AFTER_MINUTES = 10
RETENTION_DAYS = 7
RETENTION_MIN_SNAPSHOTS = 5
TARGET_FILE_BYTES = 128 * 1024 * 1024
DLQ_WINDOW_MINUTES = 10
DLQ_MAX_PER_SECOND = 1.0
LAG_LIMIT = 5_000

MONEY = "decimal(18,2)"

# ---------------------------------------------------------------------------
# Wire and bronze shapes of the data contract
# ---------------------------------------------------------------------------
LOG_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# JSON form of the click payload; ``event_ts`` travels as epoch milliseconds.
CLICK_PAYLOAD = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_ts", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("device", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("browser", T.StringType()),
    ])),
    T.StructField("page_url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
])

BRONZE_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("device_os", T.StringType()),
    T.StructField("device_browser", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_ts", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
])
SILVER_EVENT_COLUMNS = [
    name for name in BRONZE_EVENTS.fieldNames() if not name.startswith("kafka_")
]

BRONZE_CDC = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_ts", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
])

DLQ_ARCHIVE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_ts", T.TimestampType()),
    T.StructField("archived_at", T.TimestampType()),
])

# ---------------------------------------------------------------------------
# Change feeds
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class CdcTable:
    """One captured table: its topic, its key and its typed columns."""

    name: str
    key: str
    columns: dict[str, str] = field(hash=False)
    topic_prefix: str = "cdc.store.public."

    @property
    def topic(self) -> str:
        return f"{self.topic_prefix}{self.name}"

    def envelope(self) -> T.StructType:
        """Every image column is text: numbers and times travel as strings."""
        image = T.StructType([T.StructField(c, T.StringType()) for c in self.columns])
        return T.StructType([
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ])



# Captured tables, their keys, columns and types.
CDC_TABLES: dict[str, CdcTable] = {
    spec.name: spec
    for spec in (
        CdcTable("orders", "order_id", {
            "order_id": "bigint",
            "customer_id": "bigint",
            "status": "string",
            "currency": "string",
            "total_amount": "decimal(12,2)",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        }),
        CdcTable("customers", "customer_id", {
            "customer_id": "bigint",
            "email": "string",
            "full_name": "string",
            "country_code": "string",
            "marketing_opt_in": "boolean",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        }),
        CdcTable("products", "product_id", {
            "product_id": "bigint",
            "sku": "string",
            "name": "string",
            "category": "string",
            "subcategory": "string",
            "unit_price": "decimal(10,2)",
            "is_active": "boolean",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        }),
        # Captured upstream as well, so raw rows of these tables exist too.
        CdcTable("inventory", "product_id", {
            "product_id": "bigint",
            "quantity_on_hand": "int",
            "updated_at": "timestamp",
        }),
        CdcTable("order_items", "order_item_id", {
            "order_item_id": "bigint",
            "order_id": "bigint",
            "product_id": "bigint",
            "quantity": "int",
            "unit_price_at_purchase": "decimal(10,2)",
        }),
        CdcTable("payments", "payment_id", {
            "payment_id": "bigint",
            "order_id": "bigint",
            "method": "string",
            "status": "string",
            "amount": "decimal(12,2)",
            "created_at": "timestamp",
        }),
    )
}
# The three tables the hourly job turns into silver.
SILVER_CDC_TABLES = ("orders", "customers", "products")

# ---------------------------------------------------------------------------
# Daily snapshots: full copies, one ``ds`` per day, money as double.
# Tables, columns and types as extracted.
# ---------------------------------------------------------------------------
SNAPSHOTS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("email", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("marketing_opt_in", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("ds", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("ds", T.StringType()),
    ]),
    "inventory": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity_on_hand", T.IntegerType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("ds", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("ds", T.StringType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price_at_purchase", T.DoubleType()),
        T.StructField("ds", T.StringType()),
    ]),
    "payments": T.StructType([
        T.StructField("payment_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("ds", T.StringType()),
    ]),
}
