"""Registered queries: every operator on the driver tables.

All of them run over whole tables. Results use plain output types: money as
double, instants as wall-clock UTC timestamps.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.columns import ds_text, prop, sku, to_second
from oreflow.functions.wire import add_header, decode_clicks, has_header
from oreflow.operators import checks, keyed, scd, sessions, windows
from oreflow.operators.ordered import Slicing
from oreflow.plans import bronze, gold, increments, pulse, quality, silver, upkeep
from oreflow.schemas import CDC_TABLES, ORDER_STATUSES
from oreflow.session import prepare
from oreflow.sources import marks, tables
from verification import feeds

ORDERS, PRODUCTS, CUSTOMERS = (CDC_TABLES[n] for n in ("orders", "products", "customers"))
# Fixed values: "now" and marks of the compared queries.
NOW = "2024-01-31 00:00:00"
STALLED_AT = "2024-01-31 06:00:00"
RECENT_NOW = "2024-01-15 12:00:00"
RECONCILE_NOW = "2024-01-20 00:00:00"
AS_OF = "1998-06-01 00:00:00"
LANDED_UNTIL = "2024-01-29 00:00:00"
ARCHIVED_UNTIL = "2024-01-16 00:00:00"
SALT = "pepper-1:"
# Every key with more rows than this is cut, so small data takes the sliced form.
FINE = Slicing(rows_per_slice=2)
#: Offsets of the change log that were visible at the mark.
VISIBLE = 20_500
#: Folders of the tables that increments are merged into.
BUCKETS = 16
GRID_LABELS = ("Amber", "Birch", "Cobalt", "Dune", "Elm", "Flint")


def at(text: str):
    return F.lit(text).cast("timestamp")


class Shapes:
    """The driver tables in layer shapes, for one session and data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, parts: int | None = None):
        self.spark, self.sf_dir, self.parts = prepare(spark), sf_dir, parts

    def table(self, name: str) -> DataFrame:
        rows = feeds.table(self.spark, self.sf_dir, name)
        return rows if self.parts is None else rows.repartition(self.parts)

    def order_snapshots(self) -> DataFrame:
        return feeds.order_snapshots(self.table("orders"))

    def item_snapshots(self) -> DataFrame:
        return feeds.item_snapshots(self.table("lineitem"))

    def product_snapshots(self) -> DataFrame:
        return feeds.product_snapshots(self.table("part"))

    def customer_snapshots(self) -> DataFrame:
        return feeds.customer_snapshots(self.table("customer"), self.table("nation"))

    def stg_orders(self) -> DataFrame:
        return gold.stg_orders(self.order_snapshots())

    def stg_items(self) -> DataFrame:
        return gold.stg_order_items(self.item_snapshots())

    def stg_products(self) -> DataFrame:
        return gold.stg_products(self.product_snapshots())

    def stg_customers(self) -> DataFrame:
        return gold.stg_customers(self.customer_snapshots())

    def facts(self) -> DataFrame:
        return gold.fct_orders(self.stg_items(), self.stg_orders())

    def revenue(self) -> DataFrame:
        return gold.daily_revenue(self.stg_items(), self.stg_orders())

    def raw_orders(self, drift: bool = False) -> DataFrame:
        return bronze.bronze_cdc(feeds.order_changes(self.table("orders"), drift), F.col("timestamp"))

    def order_changes(self) -> DataFrame:
        return silver.typed_changes(self.raw_orders(), ORDERS)

    def order_history(self) -> DataFrame:
        return silver.cdc_history(self.raw_orders(), ORDERS)

    def orders_current(self) -> DataFrame:
        return silver.cdc_current(self.order_changes(), ORDERS)

    def product_history(self) -> DataFrame:
        raw = bronze.bronze_cdc(feeds.product_changes(self.table("part")), F.col("timestamp"))
        return silver.typed_changes(raw, PRODUCTS)

    @staticmethod
    def change_keys(feed: DataFrame, name: str) -> DataFrame:
        """Key of every change record, from the message key alone: no parsing."""
        return feed.select(F.col("key").cast("string").cast("bigint").alias(name))

    def order_keys(self) -> DataFrame:
        return self.change_keys(feeds.order_changes(self.table("orders"), bare=True), "order_id")

    def product_keys(self) -> DataFrame:
        return self.change_keys(feeds.product_changes(self.table("part"), bare=True), "product_id")

    def customer_keys(self) -> DataFrame:
        return self.change_keys(feeds.customer_changes(self.table("customer"), bare=True), "customer_id")

    def product_versions(self) -> DataFrame:
        return gold.dim_product_scd2(self.product_history(), measure=self.product_keys())

    def customer_history(self) -> DataFrame:
        raw = bronze.bronze_cdc(feeds.customer_changes(self.table("customer")), F.col("timestamp"))
        return silver.typed_changes(raw, CUSTOMERS)

    def clicks(self) -> DataFrame:
        return feeds.click_log(self.table("events"))

    def decoded(self) -> DataFrame:
        return decode_clicks(self.clicks())

    def bronze(self) -> DataFrame:
        return bronze.bronze_events(self.decoded(), F.col("timestamp"))

    def silver(self) -> DataFrame:
        return silver.silver_events(self.bronze())

    def dead(self) -> DataFrame:
        return bronze.dead_letters(bronze.bad(self.decoded()), F.col("timestamp"))


def flat(rows: DataFrame) -> DataFrame:
    """Decimals as double and instants as wall-clock UTC, for comparison."""
    changed = {}
    for f in rows.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            changed[f.name] = F.col(f.name).cast("timestamp_ntz")
    return rows.withColumns(changed) if changed else rows


REGISTRY: dict[str, Callable[[Shapes], DataFrame]] = {}


def query(function: Callable[[Shapes], DataFrame]) -> Callable[[Shapes], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


def queries(parts: int | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries. ``parts`` deals each table to that many tasks first, for
    timings on tables that are stored as one small file."""
    def bind(function):
        return lambda spark, sf_dir: flat(function(Shapes(spark, sf_dir, parts)))

    return {name: bind(function) for name, function in REGISTRY.items()}


# ---------------------------------------------------------------------------
# Staging, dimensions, facts, marts
# ---------------------------------------------------------------------------
@query
def stg_orders(s):
    return s.stg_orders()


@query
def stg_order_items(s):
    return s.stg_items()


@query
def stg_products(s):
    return s.stg_products()


@query
def stg_customers(s):
    return s.stg_customers()


@query
def dim_product(s):
    return gold.dim_product(s.stg_products())


@query
def dim_customer(s):
    return gold.dim_customer(s.stg_customers())


@query
def fct_orders(s):
    return s.facts()


@query
def mart_daily_revenue(s):
    return s.revenue().orderBy("order_date")


@query
def mart_daily_revenue_from_facts(s):
    return gold.daily_revenue_from_facts(s.facts())


@query
def mart_product_performance(s):
    return gold.product_performance(s.facts())


@query
def facts_without_customer(s):
    kept = s.stg_customers().where(F.col("customer_id") % 9 != 0)
    return gold.facts_without_customer(s.stg_orders(), kept).select(
        "order_id", "customer_id", "order_status"
    )


@query
def dim_date(s):
    return gold.dim_date(s.table("orders"), "o_orderdate")


# ---------------------------------------------------------------------------
# Snapshots and extracts
# ---------------------------------------------------------------------------
@query
def extract_snapshot(s):
    rows = s.order_snapshots().where(F.col("ds") == feeds.SNAPSHOT_DAYS[0]).drop("ds")
    return tables.stamp(rows, "2001-08-04")


@query
def load_snapshot(s):
    """A day that is loaded again replaces that day only."""
    loaded = s.order_snapshots()
    again = loaded.where(F.col("ds") == feeds.SNAPSHOT_DAYS[1]).withColumn("status", F.upper("status"))
    return loaded.where(F.col("ds") != feeds.SNAPSHOT_DAYS[1]).unionByName(again).select(
        "order_id", "status", "ds"
    )


@query
def latest_snapshot(s):
    return gold.latest_snapshot(s.order_snapshots())


@query
def incremental_extract(s):
    rows = gold.latest_snapshot(s.order_snapshots())
    return tables.changed_since(rows, at("2000-06-01 00:00:00"))


@query
def high_water_mark(s):
    return tables.high_water_mark(s.order_snapshots())


@query
def snapshot_retention(s):
    days = s.table("orders").select(ds_text(F.col("o_orderdate")).alias("ds"))
    return tables.retained_snapshots(days, "2001-08-03")


@query
def file_inventory(s):
    return tables.file_inventory(s.spark.read.parquet(f"{s.sf_dir}/orders.parquet"))


# ---------------------------------------------------------------------------
# Pulse checks
# ---------------------------------------------------------------------------
@query
def table_row_counts(s):
    return pulse.row_counts({
        "customers": s.table("customer"), "products": s.table("part"),
        "orders": s.table("orders"), "order_items": s.table("lineitem"),
    })


@query
def silver_row_counts(s):
    return pulse.row_counts({
        "events": s.silver(),
        "orders_current": s.orders_current(),
        "orders_history": s.order_history(),
        "customers_current": silver.cdc_current(s.customer_history(), CUSTOMERS),
        "products_current": silver.cdc_current(s.product_history(), PRODUCTS),
    })


@query
def raw_rows_by_table(s):
    return pulse.rows_by_day({
        "orders": s.order_snapshots(), "order_items": s.item_snapshots(),
        "products": s.product_snapshots(), "customers": s.customer_snapshots(),
    })


@query
def mart_row_counts(s):
    return pulse.row_counts({
        "fct_orders": s.facts(), "dim_product": s.stg_products(),
        "dim_customer": s.stg_customers(), "mart_daily_revenue": s.revenue(),
    })


@query
def orders_by_status(s):
    return pulse.orders_by_status(s.stg_orders())


@query
def last_orders(s):
    return pulse.last_orders(s.stg_orders())


@query
def last_days_revenue(s):
    return pulse.last_days(s.revenue())


@query
def revenue_by_category(s):
    return pulse.revenue_by_category(s.stg_orders(), s.stg_items(), s.stg_products())


@query
def trap_counts(s):
    return pulse.trap_counts(s.product_snapshots(), gold.latest_snapshot(s.order_snapshots()))


@query
def table_freshness(s):
    return pulse.newest_per_table(
        {"events": (s.bronze(), "event_ts"), "orders": (s.table("orders"), "o_orderdate")}, at(NOW)
    )


@query
def stalled_minutes(s):
    return windows.empty_slots(s.bronze(), "kafka_ts", 5, until=at(STALLED_AT))


@query
def dlq_rate(s):
    return pulse.dead_letter_rate(s.dead(), limit=0.001)


@query
def offset_lag(s):
    log = s.clicks()
    landed, dead = (rows.where(F.col("kafka_ts") < at(LANDED_UNTIL)).select(
        F.lit(feeds.CLICK_TOPIC).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
    ) for rows in (s.bronze(), s.dead()))
    return pulse.offset_lag(log, landed.unionByName(dead), limit=100)


# ---------------------------------------------------------------------------
# Scalar functions and the catalog seed
# ---------------------------------------------------------------------------
@query
def catalog_grid(s):
    products = s.product_snapshots()
    grid = gold.catalog_grid(products, GRID_LABELS)
    return grid.withColumn("sku", sku(F.col("category"), F.col("label"), F.col("number")))


@query
def scalar_catalog(s):
    bonus = F.element_at(F.array(F.lit(5), F.lit(10), F.lit(15)), (F.col("p_partkey") % 3 + 1).cast("int"))
    return s.table("part").select(
        F.col("p_partkey").alias("product_id"),
        sku(F.col("p_type"), F.col("p_brand"), F.col("p_partkey")).alias("sku"),
        F.concat_ws(" ", F.initcap("p_type"), "p_name").alias("name"),
        F.round(F.col("p_retailprice"), 1).alias("price_rounded"),
        F.floor(F.col("p_retailprice")).alias("price_floor"),
        bonus.alias("bonus"),
        F.coalesce(F.lit("12x").try_cast("bigint"), F.col("p_partkey")).alias("cast_fallback"),
    )


@query
def date_functions(s):
    made = F.col("ts")
    return s.table("events").select(
        "event_id",
        F.to_date(made).alias("day"),
        ds_text(made).alias("ds"),
        to_second(made).alias("nearest_second"),
        F.timestamp_millis(F.unix_millis(made)).alias("from_millis"),
        (made - F.expr("interval 10 minutes")).alias("ten_minutes_before"),
        F.window(made, "1 minute").start.alias("minute_start"),
        F.window(made, "1 minute").end.alias("minute_end"),
    )


# ---------------------------------------------------------------------------
# Change feed
# ---------------------------------------------------------------------------
@query
def cdc_raw(s):
    return s.raw_orders()


@query
def cdc_history(s):
    return s.order_history()


@query
def cdc_current(s):
    return s.orders_current()


@query
def customers_current(s):
    return silver.cdc_current(s.customer_history(), CUSTOMERS)


@query
def products_current(s):
    return silver.cdc_current(s.product_history(), PRODUCTS)


@query
def state_as_of(s):
    return keyed.state_as_of(s.order_changes(), "order_id", at(AS_OF)).select(
        *ORDERS.columns, "op", "changed_at"
    )


@query
def order_lifecycle(s):
    return silver.life_line(
        s.order_changes(), "order_id", ["status"], measure=s.order_keys()
    )


@query
def order_lifecycle_sliced(s):
    return silver.life_line(
        s.order_changes(), "order_id", ["status"], FINE, measure=s.order_keys()
    )


@query
def dim_product_scd2_sliced(s):
    return gold.dim_product_scd2(
        s.product_history(), FINE, measure=s.product_keys()
    ).drop("product_key")


@query
def scd2_asof_join_sliced(s):
    facts = s.facts().select("order_item_id", "product_id", "quantity", "order_created_at")
    sold = s.table("lineitem").select(F.col("l_partkey").alias("product_id"))
    return gold.items_at_catalog_price(
        facts, s.product_versions(), FINE, measure=[sold, s.product_keys()]
    )


@query
def dim_product_scd2(s):
    return s.product_versions().drop("product_key")


@query
def dim_customer_scd2(s):
    return gold.dim_customer_scd2(s.customer_history(), measure=s.customer_keys()).drop("customer_key")


@query
def scd2_asof_join(s):
    facts = s.facts().select("order_item_id", "product_id", "quantity", "order_created_at")
    sold = s.table("lineitem").select(F.col("l_partkey").alias("product_id"))
    return gold.items_at_catalog_price(
        facts, s.product_versions(), measure=[sold, s.product_keys()]
    )


@query
def stale_status(s):
    snapshot = gold.latest_snapshot(s.order_snapshots())
    return silver.stale_rows(snapshot, s.orders_current(), "order_id", "status")


@query
def mask_pii(s):
    rows = s.customer_snapshots().select("customer_id", "email", "full_name", "country_code")
    return silver.masked_customers(rows, SALT)


@query
def schema_drift(s):
    return silver.unknown_fields(s.raw_orders(drift=True), ORDERS)


@query
def incremental_merge(s):
    changes = s.order_changes()
    state = keyed.latest_change(changes.where(F.col("changed_at") <= at(AS_OF)), "order_id")
    increment = changes.where(F.col("changed_at") > at(AS_OF))
    merged = keyed.merge_changes(state, increment, "order_id")
    return keyed.live_rows(merged).select(*ORDERS.columns, "op", "changed_at")


@query
def merge_replayed(s):
    """Batches out of order and twice: deletes first, then all older changes, then again."""
    changes = s.order_changes()
    state = keyed.latest_change(changes.where("op = 'd'"), "order_id")
    for batch in (changes.where("op <> 'd'"), changes):
        state = keyed.merge_changes(state, batch, "order_id")
    return keyed.live_rows(state).select(*ORDERS.columns, "op", "changed_at")


# ---------------------------------------------------------------------------
# Clicks: wire, bronze, silver
# ---------------------------------------------------------------------------
@query
def wire_split_counts(s):
    return bronze.split_counts(s.clicks())


def _readable(rows: DataFrame) -> DataFrame:
    keys = ("product_id", "order_id", "order_value")
    return rows.withColumns({k: prop(k) for k in keys}).withColumn(
        "order_value", F.col("order_value").try_cast("double")
    ).drop("properties", "ingested_at")


@query
def bronze_events(s):
    return _readable(s.bronze())


@query
def silver_events(s):
    return _readable(s.silver())


@query
def silver_increment(s):
    """Silver kept up to date by increments: what was there, plus what is new."""
    bronze_rows, mark = s.bronze(), at(ARCHIVED_UNTIL)
    present = silver.silver_events(bronze_rows.where(F.col("kafka_ts") < mark))
    increment = bronze_rows.where(F.col("kafka_ts") >= mark)
    return _readable(present.unionByName(silver.new_events(increment, present)))


@query
def duplicate_rate(s):
    return silver.duplicate_rate(s.bronze())


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------
@query
def gate_duplicate_keys(s):
    return checks.duplicates(s.bronze(), "event_id")


@query
def gate_null_keys(s):
    return s.silver().where(quality.has_null_key()).select("event_id", "event_ts", "session_id")


@query
def gate_purchase_without_order(s):
    return s.silver().where(quality.is_purchase_without_order_id()).select("event_id", "event_ts")


@query
def gate_negative_totals(s):
    return s.orders_current().where(quality.has_negative_total()).select("order_id", "total_amount")


@query
def gate_unmatched_purchases(s):
    return quality.unmatched_purchases(s.silver(), s.order_changes(), at(RECONCILE_NOW))


def _tested_orders(s: Shapes) -> DataFrame:
    status = F.when(F.col("order_id") % 700 == 2, "returned").otherwise(F.col("order_status"))
    return s.stg_orders().withColumn("order_status", status)


@query
def test_unique(s):
    lines = s.table("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"))
    return checks.not_unique(lines, "line")


@query
def test_not_null(s):
    return checks.any_null(_tested_orders(s), "customer_id").select("order_id")


@query
def test_accepted_values(s):
    return checks.not_accepted(_tested_orders(s), "order_status", ORDER_STATUSES)


@query
def quality_report(s):
    return checks.report(
        quality.silver_checks(s.silver(), s.orders_current(), s.order_changes(), at(RECONCILE_NOW))
    )


@query
def gold_quality_report(s):
    return checks.report(
        quality.gold_checks(s.facts(), s.stg_products(), s.stg_customers(), s.revenue())
    )


# ---------------------------------------------------------------------------
# Windows, sessions, funnel
# ---------------------------------------------------------------------------
def _live(s: Shapes) -> DataFrame:
    return bronze.valid_payloads(s.decoded())


@query
def kpis_minute(s):
    return windows.window_kpis(_live(s), exact=True)


@query
def kpis_minute_approx(s):
    return windows.window_kpis(_live(s))


def _kpi_versions(s: Shapes) -> DataFrame:
    """What an update-mode stream writes: first on-time data, then late windows again."""
    events = s.bronze()
    limit = F.expr("interval 2 minutes")
    first = windows.window_kpis(silver.on_time(events, limit), exact=True)
    touched = (
        events.where(F.col("kafka_ts") - F.col("event_ts") > limit)
        .select(F.window("event_ts", "1 minute").start.alias("window_start"))
        .distinct()
    )
    again = windows.window_kpis(events, exact=True).join(touched, "window_start", "left_semi")
    return first.withColumn("batch", F.lit(0)).unionByName(again.withColumn("batch", F.lit(1)))


@query
def latest_version_read(s):
    return keyed.latest_version(_kpi_versions(s), ["window_start"], ["batch"])


@query
def kpis_recent(s):
    latest = keyed.latest_version(_kpi_versions(s), ["window_start"], ["batch"])
    return windows.recent_kpis(latest, at(RECENT_NOW), minutes=600)


@query
def speed_vs_batch(s):
    events = s.bronze()
    speed = windows.window_kpis(silver.on_time(events, F.expr("interval 2 minutes")))
    return pulse.speed_against_batch(speed, windows.window_kpis(s.silver()))


@query
def session_windows(s):
    return sessions.gap_sessions(s.table("events"), "user_id", "ts")


@query
def fct_sessions(s):
    return sessions.session_facts(s.silver())


@query
def mart_funnel_conversion(s):
    return sessions.funnel(s.silver())


@query
def top_products_per_window(s):
    month = F.date_trunc("month", "l_shipdate").alias("month")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    totals = (
        s.table("lineitem")
        .groupBy(month, F.col("l_partkey").alias("product_id"))
        .agg(F.sum("l_quantity").cast("bigint").alias("units"), F.sum(price).alias("revenue"))
    )
    return gold.top_products(totals, "month")


@query
def fct_events(s):
    products = s.product_versions()
    viewed = s.table("events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id")
    )
    customers = gold.dim_customer_scd2(s.customer_history(), measure=s.customer_keys())
    clicked = s.table("events").select(F.col("user_id").alias("customer_id"))
    return gold.fct_events(
        s.silver(), products, measure=[viewed, s.product_keys()],
        customers=customers, measure_customers=[clicked, s.customer_keys()],
    ).drop("product_key", "customer_key")


# ---------------------------------------------------------------------------
# Kept up to date by increments: the same results from batches in mixed order
# ---------------------------------------------------------------------------
def _folder(s: Shapes) -> str:
    """A new folder below the shared one; a local session without it gets its own."""
    shared = s.spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not s.spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='oreflow-')}"
    return f"{shared}/increments-{uuid.uuid4().hex}"


def _batches(rows: DataFrame, *by: str, n: int = 3) -> list[tuple[str, DataFrame]]:
    """(run, rows) that cut a feed regardless of time, so later ones come late."""
    batch = F.pmod(F.xxhash64(*by), F.lit(n))
    return [(f"{i}", rows.where(batch == i)) for i in range(n)]


def _staged(rows: DataFrame, path: str) -> DataFrame:
    """Rows written once, as ``gold_increment`` does, for all steps that read them."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _dimension_by_increments(s: Shapes, history: DataFrame, key: str, tracked, surrogate: str):
    root = _folder(s)
    points = increments.bucketed(s.spark, f"{root}/points", history.schema)
    dimension = increments.bucketed(
        s.spark, f"{root}/dimension", scd.scd2_shape(history.schema, key, tracked, surrogate))
    history = _staged(history, f"{root}/staged")
    for run, changes in _batches(history, "kafka_partition", "kafka_offset"):
        increments.merge_points(points, changes, key, run, BUCKETS)
        increments.merge_dimension(dimension, points, changes, key, tracked, surrogate, run, BUCKETS)
    return dimension.read().drop("bucket", surrogate)


@query
def dim_product_scd2_increments(s):
    return _dimension_by_increments(
        s, s.product_history(), "product_id", gold.PRODUCT_TRACKED, "product_key")


@query
def dim_customer_scd2_increments(s):
    return _dimension_by_increments(
        s, s.customer_history(), "customer_id", gold.CUSTOMER_TRACKED, "customer_key")


@query
def session_windows_increments(s):
    events = s.table("events").withColumnRenamed("ts", "event_ts")
    shape = sessions.gap_sessions(events, "user_id").schema
    table = increments.bucketed(s.spark, _folder(s), shape)
    for run, batch in _batches(events, "event_id"):
        increments.merge_sessions(table, batch, "user_id", run, BUCKETS)
    return table.read().drop("bucket")


@query
def fct_sessions_increments(s):
    events = s.silver()
    table = increments.bucketed(s.spark, _folder(s), sessions.session_facts(events).schema)
    for run, batch in _batches(events, "event_id"):
        increments.merge_session_facts(table, batch, run, BUCKETS)
    return table.read().drop("bucket")


@query
def mart_daily_revenue_increments(s):
    """Orders that are paid later, and items that come later."""
    root = _folder(s)
    orders = _staged(s.stg_orders().select(
        "order_id", F.col("order_status").alias("status"), F.col("order_created_at").alias("created_at"),
        F.lit("u").alias("op"), F.col("order_updated_at").alias("changed_at"),
        F.col("order_id").alias("kafka_offset"), F.lit(1).alias("kafka_partition")),
        f"{root}/staged/orders")
    early = orders.withColumns({
        "status": F.lit("pending"), "changed_at": F.col("created_at") - F.expr("interval 1 day")})
    items = _staged(s.stg_items().select(
        "order_item_id", "order_id", "quantity", "unit_price_at_purchase", F.lit("c").alias("op"),
        F.lit(None).cast("timestamp").alias("changed_at"), F.xxhash64("order_item_id").alias("kafka_offset"),
        F.lit(0).alias("kafka_partition")), f"{root}/staged/items")
    state, lines, totals = (increments.bucketed(s.spark, f"{root}/{name}", shape) for name, shape in (
        ("orders", orders.schema), ("items", items.schema),
        ("totals", increments.order_totals(orders, items).schema)))
    mart = increments.daily_mart(s.spark, f"{root}/mart")
    lates = dict(_batches(items, "order_item_id", n=2))
    for run, changed, added in (
            ("0", early, lates["0"]), ("1", orders.where("order_id % 3 > 0"), lates["1"]),
            ("2", orders.where("order_id % 3 = 0"), items.limit(0))):
        increments.merge_state(state, changed, "order_id", run, BUCKETS)
        increments.merge_state(lines, added, "order_item_id", run, BUCKETS, "order_id")
        touched = _staged(
            changed.select("order_id").unionByName(added.select("order_id")).distinct(),
            f"{root}/staged/touched-{run}")
        increments.merge_order_totals(totals, state, lines, touched, run, BUCKETS)
        increments.refresh_daily_revenue(mart, totals)
    return increments.read_days(mart).orderBy("order_date")


@query
def increment_by_offsets(s):
    """What a reader has not read whose mark was taken when half of a micro-batch was visible.

    A thousand offsets of the log arrive in one batch, with one time.
    """
    arrived = F.timestamp_seconds(F.floor(F.col("kafka_offset") / 1_000) * 60)
    feed = s.raw_orders().withColumn("ingested_at", arrived)
    left = marks.behind(feed, marks.reached(feed.where(F.col("kafka_offset") < VISIBLE)))
    return left.select("kafka_partition", "kafka_offset", "kafka_ts")


@query
def kpis_hourly_sessions(s):
    """Sessions per hour from the stored sketches of its minutes."""
    return windows.sessions_per(windows.session_sketches(_live(s)), "1 hour")


# ---------------------------------------------------------------------------
# Dead letters
# ---------------------------------------------------------------------------
@query
def dlq_archive(s):
    """Archive after a second run: what was there, and what was new."""
    dead = s.dead()
    archive = dead.where(F.col("kafka_ts") < at(ARCHIVED_UNTIL))
    both = archive.unionByName(upkeep.new_dead_letters(dead, archive))
    return both.select(
        "key",
        F.hex(F.substring("value", 1, 1)).alias("first_byte"),
        "kafka_partition", "kafka_offset", "kafka_ts",
    )


@query
def dlq_replay_report(s):
    """Replay after a producer fix: records that lacked the header get one."""
    def repair(records: DataFrame) -> DataFrame:
        fixed = F.when(has_header(F.col("value")), F.col("value")).otherwise(add_header(F.col("value")))
        return records.withColumn("value", fixed)

    return upkeep.replay_report(upkeep.replay(s.dead(), repair, s.bronze()))
