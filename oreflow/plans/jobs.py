"""The jobs: layer functions in order. A scheduler only has to call these."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.checks import run_gate
from oreflow.operators.keyed import live_rows
from oreflow.operators.scd import scd2_shape
from oreflow.plans import fields, gold, increments, quality, silver, upkeep
from oreflow.schemas import BRONZE_CDC, CDC_TABLES, RETENTION_DAYS, SILVER_CDC_TABLES, CdcTable
from oreflow.sources import marks, tables
from oreflow.sources.files import Files
from oreflow.sources.swaps import Watcher, quiet
from oreflow.sources.versioned import VersionedTable


#: Feeds whose rows are masked.
PERSONAL = ("customers",)


def hourly_silver(
    spark: SparkSession,
    bronze_events: DataFrame,
    bronze_cdc: DataFrame,
    database: str = "silver",
    lakehouse: bool = False,
    now: Column | None = None,
    results_path: str | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Bronze to silver, then the gate. Raises when a check finds a violation.

    With a ``salt``, personal data of customers is masked before it is written.

    Each history is written first and read back for the current state, so the
    feed is parsed once.
    """
    clicks = silver.silver_events(bronze_events).withColumn("event_date", F.to_date("event_ts"))
    tables.replace_table(spark, f"{database}.events", clicks, ["event_date"], lakehouse)
    for name in SILVER_CDC_TABLES:
        spec = CDC_TABLES[name]
        history = f"{database}.{name}_history"
        changes = silver.cdc_history(bronze_cdc, spec)
        if name == "customers" and salt is not None:
            changes = silver.masked_customers(changes, salt)
        tables.replace_table(spark, history, changes, lakehouse=lakehouse)
        tables.replace_table(
            spark,
            f"{database}.{name}_current",
            silver.cdc_current(spark.table(history), spec),
            lakehouse=lakehouse,
        )
    return run_gate(quality.silver_checks(
        spark.table(f"{database}.events"),
        spark.table(f"{database}.orders_current"),
        spark.table(f"{database}.orders_history"),
        now,
    ), results_path=results_path, run_at=now)


def hourly_increment(
    spark: SparkSession,
    bronze_events: DataFrame,
    bronze_cdc: DataFrame,
    root: str,
    salt: str,
    buckets: int = 64,
    forget_before: Column | None = None,
    now: Column | None = None,
    results_path: str | None = None,
    widen: bool = False,
) -> dict[str, object]:
    """Bring silver under ``root`` up to date from what arrived since the last run.

    Reads each feed behind its last mark only (``sources.marks``). New events are
    appended to the days they belong to, changes to the history, and the current
    state of each table is merged in the folders that are touched. Personal data
    of customers is masked before anything is written. Then the gate looks at the
    touched days and folders. Marks move last: a run that died or did not pass is
    repeated, and repeating adds nothing. With ``widen`` the histories take in
    fields that a feed gains, as the field registry under ``root`` knows them; a
    known field whose type changed fails the gate before anything is written.
    Returns the times reached, the folder counts and the outcome of the gate.
    """
    path, feeds = f"{root}/marks", {"events": bronze_events, "changes": bronze_cdc}
    last = marks.load(spark, path)
    arrived, ends = {}, {}
    for feed, rows in feeds.items():
        new = marks.behind(rows, last.get(feed, marks.Mark()))
        end = marks.reached(new)
        if end.time is not None:
            ends[feed] = end
            # What lands from now on belongs to the next run.
            arrived[feed] = marks.within(new, end)
    reached = {feed: end.time for feed, end in ends.items()}
    touched: dict[str, int] = {}
    days: list = []
    if "events" in ends:
        days = _add_events(spark, arrived["events"], f"{root}/events")
    orders = None
    if "changes" in ends:
        run = run_name(last.get("changes", marks.Mark()))
        specs = {name: CDC_TABLES[name] for name in SILVER_CDC_TABLES}
        wide = _taken_in(spark, arrived["changes"], specs, root, run, results_path, now) if widen else specs
        for name, spec in specs.items():
            changes = silver.cdc_history(arrived["changes"], wide[name])
            if name == "customers":
                changes = silver.masked_customers(changes, salt)
            history = f"{root}/{name}_history"
            (changes.withColumn("run", F.lit(run)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(history))
            # The current state keeps the fixed columns.
            narrow = [c for c in changes.columns if c in spec.columns or c not in wide[name].columns]
            written = spark.read.schema(changes.schema.add("run", "string")).parquet(history).where(
                F.col("run") == run).select(*narrow)
            touched[name] = tables.merge_table(
                spark, f"{root}/{name}_current", written, spec.key, buckets, forget_before)
            if name == "orders":
                orders = written.select(tables.bucket_of(spec.key, buckets).alias("bucket")).distinct()
    outcome = _gate_of_increment(spark, root, days, orders, now, results_path) if ends else None
    marks.keep(spark, path, {feed: last.get(feed, marks.Mark()).joined(end) for feed, end in ends.items()})
    return {"reached": reached, "touched": touched, "outcome": outcome}


def _taken_in(
    spark: SparkSession, arrived: DataFrame, specs: Mapping[str, CdcTable], root: str, run: str,
    results_path: str | None, now: Column | None,
) -> dict[str, CdcTable]:
    """The specs with the fields that the feeds have gained; conflicts of type raise.

    Feeds of persons are not widened: nothing tells whether a new field must be masked.
    """
    known = fields.registry(spark, f"{root}/fields")
    wide, checks = {}, []
    for name, spec in specs.items():
        wider, more = fields.register(known, arrived, spec, run)
        wide[name] = spec if name in PERSONAL else wider
        checks += more
    run_gate(checks, results_path=results_path, run_at=now)
    return wide


def history(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A history under ``root`` with every field the registry knows; null where it was not there yet."""
    spec = CDC_TABLES[name]
    if name not in PERSONAL:
        spec = fields.widened(fields.registry(spark, f"{root}/fields"), spec)
    shape = silver.typed_changes(spark.createDataFrame([], BRONZE_CDC), spec).schema
    return spark.read.schema(shape).parquet(f"{root}/{name}_history")


def run_name(start: marks.Mark) -> str:
    """Name of the run that begins at a mark, in the order of runs.

    A run that is repeated begins where it began, so it replaces its own history
    folder, even if it now reads further. Either the time or an offset of a mark
    grows from run to run.
    """
    return "0" if start.time is None else f"{start.time:%Y%m%d%H%M%S%f}-{sum(start.offsets.values()):020d}"


def _gate_of_increment(
    spark: SparkSession, root: str, days: list, orders: DataFrame | None, now: Column | None,
    results_path: str | None,
) -> DataFrame | None:
    """The silver gate over the days and state folders that a run has touched."""
    history = f"{root}/orders_history"
    spec = CDC_TABLES["orders"]
    if orders is None and not tables.is_table(spark, history):
        return None  # no order has ever arrived
    events_path = f"{root}/events"
    if not tables.is_table(spark, events_path):
        return None
    day = F.col("event_date")
    events = spark.read.parquet(events_path).where(day.isin([d for d in days if d is not None]) | (
        day.isNull() if None in days else F.lit(False)))
    current = spark.read.parquet(f"{root}/{spec.name}_current")
    if orders is None:
        current = current.limit(0)
    else:
        current = current.join(orders, "bucket", "left_semi")
    return run_gate(quality.silver_checks(
        events, live_rows(current), spark.read.parquet(history), now), results_path=results_path, run_at=now)


def _add_events(spark: SparkSession, arrived: DataFrame, path: str) -> list:
    """Append the events that are not there yet to the days they belong to; returns these days."""
    # Repeats of an event share its time, so only the days at hand can hold them.
    dated = arrived.withColumn("event_date", F.to_date("event_ts"))
    days = [r[0] for r in dated.select("event_date").distinct().collect()]
    shape = silver.silver_events(dated).withColumn("event_date", F.to_date("event_ts"))
    shape.limit(0).write.mode("append").partitionBy("event_date").parquet(path)
    present = spark.read.schema(shape.schema).parquet(path).where(
        F.col("event_date").isin(days) | F.col("event_date").isNull())
    silver.new_events(dated, present).withColumn("event_date", F.to_date("event_ts")).write.mode(
        "append").partitionBy("event_date").parquet(path)
    return days


#: Change feeds that the gold tables are made from.
GOLD_FEEDS = ("orders", "order_items", "products", "customers")
DIMENSIONS = {
    "products": ("product_id", gold.PRODUCT_TRACKED, "product_key"),
    "customers": ("customer_id", gold.CUSTOMER_TRACKED, "customer_key"),
}


def gold_tables(
    spark: SparkSession, bronze_events: DataFrame, bronze_cdc: DataFrame, root: str
) -> dict[str, VersionedTable]:
    """The versioned tables that ``gold_increment`` keeps under ``root``."""
    events = silver.silver_events(bronze_events)
    typed = {name: silver.typed_changes(bronze_cdc, CDC_TABLES[name]) for name in GOLD_FEEDS}
    shapes = {f"{name}_state": typed[name].schema for name in ("orders", "order_items")}
    versions = {}
    for name, (key, tracked, surrogate) in DIMENSIONS.items():
        versions[name] = scd2_shape(typed[name].schema, key, tracked, surrogate)
        shapes[f"{name}_points"], shapes[f"dim_{name}"] = typed[name].schema, versions[name]
    shapes["sessions"] = increments.gap_sessions(events, "session_id").schema
    shapes["session_facts"] = increments.session_facts(events).schema
    shapes["order_totals"] = increments.order_totals(typed["orders"], typed["order_items"]).schema
    found = {name: increments.bucketed(spark, f"{root}/{name}", shape) for name, shape in shapes.items()}
    found["daily_revenue"] = increments.daily_mart(spark, f"{root}/daily_revenue")
    found["event_facts"] = VersionedTable(
        spark, f"{root}/event_facts", increments.fact_shape(events, *versions.values()), "event_date")
    return found


def gold_increment(
    spark: SparkSession,
    bronze_events: DataFrame,
    bronze_cdc: DataFrame,
    root: str,
    salt: str,
    buckets: int = 64,
    results_path: str | None = None,
    watch: Watcher = quiet,
) -> dict[str, object]:
    """Bring the gold tables under ``root`` up to date from what arrived since the last run.

    Kept are the current orders and items, both dimensions with history, sessions
    by gap and by id, event facts and the daily revenue; each only where the run
    touches it. An event that the facts have already is a repeat and counts no
    more; events without an id take no part. What a run reads is fixed before it
    starts, and every table notes the run with its rows: a job that died is run
    again and changes nothing twice. Marks move when all tables have the run; the
    gate over what was touched comes last.
    """
    files, path = Files(spark, root), f"{root}/marks"
    feeds = {"events": bronze_events.where("event_id is not null"), "changes": bronze_cdc}
    last = {feed: marks.Mark() for feed in feeds} | marks.load(spark, path)
    run = "+".join(run_name(last[feed]) for feed in feeds)
    known = json.loads(files.read("run.json")) if files.exists("run.json") else None
    if known is not None and known["run"] != run:  # of a job that died behind its marks
        files.delete("run.json")
        known = None
    if known is not None:  # of a job that died before: the same rows again
        ends = {feed: marks.Mark.from_json(end) for feed, end in known["ends"].items()}
    else:
        ends = {feed: marks.reached(marks.behind(rows, last[feed])) for feed, rows in feeds.items()}
        ends = {feed: end for feed, end in ends.items() if end.time is not None}
        if not ends:
            return {"reached": {}, "days": {}, "outcome": None}
        files.write_new("run.json", json.dumps({
            "run": run, "ends": {feed: end.to_json() for feed, end in ends.items()}}))
    watch("fixed")
    new = {feed: marks.within(marks.behind(rows, last[feed]), ends[feed]) if feed in ends
           else rows.limit(0) for feed, rows in feeds.items()}
    kept = gold_tables(spark, bronze_events, bronze_cdc, root)
    marked = {feed: last[feed].joined(end) for feed, end in ends.items()}
    # Written once and read by all tables, so the feeds are parsed once. A run that is
    # repeated reads the same rows and writes them again.
    events = _staged(_unseen(new["events"], kept["event_facts"]), f"{root}/staged/events")
    changes = {name: silver.cdc_history(new["changes"], CDC_TABLES[name]) for name in GOLD_FEEDS}
    changes["customers"] = silver.masked_customers(changes["customers"], salt)
    changes = {name: _staged(rows, f"{root}/staged/{name}") for name, rows in changes.items()}

    for name, (key, tracked, surrogate) in DIMENSIONS.items():
        points = kept[f"{name}_points"]
        increments.merge_points(points, changes[name], key, run, buckets, watch)
        increments.merge_dimension(
            kept[f"dim_{name}"], points, changes[name], key, tracked, surrogate, run, buckets, watch=watch)
    increments.merge_state(kept["orders_state"], changes["orders"], "order_id", run, buckets, watch=watch)
    increments.merge_state(
        kept["order_items_state"], changes["order_items"], "order_item_id", run, buckets, "order_id", watch)
    touched = changes["orders"].select("order_id").unionByName(changes["order_items"].select("order_id"))
    increments.merge_order_totals(
        kept["order_totals"], kept["orders_state"], kept["order_items_state"], touched, run, buckets, watch)
    days = {"daily_revenue": increments.refresh_daily_revenue(
        kept["daily_revenue"], kept["order_totals"], watch)}
    increments.merge_sessions(kept["sessions"], events, "session_id", run, buckets, watch=watch)
    increments.merge_session_facts(kept["session_facts"], events, run, buckets, watch)
    days["event_facts"] = increments.refresh_event_facts(
        kept["event_facts"], marks.covered(feeds["events"], marked.get("events", last["events"])),
        kept["dim_products"], kept["dim_customers"], events,
        [(key, changes[name]) for name, (key, _, _) in DIMENSIONS.items()], run, watch)

    marks.keep(spark, path, marked)
    watch("marks")
    files.delete("run.json")
    outcome = run_gate(
        quality.increment_checks(kept, days["daily_revenue"], days["event_facts"]), results_path=results_path)
    return {"reached": {feed: end.time for feed, end in ends.items()}, "days": days, "outcome": outcome}


def _staged(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _unseen(arrived: DataFrame, facts: VersionedTable) -> DataFrame:
    """First arrivals of events that the facts of their days do not have."""
    first = silver.silver_events(arrived).withColumn("event_date", F.to_date("event_ts"))
    days = [r[0] for r in first.select("event_date").distinct().collect()]
    known = facts.read(days).select("event_id")
    return first.join(known, "event_id", "left_anti").drop("event_date")


def daily_batch(
    spark: SparkSession,
    extracts: Mapping[str, DataFrame],
    lake_path: str,
    ds: str,
    raw_database: str = "raw",
    mart_database: str = "analytics",
    lakehouse: bool = False,
    results_path: str | None = None,
) -> DataFrame:
    """Extract to the lake, load the day, build gold, test it.

    Running a day again replaces that day.
    """
    for name, rows in extracts.items():
        path = f"{lake_path}/{name}"
        tables.write_snapshot(rows, path, ds)
        tables.load_day(
            spark, tables.read_snapshots(spark, path, name), f"{raw_database}.{name}", ds
        )

    def raw(name: str) -> tuple[DataFrame, str | None]:
        table = f"{raw_database}.{name}"
        return spark.table(table), tables.newest_ds(spark, table)

    orders = gold.publish_view(gold.stg_orders(*raw("orders")), "stg_orders")
    items = gold.publish_view(gold.stg_order_items(*raw("order_items")), "stg_order_items")
    products = gold.publish_view(gold.stg_products(*raw("products")), "stg_products")
    customers = gold.publish_view(gold.stg_customers(*raw("customers")), "stg_customers")
    if "payments" in extracts:
        gold.publish_view(gold.stg_payments(*raw("payments")), "stg_payments")

    def mart(name: str, rows: DataFrame) -> DataFrame:
        tables.replace_table(spark, f"{mart_database}.{name}", rows, lakehouse=lakehouse)
        return spark.table(f"{mart_database}.{name}")

    facts = mart("fct_orders", gold.fct_orders(items, orders))
    dim_product = mart("dim_product", gold.dim_product(products))
    dim_customer = mart("dim_customer", gold.dim_customer(customers))
    revenue = mart("mart_daily_revenue", gold.daily_revenue_from_facts(facts))
    return run_gate(
        quality.gold_checks(facts, dim_product, dim_customer, revenue), results_path=results_path)


def expire_builds(
    spark: SparkSession, names: list[str], now: datetime | None = None
) -> dict[str, list[str]]:
    """Weekly retention over replaceable tables; unknown tables are skipped."""
    now = now or datetime.now(timezone.utc)
    cutoff = now - timedelta(days=RETENTION_DAYS)
    return {name: tables.expire_versions(spark, name, cutoff) for name in names}


def weekly_upkeep(
    spark: SparkSession,
    small_files: Mapping[str, tuple[DataFrame, list[str]]],
    tables_kept: list[str],
    dead: DataFrame,
    archive_path: str,
    now: datetime | None = None,
    in_place: Mapping[str, list[str]] | None = None,
) -> dict[str, object]:
    """Compaction, then retention, then the dead-letter archive.

    ``in_place`` maps a folder (bronze, say) to its partition columns: its small
    files are merged where they are, safely against a job that dies.
    ``small_files`` maps a target folder to the frame to rewrite there and its
    partition columns.
    """
    merged = {path: upkeep.compact_small_files(spark, path, split)
              for path, split in (in_place or {}).items()}
    compacted = {
        target: upkeep.compact(rows, target, split) for target, (rows, split) in small_files.items()
    }
    expired = expire_builds(spark, tables_kept, now)
    upkeep.archive_dead_letters(spark, dead, archive_path)
    return {"merged": merged, "compacted": compacted, "expired": expired}
