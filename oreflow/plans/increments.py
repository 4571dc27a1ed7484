"""Gold tables kept up to date from increments: what is touched is made anew, nothing else.

All tables are ``VersionedTable``s. Each notes the run it contains with the rows,
so a run that is repeated after a job died changes nothing twice, and readers see
a table before or after a run, never in between. Run names are in order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from oreflow.operators.keyed import merge_changes, top_per_key
from oreflow.operators.ordered import Slicing
from oreflow.operators.scd import scd2
from oreflow.operators.sessions import (
    gap_sessions,
    joined_session_facts,
    joined_sessions,
    session_facts,
)
from oreflow.plans import gold
from oreflow.plans.silver import silver_events
from oreflow.schemas import MONEY, PAID_STATUSES, SESSION_GAP_MINUTES
from oreflow.sources.swaps import Watcher, quiet
from oreflow.sources.tables import bucket_of
from oreflow.sources.versioned import Version, VersionedTable

BUCKET, MONTH, RUN, DAYS = "bucket", "month", "run", "days"


def bucketed(spark: SparkSession, path: str, schema: StructType) -> VersionedTable:
    """A versioned table whose rows lie in folders by key hash."""
    if BUCKET not in schema.names:
        schema = StructType([*schema.fields]).add(BUCKET, "integer")
    return VersionedTable(spark, path, schema, BUCKET)


def contains(version: Version, run: str) -> bool:
    """Whether a version has a run already. Tables that were never written have none."""
    return str(version.notes.get(RUN, "")) >= run


def _values(rows: DataFrame, column: str) -> list:
    """Distinct folder values: as many as there are folders."""
    return [r[0] for r in rows.select(column).distinct().collect()]


def _rewritten(
    table: VersionedTable, rows: DataFrame, key: str, buckets: int, run: str,
    made: Callable[[DataFrame, DataFrame], DataFrame], watch: Watcher,
) -> Version:
    """Replace the folders that hold keys of ``rows`` by ``made(old rows of them, rows)``."""
    base = table.version()
    if contains(base, run):
        return base
    changed = rows.withColumn(BUCKET, bucket_of(key, buckets))
    touched = _values(changed, BUCKET)
    new = made(table.read(touched, base), changed).withColumn(BUCKET, bucket_of(key, buckets))
    return table.replace(new, touched, {RUN: run}, base, watch)


# ---------------------------------------------------------------------------
# Current state
# ---------------------------------------------------------------------------
def merge_state(
    table: VersionedTable, changes: DataFrame, key: str, run: str, buckets: int = 64,
    folder_key: str | None = None, watch: Watcher = quiet,
) -> Version:
    """Newest change of each key, delete markers included; folders by ``folder_key``.

    ``folder_key`` must be fixed for each key, as the order is for an order item.
    """
    def made(old: DataFrame, new: DataFrame) -> DataFrame:
        return merge_changes(old, new.select(*old.columns), key)

    return _rewritten(table, changes, folder_key or key, buckets, run, made, watch)


# ---------------------------------------------------------------------------
# Dimensions with history
# ---------------------------------------------------------------------------
def settled_changes(changes: DataFrame, key: str) -> DataFrame:
    """One change for each key and time: the last log position."""
    keyed = changes.where(F.col(key).isNotNull())
    return top_per_key(keyed, [key, "changed_at"], [F.desc("kafka_offset"), F.desc("kafka_partition")])


def merge_points(
    table: VersionedTable, changes: DataFrame, key: str, run: str, buckets: int = 64,
    watch: Watcher = quiet,
) -> Version:
    """Keep the settled changes of every key, also those that changed nothing.

    A change that is none today can become one when an earlier change arrives
    late, so it has to stay; the intervals are made from these points.
    """
    def made(old: DataFrame, new: DataFrame) -> DataFrame:
        return settled_changes(old.unionByName(new.select(*old.columns)), key)

    keyed = changes.where(F.col(key).isNotNull())
    return _rewritten(table, keyed, key, buckets, run, made, watch)


def merge_dimension(
    table: VersionedTable, points: VersionedTable, changes: DataFrame, key: str,
    tracked: Sequence[str], surrogate: str, run: str, buckets: int = 64,
    slicing: Slicing = Slicing(), watch: Watcher = quiet,
) -> Version:
    """Intervals of the keys that ``changes`` touch, from their points; others stay as they are.

    An open version is closed by its successor, a late change splits the interval
    it falls into, and two intervals join when what lay between them turns out
    not to be a change. ``points`` must contain the run.
    """
    touched_keys = changes.where(F.col(key).isNotNull()).select(key).distinct()

    def made(old: DataFrame, new: DataFrame) -> DataFrame:
        folders = _values(new, BUCKET)
        history = points.read(folders).join(touched_keys, key, "left_semi")
        versions = scd2(history, key, tracked, surrogate, slicing)
        return old.drop(BUCKET).join(touched_keys, key, "left_anti").unionByName(versions)

    return _rewritten(table, touched_keys, key, buckets, run, made, watch)


# ---------------------------------------------------------------------------
# Sessions
# ---------------------------------------------------------------------------
def merge_sessions(
    table: VersionedTable, events: DataFrame, key: str, run: str, buckets: int = 64,
    gap_minutes: int = SESSION_GAP_MINUTES, watch: Watcher = quiet,
) -> Version:
    """Gap sessions with the new events in; ``events`` are those of this run, each once."""
    def made(old: DataFrame, new: DataFrame) -> DataFrame:
        parts = old.drop(BUCKET).unionByName(new.drop(BUCKET))
        return joined_sessions(parts, key, gap_minutes)

    return _rewritten(table, gap_sessions(events, key, gap_minutes=gap_minutes), key, buckets, run, made, watch)


def merge_session_facts(
    table: VersionedTable, events: DataFrame, run: str, buckets: int = 64, watch: Watcher = quiet,
) -> Version:
    """One row per session id, with the new events in."""
    def made(old: DataFrame, new: DataFrame) -> DataFrame:
        return joined_session_facts(old.drop(BUCKET).unionByName(new.drop(BUCKET)))

    return _rewritten(table, session_facts(events), "session_id", buckets, run, made, watch)


# ---------------------------------------------------------------------------
# Daily revenue
# ---------------------------------------------------------------------------
def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Day, units and revenue of each paid order that has items.

    ``orders`` and ``items`` are current state, without deleted rows.
    """
    totals = items.groupBy("order_id").agg(
        F.sum("quantity").cast("bigint").alias("units"),
        F.sum((F.col("quantity") * F.col("unit_price_at_purchase")).cast(MONEY)).cast(MONEY).alias("revenue"))
    bought = orders.where(F.col("status").isin(*PAID_STATUSES))
    return totals.join(bought, "order_id").select(
        "order_id", F.to_date("created_at").alias("order_date"), "units", "revenue")


def merge_order_totals(
    table: VersionedTable, orders: VersionedTable, items: VersionedTable, touched: DataFrame,
    run: str, buckets: int = 64, watch: Watcher = quiet,
) -> Version:
    """Totals of the orders in ``touched`` (order_id) from the current state in their folders.

    ``orders`` and ``items`` lie in folders by order id, as many as ``table``. The
    days on which a total appeared, changed or went are noted with the rows, until
    the mart has them.
    """
    base = table.version()
    if contains(base, run):
        return base
    ids = touched.where("order_id is not null").select("order_id").distinct()
    folders = _values(ids.withColumn(BUCKET, bucket_of("order_id", buckets)), BUCKET)

    def current(state: VersionedTable) -> DataFrame:
        return state.read(folders).where("op <> 'd'").join(ids, "order_id", "left_semi").drop(BUCKET)

    old = table.read(folders, base).drop(BUCKET)
    before = old.join(ids, "order_id", "left_semi")
    now = order_totals(current(orders), current(items))
    days = _values(before.unionByName(now).select(
        F.coalesce(F.col("order_date").cast("string"), F.lit("null")).alias("day")), "day")
    rows = old.join(ids, "order_id", "left_anti").unionByName(now)
    pending = sorted({*base.notes.get(DAYS, []), *days})
    return table.replace(rows.withColumn(BUCKET, bucket_of("order_id", buckets)), folders,
                         {RUN: run, DAYS: pending}, base, watch)


def _month(day: str) -> str:
    """Folder of a day of the mart: its month, as a day is one row."""
    return day if day == "null" else day[:7]


def refresh_daily_revenue(
    mart: VersionedTable, totals: VersionedTable, watch: Watcher = quiet,
) -> list[str]:
    """Make the days anew on which totals changed since the mart was made; returns them.

    The mart lies in folders by month, and the months of these days are made from
    the totals. A day that has no paid order any more goes. The mart notes the
    version of the totals it was made from, and the days of later ones are taken
    from their notes.
    """
    source, base = totals.version(), mart.version()
    since = int(base.notes.get("totals", 0))
    if source.number == since:
        return []
    days: set[str] = set()
    for number in totals.numbers():
        if number > since:
            days.update(totals.version(number).notes.get(DAYS, []))
    months = {_month(d) for d in days}
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("null"))
    chosen = totals.read(version=source).where(month.isin(sorted(months)))
    daily = chosen.groupBy("order_date").agg(
        F.count("*").alias("orders"), F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("revenue"))
    mart.replace(daily.withColumn(MONTH, month), months, {"totals": source.number}, base, watch)
    return sorted(days)


def read_days(mart: VersionedTable, days: Sequence[str] | None = None) -> DataFrame:
    """Rows of the daily mart, of all days or of some, from the folders of their months."""
    rows = mart.read(None if days is None else {_month(d) for d in days}).drop(MONTH)
    return rows if days is None else rows.where(
        F.coalesce(F.col("order_date").cast("string"), F.lit("null")).isin(list(days)))


def daily_mart(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, StructType([
        StructField("order_date", DateType()), StructField("orders", LongType()),
        StructField("units_sold", LongType()), StructField("revenue", DecimalType(18, 2)),
        StructField(MONTH, StringType())]), MONTH)


# ---------------------------------------------------------------------------
# Event facts
# ---------------------------------------------------------------------------
def event_facts(
    events: DataFrame, products: DataFrame, customers: DataFrame, slicing: Slicing = Slicing()
) -> DataFrame:
    """``gold.fct_events`` under the day of each event; ``events`` has each once."""
    facts = gold.fct_events(events, products, slicing, customers=customers)
    return facts.withColumn("event_date", F.to_date("event_ts"))


def fact_shape(events: DataFrame, products: StructType, customers: StructType) -> StructType:
    """Columns of ``event_facts``."""
    spark = events.sparkSession
    none = [spark.createDataFrame([], s) for s in (products, customers)]
    return event_facts(events.limit(0), *none).schema


def refresh_event_facts(
    table: VersionedTable, events: DataFrame, products: VersionedTable, customers: VersionedTable,
    new_events: DataFrame, changes: Sequence[tuple[str, DataFrame]], run: str,
    watch: Watcher = quiet,
) -> list:
    """Make the days of event facts anew that a run touches; returns them.

    These are the days of new events, and days that hold an event of a changed
    product or customer at or after the first change that arrived: a change that
    comes late moves events to another version. ``changes`` are (key, changed
    rows with changed_at); ``events`` are all bronze events that were read.
    """
    base = table.version()
    if contains(base, run):
        return []
    day = F.to_date("event_ts")
    days = new_events.select(day.alias("event_date"))
    known = table.read(version=base)
    for key, rows in changes:
        first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("changed_at").alias("since"))
        hit = known.select(key, "event_ts", "event_date").join(first, key).where("event_ts >= since")
        days = days.unionByName(hit.select("event_date"))
    touched = _values(days, "event_date")
    named = [d for d in touched if d is not None]
    inside = day.isin(named) | (day.isNull() if None in touched else F.lit(False))
    # Repeats of an event share its time, so first arrivals can be told inside the days.
    facts = event_facts(silver_events(events.where(inside)), products.read(), customers.read())
    table.replace(facts, touched, {RUN: run}, base, watch)
    return touched


