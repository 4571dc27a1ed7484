"""Silver: deduplicated clicks, typed change history, current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import initial, masked_email, micros
from oreflow.operators.keyed import current_state, first_arrival
from oreflow.operators.ordered import Slicing, timeline
from oreflow.schemas import SILVER_EVENT_COLUMNS, CdcTable


def silver_events(bronze: DataFrame) -> DataFrame:
    """One row per event id: the first arrival."""
    return first_arrival(bronze, "event_id").select(*SILVER_EVENT_COLUMNS)


def new_events(increment: DataFrame, present: DataFrame) -> DataFrame:
    """Events of a bronze increment that silver does not hold yet, to be appended.

    An increment is small against silver, so repeats inside it go first.
    """
    return silver_events(increment).join(present.select("event_id"), "event_id", "left_anti")


def duplicate_rate(bronze: DataFrame) -> DataFrame:
    """Bronze rows, distinct events, and the repeats between them."""
    per_event = bronze.groupBy("event_id").agg(F.count("*").alias("n"))
    return per_event.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.count("*").alias("silver_rows"),
    ).withColumn("duplicates", F.col("bronze_rows") - F.col("silver_rows"))


def _of_topic(raw: DataFrame, table: CdcTable) -> DataFrame:
    """Records of one table; tombstones carry no row and are skipped."""
    return raw.where((F.col("topic") == table.topic) & F.col("value").isNotNull())


def typed_changes(raw: DataFrame, table: CdcTable) -> DataFrame:
    """Unwrap the envelope: typed columns, operation, change time, log position.

    A delete takes its row from the image before; every other change takes the
    image after, so a column that was set to null stays null. A value that does
    not fit its type becomes null. The envelope is parsed once per record.
    """
    parsed = F.from_json("value", table.envelope())
    changes = _of_topic(raw, table).select(
        F.explode_outer(F.array(parsed)).alias("change"), "kafka_offset", "kafka_partition"
    )
    image = F.when(F.col("change.op") == "d", F.col("change.before")).otherwise(
        F.col("change.after")
    )
    return changes.select("change", image.alias("image"), "kafka_offset", "kafka_partition").select(
        *[F.col(f"image.{c}").try_cast(t).alias(c) for c, t in table.columns.items()],
        F.col("change.op").alias("op"),
        F.timestamp_millis("change.ts_ms").alias("changed_at"),
        "kafka_offset",
        "kafka_partition",
    )


def cdc_history(raw: DataFrame, table: CdcTable) -> DataFrame:
    """Every change of a table once, typed, deletes included.

    Repeats of a log position go after typing: the typed row is a fraction of
    the envelope text, and it is the row that moves.
    """
    return typed_changes(raw, table).dropDuplicates(["kafka_partition", "kafka_offset"])


def cdc_current(history: DataFrame, table: CdcTable) -> DataFrame:
    """Latest state per key. Repeats in the history do not matter here."""
    return current_state(history, table.key).select(*table.columns, "op", "changed_at")


def life_line(
    history: DataFrame,
    key: str,
    columns: Sequence[str],
    slicing: Slicing = Slicing(),
    measure: DataFrame | None = None,
) -> DataFrame:
    """Changes of each key in order, with the time spent until the next one.

    Changes without a key belong to no life line and are left out. Repeats of a
    log position may be in ``history``: they share their key, so they go behind
    the one shuffle by key that the order needs.
    """
    placed = history.where(F.col(key).isNotNull()).select(
        key, *columns, "op", "changed_at", "kafka_offset",
        F.struct("changed_at", "kafka_offset", "kafka_partition").alias("_at"),
    )
    line = timeline(placed, key, "_at", slicing, measure).gathered()
    ordered = line.then(lambda rows: rows.dropDuplicates([*line.keys, "_at"]))
    followed = ordered.with_next(F.col("changed_at"), "after").done()
    spent = (micros(F.col("after.v")) - micros(F.col("changed_at"))) / F.lit(1_000_000.0)
    return followed.select(
        key, *columns, "op", "changed_at", "kafka_offset",
        F.col("after.v").alias("next_changed_at"),
        spent.alias("seconds_in_state"),
    )


def masked_customers(customers: DataFrame, salt: str) -> DataFrame:
    """Personal data replaced: a salted digest for the address, an initial for the name."""
    return customers.withColumns({
        "email": masked_email(F.col("email"), salt),
        "full_name": initial(F.col("full_name")),
    })


def unknown_fields(raw: DataFrame, table: CdcTable) -> DataFrame:
    """Fields in the change feed that the table spec does not know."""
    image = F.coalesce(
        F.get_json_object("value", "$.after"), F.get_json_object("value", "$.before")
    )
    names = _of_topic(raw, table).select(F.explode(F.json_object_keys(image)).alias("field"))
    return (
        names.where(~F.col("field").isin(*table.columns))
        .groupBy("field")
        .agg(F.count("*").alias("records"))
    )


def stale_rows(
    snapshot: DataFrame, current: DataFrame, key: str, column: str
) -> DataFrame:
    """Keys whose snapshot value differs from the latest change."""
    left = snapshot.select(key, F.col(column).alias("snapshot_value"))
    right = current.select(key, F.col(column).alias("current_value"))
    return left.join(right, key).where(
        ~F.col("snapshot_value").eqNullSafe(F.col("current_value"))
    )


def on_time(records: DataFrame, delay: Column) -> DataFrame:
    """Events that arrived within ``delay`` of happening."""
    return records.where(F.col("kafka_ts") - F.col("event_ts") <= delay)
