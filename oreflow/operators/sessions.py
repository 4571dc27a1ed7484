"""Sessions: by inactivity gap, and by a session id that the source supplies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.columns import micros
from oreflow.schemas import FUNNEL_STAGES, SESSION_GAP_MINUTES


def gap_sessions(
    events: DataFrame, key: str, at: str = "event_ts", gap_minutes: int = SESSION_GAP_MINUTES
) -> DataFrame:
    """Sessions of a key that end after ``gap_minutes`` without an event.

    Two events in the same gap-wide time slot always share a session. So events
    are first combined per (key, slot), before the shuffle, and only slot rows
    are ordered: a busy key adds at most one row per slot, however many events
    it has. An event exactly one gap after the last one still belongs to it.
    """
    gap = gap_minutes * 60 * 1_000_000
    slots = (
        events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        .withColumn("_slot", F.floor(micros(F.col(at)) / F.lit(gap)))
        .groupBy(key, "_slot")
        .agg(
            F.min(at).alias("_first"),
            F.max(at).alias("_last"),
            F.count("*").alias("_events"),
        )
    )
    by_time = Window.partitionBy(key).orderBy("_slot")
    silence = micros(F.col("_first")) - F.lag(micros(F.col("_last"))).over(by_time)
    numbered = slots.withColumn("_opens", F.when(silence > gap, 1).otherwise(0)).withColumn(
        "_session", F.sum("_opens").over(by_time)
    )
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("last_event"),
            F.sum("_events").alias("events"),
        )
        .select(
            key,
            "session_start",
            (F.col("last_event") + F.expr(f"interval {gap_minutes} minutes")).alias("session_end"),
            "events",
        )
    )


def joined_sessions(parts: DataFrame, key: str, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Sessions out of parts of sessions (``gap_sessions`` rows of any cut of the events).

    Parts that touch or lie within one gap become one session, so an event that
    comes late can join two sessions into one. The order is over parts: a key has
    at most one per gap of time, however many events it has.
    """
    gap = F.expr(f"interval {gap_minutes} minutes")
    by_start = Window.partitionBy(key).orderBy("session_start", "session_end")
    # A part can lie inside an earlier one, so what ended last counts.
    reach = F.max("session_end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("session_start") > reach, 1).otherwise(0)
    numbered = parts.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(by_start))
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events").alias("events"),
        )
        .select(key, "session_start", "session_end", "events")
    )


def _seen(event_type: str) -> Column:
    return F.max((F.col("event_type") == event_type).cast("int"))


def session_facts(events: DataFrame) -> DataFrame:
    """One row per session id: length, pages, whether it ended in a purchase."""
    return (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min("event_ts").alias("session_start"),
            F.max("event_ts").alias("session_end"),
            F.count("*").alias("events"),
            F.count(F.when(F.col("event_type").isin("page_view", "product_view"), 1)).alias("pages"),
            F.max("customer_id").alias("customer_id"),
            (_seen("purchase") == 1).alias("converted"),
        )
        .withColumn(
            "duration_seconds",
            (micros(F.col("session_end")) - micros(F.col("session_start"))) / F.lit(1_000_000.0),
        )
    )


def joined_session_facts(parts: DataFrame) -> DataFrame:
    """Session facts out of facts of any cut of the events (``session_facts`` rows)."""
    return (
        parts.groupBy("session_id")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events").alias("events"),
            F.sum("pages").alias("pages"),
            F.max("customer_id").alias("customer_id"),
            F.bool_or("converted").alias("converted"),
        )
        .withColumn(
            "duration_seconds",
            (micros(F.col("session_end")) - micros(F.col("session_start"))) / F.lit(1_000_000.0),
        )
        .select(*parts.columns)
    )


def funnel(events: DataFrame, stages: tuple[str, ...] = FUNNEL_STAGES) -> DataFrame:
    """Sessions reaching each stage, and their share of the stage before.

    A session reaches a stage when it has that event and every earlier stage.
    """
    flags = (
        events.where(F.col("session_id").isNotNull() & F.col("event_type").isin(*stages))
        .groupBy("session_id")
        .agg(*[_seen(stage).alias(f"s{i}") for i, stage in enumerate(stages)])
    )
    reached, everything = [], F.lit(True)
    for i in range(len(stages)):
        everything = everything & (F.col(f"s{i}") == 1)
        reached.append(F.count(F.when(everything, 1)).alias(f"n{i}"))
    totals = flags.agg(*reached)
    rows = F.array(*[
        F.struct(
            F.lit(i + 1).alias("stage_no"),
            F.lit(stage).alias("stage"),
            F.col(f"n{i}").alias("sessions"),
            F.when(
                F.col(f"n{max(i - 1, 0)}") > 0,
                F.round(F.col(f"n{i}") / F.col(f"n{max(i - 1, 0)}"), 4),
            ).alias("rate_from_previous"),
            F.when(F.col("n0") > 0, F.round(F.col(f"n{i}") / F.col("n0"), 4)).alias("rate_from_first"),
        )
        for i, stage in enumerate(stages)
    ])
    return totals.select(F.inline(rows))
