"""One row per key: first, latest, as of a time, merged.

All of them rank with ``row_number() = 1``. Spark keeps one row per key and
task before the shuffle (``WindowGroupLimit``), so a key holding a large share
of all rows sends only a handful of them to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of every key under a total order."""
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col(_RANK) <= n).drop(_RANK)


def first_arrival(bronze: DataFrame, key: str) -> DataFrame:
    """Drop repeats: the first arrival of each key stays."""
    order = [F.asc("ingested_at"), F.asc("kafka_offset"), F.asc("kafka_partition")]
    return top_per_key(bronze, [key], order)


def latest_change(history: DataFrame, key: str) -> DataFrame:
    """The newest change of each key, deletes included."""
    order = [F.desc("changed_at"), F.desc("kafka_offset"), F.desc("kafka_partition")]
    return top_per_key(history, [key], order)


def current_state(history: DataFrame, key: str) -> DataFrame:
    """Latest state of each key; a key whose latest change is a delete is gone."""
    return latest_change(history, key).where(F.col("op") != "d")


def state_as_of(history: DataFrame, key: str, at: Column) -> DataFrame:
    """State at an earlier point in time, from the change history."""
    return current_state(history.where(F.col("changed_at") <= at), key)


def latest_version(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Last write wins: collapse a versioned table to its newest rows."""
    return top_per_key(rows, keys, [F.desc(v) for v in version])


def merge_changes(
    state: DataFrame, increment: DataFrame, key: str, forget_before: Column | None = None
) -> DataFrame:
    """Apply a batch of changes to a state table; deletes stay as markers.

    The newest change of each key wins by its whole position (change time,
    offset, partition), whichever side it comes from. So a batch can be applied
    again, and a change that arrives after the delete of its row does not bring
    the row back: the marker is newer. A later create does. ``live_rows`` is
    what readers see. Markers of the state older than ``forget_before`` are
    dropped; choose it behind everything that can still arrive.
    """
    base = state
    if forget_before is not None:
        base = base.where((F.col("op") != "d") | (F.col("changed_at") >= forget_before))
    for name in ("kafka_offset", "kafka_partition"):
        if name not in base.columns:
            base = base.withColumn(name, F.lit(None).cast("bigint"))
    return latest_change(base.unionByName(increment), key).select(*state.columns)


def live_rows(state: DataFrame) -> DataFrame:
    """Rows of a merged state without the markers of deleted ones."""
    return state.where(F.col("op") != "d")
