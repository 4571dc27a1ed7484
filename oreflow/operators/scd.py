"""Slowly changing dimensions: validity intervals and the join as of a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampType

from oreflow.operators.ordered import KeySizes, Slicing, Timeline, key_sizes, timeline


NULL_KEY_SALTS = 10_000
NESTED = ("map", "array", "struct", "variant")


def scd2(
    history: DataFrame,
    key: str,
    tracked: Sequence[str],
    surrogate: str,
    slicing: Slicing = Slicing(),
    measure: DataFrame | None = None,
) -> DataFrame:
    """Change history to intervals ``[valid_from, valid_to)``, one per state.

    Of several changes at the same time the last log position counts. A change
    that leaves every tracked column as it was opens no interval. A delete
    closes the interval and opens none. Changes without a key are left out.
    """
    keyed = history.where(F.col(key).isNotNull())
    changes = timeline(keyed, key, "changed_at", slicing, measure).gathered()
    state = F.struct((F.col("op") == "d").alias("gone"), *tracked)
    last = F.max_by(state, F.struct("kafka_offset", "kafka_partition")).alias("state")
    # A deleted key has one state, whatever its last image said.
    alive = F.when(~F.col("state.gone"), F.struct(*[F.col(f"state.{c}") for c in tracked]))
    settled = changes.then(
        lambda rows: rows.groupBy(*changes.keys, "changed_at").agg(last).withColumn("state", alive)
    )
    differs = F.col("before").isNull() | ~F.col("before.v").eqNullSafe(F.col("state"))
    changed = settled.with_previous(F.col("state"), "before").then(
        lambda rows: rows.where(differs).drop("before")
    )
    closed = changed.with_next(F.col("changed_at"), "after").done()
    return closed.where(F.col("state").isNotNull()).select(
        F.xxhash64(key, "changed_at").alias(surrogate),
        key,
        *[F.col(f"state.{c}").alias(c) for c in tracked],
        F.col("changed_at").alias("valid_from"),
        F.col("after.v").alias("valid_to"),
        F.col("after").isNull().alias("is_current"),
    )


def scd2_shape(history: StructType, key: str, tracked: Sequence[str], surrogate: str) -> StructType:
    """Columns of ``scd2`` for a history with these columns."""
    return StructType(
        [StructField(surrogate, LongType()), history[key], *[history[c] for c in tracked],
         StructField("valid_from", TimestampType()), StructField("valid_to", TimestampType()),
         StructField("is_current", BooleanType())])


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    slicing: Slicing = Slicing(),
    measure: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Add the dimension columns that were valid at each fact's own time.

    Facts outside every interval get nulls. Facts and version starts are put in
    time order and versions are carried forward, so the work is linear: no fact
    meets all versions of its key. ``measure`` names cheaper frames whose rows
    per key are at least those of facts and versions; key sizes are then taken
    from them.
    """
    starts = versions.select(
        key, F.col("valid_from").alias(at), F.struct("valid_to", *columns).alias("version")
    )
    sizes = key_sizes(key, *(measure or (facts, versions)), slicing=slicing)
    if not sizes.any_hot:
        return _asof_in_one_pass(facts, starts, key, at, columns)
    return _asof_by_lookup(facts, starts, key, at, columns, sizes)


def _valid_at(at: str):
    ends = F.col("version.valid_to")
    return F.col("version").isNotNull() & (ends.isNull() | (F.col(at) < ends))


def _asof_in_one_pass(
    facts: DataFrame, starts: DataFrame, key: str, at: str, columns: Sequence[str]
) -> DataFrame:
    """Facts between version starts in one window; one shuffle of the facts."""
    # Facts without a key find no version. They may be many, so they are spread
    # by the values of their plain columns instead of meeting in one task.
    plain = [f.name for f in facts.schema.fields if f.dataType.typeName() not in NESTED]
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*plain), F.lit(NULL_KEY_SALTS)))
    both = (
        facts.withColumn("_fact", F.lit(1))
        .unionByName(starts.withColumn("_fact", F.lit(0)), allowMissingColumns=True)
    )
    in_order = (
        Window.partitionBy(key, salt)
        .orderBy(F.col(at), F.col("_fact"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = both.withColumn("version", F.last("version", ignorenulls=True).over(in_order))
    # A fact without key or time is ordered somewhere, but has no version.
    usable = F.col(key).isNotNull() & F.col(at).isNotNull() & _valid_at(at)
    return filled.where("_fact = 1").select(
        *facts.columns, *[F.when(usable, F.col(f"version.{c}")).alias(c) for c in columns]
    )


def _asof_by_lookup(
    facts: DataFrame, starts: DataFrame, key: str, at: str, columns: Sequence[str],
    sizes: KeySizes,
) -> DataFrame:
    """With hot keys: look versions up once per distinct (key, time), then join.

    Facts of one instant collapse before the shuffle, the timeline of a hot key
    is sliced, and the final join has a two-column key that AQE can split.
    """
    points = facts.select(key, at).where(F.col(key).isNotNull() & F.col(at).isNotNull())
    both = points.withColumn("_fact", F.lit(1)).unionByName(
        starts.withColumn("_fact", F.lit(0)), allowMissingColumns=True
    )
    # One row per (key, time): a version starting exactly at a fact's time wins.
    distinct = both.groupBy(key, at).agg(
        F.first("version", ignorenulls=True).alias("version"), F.max("_fact").alias("_fact")
    )
    ordered: Timeline = timeline(distinct, key, at, sizes=sizes)
    lookup = ordered.carry_forward("version").done().where((F.col("_fact") == 1) & _valid_at(at))
    return facts.join(
        lookup.select(key, at, *[F.col(f"version.{c}").alias(c) for c in columns]),
        [key, at], "left",
    ).select(*facts.columns, *columns)
