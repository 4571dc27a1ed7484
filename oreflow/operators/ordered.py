"""Neighbouring rows inside a key, when one key may hold a third of all rows.

``lag`` and ``lead`` over a whole key put that key into one task. So the key
sizes are looked at first (one narrow aggregate, one row back to the driver):

* No key above the limit: a plain window over the key is all it takes.
* Otherwise the hot keys are cut into slices of their time axis, of about
  ``rows_per_slice`` rows each, so no task sorts more whatever the data size.
  The window runs over (key, slice), and what has to cross a slice edge is
  aggregated to one row per slice and handed to the neighbouring slices. Up to
  ``MAX_HOT_KEYS`` hot keys, their cut points are broadcast; beyond, they are
  a table of their own and joined like one.

Results do not depend on where the cuts are; only the balance does. The cut
points are fixed before the query runs, so a task that is repeated after a
lost executor cuts the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
MAX_HOT_KEYS = 20_000
ROWS_PER_SLICE = 1_000_000
SAMPLES_PER_SLICE = 64


@dataclass(frozen=True)
class Slicing:
    """When a key counts as hot, and how fine it is cut."""

    rows_per_slice: int = ROWS_PER_SLICE


@dataclass(frozen=True)
class KeySizes:
    """Rows per key of one or more frames, and the limit of a hot key."""

    counts: DataFrame
    limit: int
    hot: int

    @property
    def any_hot(self) -> bool:
        return self.hot > 0

    @property
    def few(self) -> bool:
        """Whether the hot keys fit a broadcast."""
        return self.hot <= MAX_HOT_KEYS


def key_sizes(key: str, *frames: DataFrame, slicing: Slicing = Slicing()) -> KeySizes:
    """Measure the keys. Only the number of hot ones reaches the driver."""
    per_frame = [df.groupBy(key).agg(F.count("*").alias("_rows")) for df in frames]
    counts = reduce(DataFrame.unionByName, per_frame)
    if len(per_frame) > 1:
        counts = counts.groupBy(key).agg(F.sum("_rows").alias("_rows"))
    counts = counts.where(F.col(key).isNotNull())
    limit = slicing.rows_per_slice
    return KeySizes(counts, limit, counts.where(F.col("_rows") > limit).count())


def _beside(side: DataFrame, few: bool) -> DataFrame:
    """Rows about hot keys as the side of a join: broadcast if few, else never.

    Left to itself Spark takes sizes from those of compressed files, and would
    also broadcast what holds a row for almost every key.
    """
    return F.broadcast(side) if few else side.hint("merge")


def _cut_points(df: DataFrame, key: str, at: str, sizes: KeySizes) -> DataFrame:
    """(key, cuts) of the hot keys, from a hash sample of their times."""
    spark = df.sparkSession
    hot = sizes.counts.where(F.col("_rows") > sizes.limit).select(
        key, F.ceil(F.col("_rows") / F.lit(sizes.limit)).cast("int").alias("_slices")
    )
    if sizes.few:  # at most MAX_HOT_KEYS rows
        hot = spark.createDataFrame(hot.collect(), hot.schema)
    every = max(1, int(sizes.limit // SAMPLES_PER_SLICE))
    sample = (
        df.select(key, at)
        .where(F.col(at).isNotNull())
        .join(_beside(hot, sizes.few), key)
        .where(F.pmod(F.xxhash64(at), F.lit(every)) == 0)
        .groupBy(key, "_slices")
        # Equal times merge before the shuffle, so an array holds about
        # SAMPLES_PER_SLICE times per slice.
        .agg(F.sort_array(F.collect_set(at)).alias("_times"))
    )
    cuts = F.expr(
        "array_distinct(transform(sequence(1, _slices - 1), "
        "i -> _times[cast(size(_times) * i / _slices as int)]))"
    )
    points = sample.select(key, cuts.alias("_cuts"))
    # One array per hot key. The hash sample gives the same cuts each time.
    return spark.createDataFrame(points.collect(), points.schema) if sizes.few else points


def _with_slice(df: DataFrame, key: str, at: str, cuts: DataFrame, few: bool) -> DataFrame:
    """Add the slice number: null for ordinary keys, 0..n along time for hot ones.

    Cuts are searched in two steps (every k-th cut, then k cuts), so a key with
    thousands of slices costs a few dozen comparisons per row.
    """
    stepped = cuts.withColumn("_k", F.expr("cast(ceil(sqrt(size(_cuts))) as int)")).withColumn(
        "_coarse", F.expr("filter(_cuts, (c, i) -> i % _k = 0)")
    )
    before = F.expr(f"size(filter(_coarse, c -> c <= {at}))")
    inner = F.expr(f"size(filter(slice(_cuts, (_block - 1) * _k + 1, _k), c -> c <= {at}))")
    return (
        df.join(_beside(stepped, few), key, "left")
        .withColumn("_block", before)
        .withColumn(
            SLICE,
            F.when(F.col("_cuts").isNull(), F.lit(None).cast("int"))
            .when(F.col("_block") == 0, 0)
            .otherwise((F.col("_block") - 1) * F.col("_k") + inner),
        )
        .drop("_cuts", "_k", "_coarse", "_block")
    )


@dataclass(frozen=True)
class Timeline:
    """Rows of each key in time order. ``at`` must be unique inside a key."""

    rows: DataFrame
    key: str
    at: str
    sliced: bool
    few: bool = True

    def then(self, step: Callable[[DataFrame], DataFrame]) -> Timeline:
        """Apply a row-wise step; it must keep key, time and slice columns."""
        return replace(self, rows=step(self.rows))

    @property
    def keys(self) -> list[str]:
        """What a window or an aggregate of this timeline partitions by."""
        return [self.key, SLICE] if self.sliced else [self.key]

    def gathered(self) -> Timeline:
        """Bring keys together ahead of several steps that group by key.

        One shuffle then serves them all. Hot keys are not gathered: there a
        grouping has to combine rows before it moves them.
        """
        return self if self.sliced else self.then(lambda rows: rows.repartition(self.key))

    def done(self) -> DataFrame:
        return self.rows.drop(SLICE) if self.sliced else self.rows

    def with_previous(self, value: Column, name: str) -> Timeline:
        """Value of the row before as a one-field struct; null on the first row."""
        boxed = F.struct(value.alias("v"))
        return self._window(
            name,
            F.lag(boxed).over(self._inside()),
            F.max_by(boxed, self.at),
            lambda: F.lag("_own").over(self._across()),
        )

    def with_next(self, value: Column, name: str) -> Timeline:
        """Value of the row after as a one-field struct; null on the last row."""
        boxed = F.struct(value.alias("v"))
        return self._window(
            name,
            F.lead(boxed).over(self._inside()),
            F.min_by(boxed, self.at),
            lambda: F.lead("_own").over(self._across()),
        )

    def carry_forward(self, value: str) -> Timeline:
        """Fill nulls of ``value`` with the last value at or before each row."""
        start = Window.unboundedPreceding
        here = self._inside().rowsBetween(start, Window.currentRow)
        return self._window(
            value,
            F.last(value, ignorenulls=True).over(here),
            F.max_by(value, F.when(F.col(value).isNotNull(), F.col(self.at))),
            lambda: F.last("_own", ignorenulls=True).over(self._across().rowsBetween(start, -1)),
        )

    def _inside(self):
        return Window.partitionBy(*self.keys).orderBy(self.at)

    def _across(self):
        return Window.partitionBy(self.key).orderBy(SLICE)

    def _window(
        self, name: str, inside: Column, edge: Column, across: Callable[[], Column]
    ) -> Timeline:
        filled = self.rows.withColumn(name, inside)
        if not self.sliced:
            return replace(self, rows=filled)
        # One row per slice of a hot key.
        per_slice = (
            self.rows.where(F.col(SLICE).isNotNull())
            .groupBy(self.key, SLICE)
            .agg(edge.alias("_own"))
        )
        edges = per_slice.select(self.key, SLICE, across().alias("_edge"))
        joined = filled.join(_beside(edges, self.few), [self.key, SLICE], "left")
        return replace(
            self, rows=joined.withColumn(name, F.coalesce(F.col(name), F.col("_edge"))).drop("_edge")
        )


def timeline(
    df: DataFrame,
    key: str,
    at: str,
    slicing: Slicing = Slicing(),
    measure: DataFrame | None = None,
    sizes: KeySizes | None = None,
) -> Timeline:
    """Order the rows of each key by ``at``, cutting hot keys into slices.

    ``measure`` is a cheaper frame with at least as many rows per key, to take
    the key sizes from; ``sizes`` are such sizes, measured before.
    """
    if sizes is None:
        sizes = key_sizes(key, df if measure is None else measure, slicing=slicing)
    if not sizes.any_hot:
        return Timeline(df, key, at, sliced=False)
    cuts = _cut_points(df, key, at, sizes)
    rows = _with_slice(df, key, at, cuts, sizes.few)
    return Timeline(rows, key, at, sliced=True, few=sizes.few)
