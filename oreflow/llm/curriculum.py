"""Mixing sources by a time-varying curriculum, in DataFrame operations only.

Every source has a schedule: its weight over training time, 0 to 1, linear
between knots. The integral of a schedule over the whole time is the source's
share of the words; its integral up to a time, in proportion, is what the
source has delivered by then. The documents of a source stand in a fixed random
order and are dealt again from the start when a source is used up. So each copy
begins at a known number of words, and inverting the integral gives the
training time at which that number is reached. All copies are range-sorted by
that time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.frames import cut

#: (time, weight) knots from time 0 to 1.
Schedule = Sequence[tuple[float, float]]
#: Rows numbered in one task, and parts in which rows equal in all keys are numbered.
BLOCK_ROWS, PARTS = 200_000, 64
#: Bits of the hash that orders the documents of a source.
BITS = 60


def integrals(schedule: Schedule) -> list[float]:
    """Integral of a schedule up to each of its knots."""
    out = [0.0]
    for (t, w), (u, x) in zip(schedule, schedule[1:]):
        out.append(out[-1] + (u - t) * (w + x) / 2)
    return out


def time_of(schedule: Schedule, part: Column) -> Column:
    """Time at which a schedule has delivered ``part``, 0 to 1, of its integral."""
    sums = integrals(schedule)
    reached = part * sums[-1]
    out = F.lit(float(schedule[-1][0]))
    for i in reversed(range(len(schedule) - 1)):
        (t, w), (u, x) = schedule[i], schedule[i + 1]
        more = reached - sums[i]
        root = F.sqrt(F.greatest(F.lit(float(w * w)) + 2 * (x - w) / (u - t) * more, F.lit(0.0)))
        ahead = F.coalesce(F.try_divide(2 * more, w + root), F.lit(0.0))
        out = F.when(reached < sums[i + 1], t + ahead).otherwise(out)
    return out


def targets(sources: DataFrame, budget: float, most: int) -> DataFrame:
    """``sources`` with target: shares of ``budget`` by weight, at most ``most`` sizes.

    What a full source can't take is shared again by weight. Filling one source
    can only raise the shares of the others, so the full ones grow to a fixed
    set; each round sends two sums to the driver. ``sources`` has source_size and
    weight, and must give the same rows again.
    """
    most_words = F.col("source_size") * most
    left, weights = budget, sources.agg(F.sum("weight")).first()[0] or 0.0
    while True:
        share = F.try_divide(F.lit(left) * F.col("weight"), F.lit(weights))
        full = F.coalesce(share > most_words, F.lit(True))
        sums = sources.agg(
            F.sum(F.when(full, most_words)), F.sum(F.when(~full, F.col("weight")))).first()
        now = budget - float(sums[0] or 0), sums[1] or 0.0
        if now == (left, weights):
            return sources.withColumn(
                "target", F.when(full, most_words.cast("double")).otherwise(share))
        left, weights = now


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with nth: 0, 1, ... among rows equal in all keys, in any order.

    Such rows may be a third of the table, so they are numbered in parts.
    ``rows`` has a stored column part.
    """
    counts = rows.groupBy(*keys, "part").agg(F.count("*").alias("here"))
    along = Window.partitionBy(*keys).orderBy("part")
    first = counts.select(*keys, "part", F.coalesce(F.sum("here").over(
        along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first")).where("first > 0")
    own = rows.withColumn("own", F.row_number().over(
        Window.partitionBy(*keys, "part").orderBy("part")) - 1)
    same = [own[k].eqNullSafe(first[k]) for k in (*keys, "part")]
    return own.join(first, same, "left").select(
        *[own[c] for c in rows.columns],
        (F.col("own") + F.coalesce("first", F.lit(0))).cast("long").alias("nth"))


def mix(docs: DataFrame, size: Column, schedules: Sequence[Schedule], share: float = 1.5,
        most: int = 2, key: str = "doc_id", source: str = "source",
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(row, nth, size, source, source_size, target, copy, words, position) for each copy.

    Sources stand in code-point order, null last, and take ``schedules`` in turn.
    They share ``share`` times all sizes by the integrals of their schedules;
    none takes more than ``most`` times its size. The copy in which a source
    reaches its target, rounded to whole words, gives only its first ``words``
    words, so targets are met exactly. Documents that the mix leaves out, those
    of size 0 among them, come back once with null copy and position and 0 words.
    The result is sorted by position over all partitions; position is the time
    at which half of a copy's words are due.

    The order within a source is a hash of key, size and nth, which numbers rows
    equal in source, key and size; so reruns agree, and such rows get places of
    their own. A null key counts as empty, a null size as 0. The row is the
    input's, as a struct, so its column names can't clash. An empty table gives
    no rows. ``docs`` must give the same rows again. The table of sources is
    ranked in one task: it has one row for each source.
    """
    equal = ["source", "key", "size"]
    rows = cut(docs.select(
        F.struct(*docs.columns).alias("row"), F.col(source).alias("source"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int").alias("part")))
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    bits = max(0, min(40, (max(1, -(-count // block_rows)) - 1).bit_length()))
    digest = F.md5(F.concat_ws(":", "key", "size", "nth").cast("binary"))
    placed = _numbered(rows, equal).withColumn(
        "spot", F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long"))
    block = F.shiftright("spot", BITS - bits) if bits else F.lit(0).cast("long")
    placed = cut(placed.drop("part").withColumn("block", block))

    blocks = placed.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    sums = [integrals(s)[-1] for s in schedules]
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", F.pmod(number, F.lit(len(schedules))).cast("int").alias("schedule"))
    sources = sources.withColumn("weight", F.element_at(
        F.array(*map(F.lit, map(float, sums))), F.col("schedule") + 1))
    filled = targets(cut(sources), share * (total or 0), most).withColumnRenamed("source", "s")
    before = F.coalesce(F.sum("block_size").over(Window.partitionBy("source").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select(F.col("source").alias("s"), F.col("block").alias("b"), before.alias("before"))
    starts = starts.join(filled.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t")

    inside = Window.partitionBy("source", "block").orderBy("spot", "key", "size", "nth").rowsBetween(
        Window.unboundedPreceding, -1)
    own = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    found = own.join(starts, own["source"].eqNullSafe(F.col("s")) & (own["block"] == F.col("b")))
    quota = F.floor(F.col("target") + 0.5)

    def taken(copy: Column) -> Column:
        start = F.col("before") + F.col("inside") + copy * F.col("source_size")
        words = F.greatest(F.least("size", quota - start), F.lit(0)).cast("long")
        part = F.try_divide(start + words / 2, F.col("target"))
        time = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            time = F.when(F.col("schedule") == i, time_of(schedule, part)).otherwise(time)
        return F.struct(copy.alias("copy"), words.alias("words"), time.alias("position"))

    copies = F.filter(F.array(*[taken(F.lit(i)) for i in range(most)]), lambda c: c["words"] > 0)
    each = found.withColumn("taken", F.explode_outer(copies)).select(
        "row", "nth", "size", "source", "source_size", "target", "spot", "taken.copy",
        F.coalesce("taken.words", F.lit(0)).cast("long").alias("words"), "taken.position")
    order = [F.col("position").asc_nulls_last(), F.col("spot")]
    return each.repartitionByRange(*order).sortWithinPartitions(*order).drop("spot")
