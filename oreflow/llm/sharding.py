"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by a hash of their key columns, a fixed random permutation.
The boundaries between shards are found by probing: each round counts the exact
bytes below candidate boundaries over all partitions, keeps for every boundary
the two probes around its target, and probes finer between them, until what
lies below meets the tolerance or no key is left between. Then the rows move
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.frames import cut

#: Positions are hashes of 62 bits, so differences of two fit a long.
BITS = 62
LOW, HIGH = 0, 2 ** BITS
#: Probes of a round over all boundaries, and rows numbered in one task.
PROBES, BLOCK_ROWS = 4_096, 200_000


def _probe(brackets: list[tuple[int, int]], each: int) -> Column:
    """Number of the probe interval of ``position``; null outside of all brackets."""
    cases = " ".join(
        f"when position >= {low}L and position < {high}L "
        f"then {i * each}L + (position - {low}L) div {-(-(high - low) // each)}L"
        for i, (low, high) in enumerate(brackets))
    return F.expr(f"case {cases} end")


def splitters(sizes: DataFrame, shards: int, tolerance: float) -> list[int]:
    """Keys at which the shards 1, 2, ... start; ``sizes`` has position and size.

    Collects at most ``PROBES`` counts a round.
    """
    total = sizes.agg(F.sum("size")).first()[0] or 0
    targets = [total * i / shards for i in range(1, shards)]
    slack = tolerance * total / shards
    # For each boundary: (low key, bytes below it, high key, bytes below that).
    state = [(LOW, 0, HIGH, total) for _ in targets]
    found: list[int | None] = [None] * len(targets)
    while True:
        for i, (low, below, high, upto) in enumerate(state):
            if found[i] is None and (
                    min(abs(below - targets[i]), abs(upto - targets[i])) <= slack or high - low <= 1):
                found[i] = low if abs(below - targets[i]) <= abs(upto - targets[i]) else high
        brackets = sorted({(s[0], s[2]) for s, f in zip(state, found, strict=True) if f is None})
        if not brackets:
            return [f for f in found if f is not None]
        each = max(2, PROBES // len(brackets))
        counted = (
            sizes.withColumn("probe", _probe(brackets, each))
            .where("probe is not null").groupBy("probe").agg(F.sum("size").alias("size")).collect())
        seen = {r["probe"]: int(r["size"]) for r in counted}
        start = {(s[0], s[2]): s[1] for s in state}
        for i, (low, _, high, _) in enumerate(state):
            if found[i] is not None:
                continue
            n, width = brackets.index((low, high)), -(-(high - low) // each)
            below = start[low, high]
            for k in range(each):
                here = seen.get(n * each + k, 0)
                if below + here >= targets[i]:
                    state[i] = (low + k * width, below, min(high, low + (k + 1) * width), below + here)
                    break
                below += here
            else:
                state[i] = (high, below, high, below)


def shard(docs: DataFrame, size: Column, shards: int = 16, keys: tuple[str, ...] = ("doc_id",),
          tolerance: float = 0.001, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with shard_bytes, shard, slot: shards of nearly equal summed size.

    A boundary misses its target by ``tolerance`` of a mean shard at most, or by
    the one key that lies across it; so shards differ by little more than their
    largest rows. Slots number the rows of a shard from 0 without gaps in hash
    order, then by ``keys`` and size. Rows with equal keys stay in one shard.
    Null keys hash like others; a null size counts as 0. An empty table gives no
    rows. Columns of these names in ``docs`` are replaced.

    ``docs`` must give the same rows again. Numbering runs in blocks of a hash
    range, whose counts give the first slot of each.
    """
    names = ("shard_bytes", "shard", "slot")
    kept = [c for c in docs.columns if c not in names]
    rows = docs.select(*kept, F.coalesce(size, F.lit(0)).cast("long").alias("shard_bytes"),
                       F.shiftrightunsigned(F.xxhash64(*keys), 64 - BITS).alias("position"))
    sizes = cut(rows.select("position", F.col("shard_bytes").alias("size")))
    starts = splitters(sizes, shards, tolerance)
    count = sizes.count()
    bits = max(0, min(40, (max(1, -(-count // block_rows)) - 1).bit_length()))

    def placed(df: DataFrame) -> DataFrame:
        number = F.lit(0)
        for s in starts:
            number = number + (F.col("position") >= s).cast("int")
        block = F.lit(0).cast("long") if not bits else F.shiftright("position", BITS - bits).cast("long")
        return df.withColumn("shard", number).withColumn("block", block)

    counts = placed(sizes).groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(
        F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("position", *keys, "shard_bytes")
    return placed(rows).withColumn("nth", F.row_number().over(inside)).join(
        first, ["shard", "block"]).select(
        *kept, "shard_bytes", "shard", (F.col("first") + F.col("nth") - 1).alias("slot"))
