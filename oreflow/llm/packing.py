"""Best-fit packing by sums of squares.

Documents become token pieces of at most ``length`` tokens; pieces are then
packed into sequences. The state of a packer is how many sequences are open for
every residual gap. A piece goes where the sum of the squares of these counts
becomes smallest, a new sequence included; so no gap piles up that later pieces
can't close.

Only lengths matter for that, so the rows that move are narrow. Pieces are
dealt into groups of about ``group_pieces`` by a hash, and each group is packed
on its own, longest first: the number of groups follows the data, and a group
leaves a few sequences open at most. What lies in poorly filled sequences
of all groups is dealt again, as long as that leaves at most half of the pieces
loose. Where lengths have no partners it doesn't: then all loose pieces are
packed at once by the same rule from the counts per length, of which there are
``length`` at most, and rows take their places by rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.frames import cut, reachable
from oreflow.llm.word_bpe import encoder

LENGTH, GROUP_PIECES = 2048, 50_000
#: Packing from counts deals at least this part of the pieces of a length at once.
PART = 16


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """(key, piece, start, length, ids): ids as little-endian unsigned 32-bit numbers.

    A document is its ids and then ``end_id``; null and empty texts have only
    that. Only longer ones are cut, into pieces of ``length``, the last as long
    as what remains. Repeated rows are documents of their own.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        closing = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            at, number, start, size, ids = [], [], [], [], []
            for i, value in enumerate(batch.column(1).cast(pa.binary())):
                data = own.encode(value.as_py() or b"") + closing
                for k in range(0, len(data), 4 * length):
                    part = data[k:k + 4 * length]
                    at.append(i)
                    number.append(k // (4 * length))
                    start.append(k // 4)
                    size.append(len(part) // 4)
                    ids.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[key, "piece", "start", "length", "ids_crc32", "ids"])

    return reachable(docs).select(key, text).mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def squares(sizes: np.ndarray, length: int) -> np.ndarray:
    """Sequence number of each piece, in the given order; numbers count from 0."""
    open_at: list[list[int]] = [[] for _ in range(length + 1)]
    counts = np.zeros(length + 1, np.int64)
    placed = np.empty(len(sizes), np.int64)
    made = 0
    for i, s in enumerate(sizes.tolist()):
        if s == length:
            placed[i], made = made, made + 1
            continue
        # From gap g to g - s: -2 n(g) + 1, and + 2 n(g - s) + 1 unless it closes.
        gaps = counts[s:length]
        change = 2 * (counts[:length - s] - gaps) + 2
        change[0] = 1 - 2 * gaps[0]
        change[gaps == 0] = 1 << 40
        best = int(change.argmin())
        if change[best] <= 2 * counts[length - s] + 1:
            gap = best + s
            where = open_at[gap].pop()
            counts[gap] -= 1
            left = gap - s
        else:
            where, left = made, length - s
            made += 1
        placed[i] = where
        if left:
            open_at[left].append(where)
            counts[left] += 1
    return placed


def repacked(sizes: np.ndarray, length: int, rounds: int = 8) -> np.ndarray:
    """Sequence numbers after packing and, as long as it helps, packing loose ones again.

    Longest pieces come first. Then the pieces of sequences below some fill are
    packed anew by the same rule, and the outcome is kept where it is shorter.
    """
    order = np.argsort(-sizes, kind="stable")
    numbers = np.empty(len(sizes), np.int64)
    numbers[order] = squares(sizes[order], length)
    for _ in range(rounds):
        before = numbers.max() + 1
        for least in (0.9, 0.98, 1.0):
            fill = np.bincount(numbers, sizes)
            loose = fill < least * length
            rows = order[loose[numbers[order]]]
            again = squares(sizes[rows], length)
            if len(rows) and again.max() + 1 < loose.sum():
                names = np.r_[np.flatnonzero(loose)]
                numbers[rows] = names[again]
                numbers = np.unique(numbers, return_inverse=True)[1]
        if numbers.max() + 1 == before:
            break
    return numbers


def by_counts(counts: dict[int, int], length: int) -> list[tuple[int, int, int, int, int]]:
    """The shorter of two packings by counts: as the sums of squares have it, a new
    sequence included, and with new sequences only where no open one has room."""
    plans = [_by_counts(counts, length, frugal) for frugal in (False, True)]
    return min(plans, key=lambda plan: max((first + n for _, _, n, first, _ in plan), default=0))


def _by_counts(counts: dict[int, int], length: int, frugal: bool) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, ranks, first sequence, offset): sums of squares, longest first, in bulk.

    Rank r of a size lies in the sequence as far behind the first one as r is
    behind the first rank. Sequences with equal contents are kept as ranges. The
    rule is that of ``squares``, for many pieces at a time. As each piece that goes
    into a gap makes the next one there dearer by at most 4, and any other gap
    cheaper by at most 2, as many go at once as leave their gap the best choice,
    and at least a PART of what is left: where two choices cost the same, pieces
    would otherwise go one by one.
    """
    out = []
    open_at: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]
    opened = np.zeros(length + 1, np.int64)
    made = 0
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        if size == 0:
            out.append((size, 0, left, 0, 0))
            made = max(made, left)
            continue
        while left:
            least = -(-left // PART)
            gaps = opened[size:length]
            change = 2 * (opened[:length - size] - gaps) + 2
            if len(change):
                change[0] = 1 - 2 * gaps[0]
                change[gaps == 0] = 1 << 60
            fresh = 2 * int(opened[length - size]) + 1 if size < length else 1
            if frugal and len(change) and change.min() < 1 << 60:
                fresh = 1 << 60
            order = np.argsort(change, kind="stable")[:2]
            best = int(change[order[0]]) if len(order) else 1 << 60
            if best <= fresh and best < 1 << 60:
                gap = int(order[0]) + size
                other = min(int(change[order[1]]) if len(order) > 1 else 1 << 60, fresh)
                if frugal:
                    other = int(change[order[1]]) if len(order) > 1 else 1 << 60
                start, n = open_at[gap].pop()
                took = min(n, left, max(least, (other - best) // 6))
                if took < n:
                    open_at[gap].append((start + took, n - took))
                opened[gap] -= took
            else:
                # Never more than hold what is left, each as full as it gets.
                gap, enough = length, -(-left // (length // size))
                took = enough if best == 1 << 60 and frugal else min(enough, max(least, (best - fresh) // 6))
                start, made = made, made + took
            out.append((size, rank, took, start, length - gap))
            if gap > size:
                open_at[gap - size].append((start, took))
                opened[gap - size] += took
            rank, left = rank + took, left - took
    return out


def _from_counts(
    rows: DataFrame, columns: list[str], length: int, groups: int, level: int, numbered: int
) -> DataFrame:
    """All rows packed by ``by_counts``; ranks come from counts per group and length."""
    keyed = rows.withColumn("packing_group", F.pmod(F.xxhash64(F.lit(level), *columns), F.lit(groups)))
    counted = cut(keyed.groupBy("length", "packing_group").agg(F.count("*").alias("c")))
    totals = {r["length"]: r["c"] for r in counted.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    plan = sorted(by_counts(totals, length))
    size, rank, _, first, offset = (np.array(x, np.int64) for x in zip(*plan, strict=True))
    base = counted.select("length", "packing_group", (F.sum("c").over(
        Window.partitionBy("length").orderBy("packing_group")) - F.col("c")).alias("base"))
    own = F.row_number().over(Window.partitionBy("packing_group", "length").orderBy(*columns))
    ranked = keyed.withColumn("own", own).join(base, ["length", "packing_group"]).select(
        *columns, (F.col("base") + F.col("own") - 1).alias("rank"))

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begins = {x: (np.searchsorted(size, x), np.searchsorted(size, x, "right")) for x in set(size.tolist())}
        for frame in frames:
            at = np.empty(len(frame), np.int64)
            sizes, ranks = frame["length"].to_numpy(np.int64), frame["rank"].to_numpy(np.int64)
            for x in np.unique(sizes).tolist():
                low, high = begins[x]
                mine = sizes == x
                at[mine] = low + np.searchsorted(rank[low:high], ranks[mine], "right") - 1
            frame = frame.drop(columns="rank")
            frame["sequence_id"] = numbered + first[at] + ranks - rank[at]
            frame["offset"] = offset[at]
            frame["packed"] = True
            yield frame

    schema = rows.select(*columns).schema.simpleString()[7:-1]
    return reachable(ranked).mapInPandas(placed, f"{schema}, sequence_id long, offset long, packed boolean")


def _packer(columns: list[str], length: int, groups: int, numbered: int, last: bool, well_filled: float):
    """Packs the rows of one group; its sequences are numbered apart from all others."""

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["packing_group"].iloc[0])
        frame = frame.sort_values(columns, kind="stable")
        sizes = frame["length"].to_numpy(np.int64)
        numbers = repacked(sizes, length)
        order = np.argsort(numbers, kind="stable")
        ends = np.cumsum(sizes[order])
        first = np.r_[True, numbers[order][1:] != numbers[order][:-1]] if len(order) else []
        base = np.maximum.accumulate(np.where(first, ends - sizes[order], 0))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = ends - sizes[order] - base
        fill = np.bincount(numbers, sizes)[numbers]
        frame["sequence_id"] = numbered + numbers * groups + group
        frame["offset"] = offset
        frame["packed"] = last | (fill >= well_filled * length)
        return frame.drop(columns="packing_group")

    return packed


def pack(sized: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES,
         well_filled: float = 0.98) -> DataFrame:
    """Rows of ``sized`` with sequence_id and offset; column ``length`` holds the sizes.

    ``sized`` must be a stored table or otherwise give the same rows again; it
    is read once for its count and once per level. All rows come back, each
    once; sequence numbers have gaps, offsets within a sequence have none. An
    empty table gives no rows.
    """
    columns = [c for c in sized.columns if c not in ("sequence_id", "offset")]
    sized = reachable(sized).select(*columns)
    schema = sized.schema.simpleString()[7:-1]
    rows, level, done = sized, 0, []
    shuffle = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before, numbered = None, 0
    while True:
        total = rows.count()
        groups = max(1, round(total / group_pieces))
        last = groups == 1
        if not last and before is not None and 2 * total > before:
            done.append(_from_counts(rows, columns, length, groups, level, numbered))
            break
        before = total

        keyed = rows.withColumn(
            "packing_group", F.pmod(F.xxhash64(F.lit(level), *columns), F.lit(groups)))
        result = keyed.repartition(min(groups, 4 * shuffle), "packing_group").groupBy(
            "packing_group").applyInPandas(
            _packer(columns, length, groups, numbered, last, well_filled),
            f"{schema}, sequence_id long, offset long, packed boolean")
        if last:
            done.append(result)
            break
        result = cut(result)
        done.append(result.where("packed"))
        rows = result.where("not packed").select(*columns)
        # A group has at most as many sequences as there are pieces in all.
        level, numbered = level + 1, numbered + (total + 1) * groups
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("packed")
