"""Repair of conversation structure by generalised LR parsing.

Conversations must read as an optional system turn and pairs of user and
assistant turns. An LR(0) automaton is built from that grammar. A
graph-structured stack walks all ways to delete, rerole, keep and insert turns
at once: stacks that are equal merge, and of the ways that reach one, the least
by (cost, audit) stays. The audit names the edits in order, one letter each.

Two audits that have consumed the same turns are never one the start of the
other, and different stacks have different audits. So an order of the stacks by
audit is carried from turn to turn, and audits are written once, at the end.

Conversations are cut into segments of bounded size. Those that cross a cut get
a table of costs from each entry stack to each exit stack; chaining the tables
gives every segment its own entry and exit, and all segments are then repaired
independently.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.frames import SPACES, cut, reachable

#: Role grammar over the initials of roles; the first rule starts.
RULES = (("start", ("talk",)), ("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")),
         ("pairs", ("pairs", "u", "a")), ("pairs", ("u", "a")))
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Turns of a segment are at most two to this power.
SEGMENT_BITS = 16

Stack = tuple[frozenset, ...]


def _closed(items: Iterable[tuple[int, int]]) -> frozenset:
    """Items (rule, place) with the rules that may begin at their places."""
    out, more = set(), list(items)
    while more:
        item = more.pop()
        if item in out:
            continue
        out.add(item)
        body = RULES[item[0]][1]
        if item[1] < len(body):
            more += [(i, 0) for i, (head, _) in enumerate(RULES) if head == body[item[1]]]
    return frozenset(out)


@lru_cache(maxsize=None)
def _goto(state: frozenset, symbol: str) -> frozenset | None:
    moved = [(r, at + 1) for r, at in state if RULES[r][1][at:at + 1] == (symbol,)]
    return _closed(moved) if moved else None


def _reduced(stack: Stack, rule: int) -> Stack:
    head, body = RULES[rule]
    below = stack[:len(stack) - len(body)]
    return (*below, _goto(below[-1], head))


def _complete(state: frozenset) -> list[int]:
    return [r for r, at in state if at == len(RULES[r][1]) and r]


@lru_cache(maxsize=None)
def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack behind one more symbol; None where the grammar has none there.

    No symbol can follow a finished talk, so a state that can shift does so;
    a state that holds one finished rule only is reduced at once.
    """
    state = _goto(stack[-1], symbol)
    if state is None:
        return None
    stack = (*stack, state)
    while len(stack[-1]) == 1 and _complete(stack[-1]):
        stack = _reduced(stack, _complete(stack[-1])[0])
    return stack


@lru_cache(maxsize=None)
def accepted(stack: Stack) -> bool:
    while _complete(stack[-1]):
        stack = _reduced(stack, _complete(stack[-1])[0])
    return (0, 1) in stack[-1]


def _stacks() -> list[Stack]:
    """All stacks: the grammar repeats on the left, so they are few."""
    found = [(_closed([(0, 0)]),)]
    for stack in found:
        found += [s for s in dict.fromkeys(shifted(stack, x) for x in "sua") if s and s not in found]
    return found


STACKS = _stacks()
NUMBER = {s: i for i, s in enumerate(STACKS)}


def _inserted(top: int) -> list[tuple[int, str]]:
    """(top, symbols) that inserts alone lead to, by the fewest of them."""
    found, seen = [(top, "")], {top}
    for at, symbols in found:
        for x in ROLES:
            stack = shifted(STACKS[at], x)
            if stack and NUMBER[stack] not in seen:
                seen.add(NUMBER[stack])
                found.append((NUMBER[stack], symbols + x))
    return found


@lru_cache(maxsize=None)
def moves(top: int, initial: str, truncated: bool) -> list[tuple[int, int, str, str]]:
    """(next top, cost, edits, symbols) for one turn that need not be deleted.

    Symbols are those of inserted and reroled turns, and of kept ones. Inserts
    before a delete are left out: behind it they cost as much and stand earlier.
    """
    best = {top: (DELETE, "D", "")}
    rest = TRUNCATED * truncated
    for at, symbols in _inserted(top):
        price = INSERT * len(symbols) + rest
        for edit, symbol, cost in (("K", initial, price), *(("R", x, price + REROLE) for x in ROLES)):
            stack = shifted(STACKS[at], symbol)
            if stack:
                way = (cost, "I" * len(symbols) + edit, symbols + symbol)
                best[NUMBER[stack]] = min(way, best.get(NUMBER[stack], way))
    return [(to, *way) for to, way in best.items()]


@lru_cache(maxsize=None)
def closing(top: int) -> str:
    """The inserts that end a conversation here."""
    return min((s for at, s in _inserted(top) if accepted(STACKS[at])), key=len)


class Walk:
    """All cheapest ways through the turns of a segment from one entry stack."""

    def __init__(self, entry: int) -> None:
        #: top: (cost, place of its audit in the order of all).
        self.tops = {entry: (0, 0)}
        self.links: list[dict[int, tuple[int, str, str]] | None] = []

    def delete(self, times: int) -> None:
        self.tops = {t: (c + DELETE * times, r) for t, (c, r) in self.tops.items()}
        self.links.append(None)

    def step(self, initial: str, truncated: bool) -> None:
        best: dict[int, tuple[int, int, str, int, str]] = {}
        for top, (cost, rank) in self.tops.items():
            for to, price, edits, symbols in moves(top, initial, truncated):
                way = (cost + price, rank, edits, top, symbols)
                if to not in best or way < best[to]:
                    best[to] = way
        order = sorted(best, key=lambda t: best[t][1:3])
        self.tops = {t: (best[t][0], i) for i, t in enumerate(order)}
        self.links.append({t: (w[3], w[2], w[4]) for t, w in best.items()})

    def end(self) -> int:
        """The top from which a conversation ends cheapest."""
        return min(self.tops, key=lambda t: (
            self.tops[t][0] + INSERT * len(closing(t)), self.tops[t][1]))

    def way(self, top: int) -> list[tuple[str, str] | None]:
        """(edits, symbols) of each step on the way to ``top``; None for deletes."""
        out: list[tuple[str, str] | None] = []
        for link in reversed(self.links):
            if link is None:
                out.append(None)
            else:
                top, edits, symbols = link[top]
                out.append((edits, symbols))
        return out[::-1]


def walked(turns: Iterable[tuple[str, int, str, int]], entry: int) -> Walk:
    """``turns`` are (initial, must be deleted, truncated, further copies)."""
    walk = Walk(entry)
    for initial, gone, truncated, copies in turns:
        if gone:
            walk.delete(1 + copies)
        else:
            walk.step(initial, truncated)
            if copies:
                walk.delete(copies)
    return walk


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with planted faults, nulls as one space.

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its
    text, 2 takes its ends of sentences, 3 repeats it, 4 makes the role user.
    """
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.withColumn("kind", kind).where("kind <> 0").withColumn("times", F.explode(times)).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(name("role")).alias("role"),
        text.alias("text"))


def _key(column: str) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def in_order(turns: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """(conv, at, segment, turn, role, text, n, fault) sorted over all partitions.

    ``turns`` has conv_id, turn, role and text; other columns are not read. Nulls
    in role and text count as one space. Turns stand by turn (null first), role
    and text; equal ones are one row with their number n, of which all but the
    first are duplicates. ``fault`` is that of the first: blank, duplicate of a
    turn with this role and text further up, truncated, or null.
    """
    space = F.lit(" ")
    equal = turns.select(
        _key("conv_id").alias("conv"), "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text")).groupBy("conv", "turn", "role", "text").agg(
        F.count("*").alias("n"))
    said = equal.withColumn("said", F.sha2(F.concat_ws("\n", F.length("role"), "role", "text"), 256))
    # Struct order puts null first, as the order of turns does.
    first = said.groupBy("conv", "said").agg(F.min(F.struct("turn")).alias("first"))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(
        F.struct("turn") != F.col("first"), "duplicate").when(
        ~F.col("text").rlike(rf"[.!?](?:{SPACES})?\z"), "truncated")
    order = ["conv", "turn", "role", "text"]
    rows = said.join(first, ["conv", "said"]).select(*order, "n", fault.alias("fault"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(placed.withColumn("at", F.monotonically_increasing_id()).withColumn(
        "segment", F.shiftright("at", segment_bits)))


def statistics(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal) of ``in_order`` rows, all long.

    Gaps are turn numbers missing between the first and the last; illegal are
    neighbours whose initials are not su, ua or au.
    """
    own = Window.partitionBy("conv", "segment").orderBy("at")
    initial = F.substring("role", 1, 1)
    rows = rows.select("conv", "segment", "at", "turn", "n", "fault", initial.alias("initial"))
    seen = rows.withColumn("before", F.lag("initial").over(own)).withColumn(
        "turn_before", F.lag("turn").over(own))

    def wrong(first: Column, second: Column) -> Column:
        return ~F.concat(first, second).isin("su", "ua", "au")

    later = F.when(F.col("fault").isin("blank", "duplicate"), F.col("n")).otherwise(F.lit(1))

    def counted(fault: str, number: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("fault") == fault, number)), F.lit(0)).alias(fault)

    repeats = F.sum(F.when(F.coalesce(F.col("fault") != "blank", F.lit(True)),
                           F.col("n") - F.when(F.col("fault") == "duplicate", 0).otherwise(1)).otherwise(0))
    segments = seen.groupBy("conv", "segment").agg(
        counted("blank", later), repeats.alias("duplicate"), counted("truncated", F.lit(1)),
        F.sum(F.col("n") - 1 + F.coalesce(wrong(F.col("before"), F.col("initial")).cast("int"), F.lit(0)))
        .alias("illegal"),
        F.count_if(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("turns"),
        F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.min_by("initial", "at").alias("first"), F.max_by("initial", "at").alias("last"))
    along = Window.partitionBy("conv").orderBy("segment")
    edges = segments.withColumn("before", F.lag("last").over(along)).withColumn(
        "high_before", F.lag("high").over(along))
    again = F.coalesce((F.col("low") == F.col("high_before")).cast("int"), F.lit(0))
    edge = F.coalesce(wrong(F.col("before"), F.col("first")).cast("int"), F.lit(0))
    return edges.groupBy("conv").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - again), F.lit(0))
        .cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + edge).cast("long").alias("illegal"))


def _turn(role: str, fault: str | None, n: int) -> tuple[str, int, bool, int]:
    return role[:1], fault in ("blank", "duplicate"), fault == "truncated", n - 1


def _tables(frame: pd.DataFrame) -> pd.DataFrame:
    """Costs and order of the audits from each entry to each exit of a segment."""
    turns = [_turn(*r) for r in frame.sort_values("at")[["role", "fault", "n"]].itertuples(index=False)]
    out = [(entry, top, cost, rank) for entry in range(len(STACKS))
           for top, (cost, rank) in walked(turns, entry).tops.items()]
    made = pd.DataFrame(out, columns=["entry", "exit", "cost", "rank"])
    return made.assign(conv=frame["conv"].iloc[0], segment=frame["segment"].iloc[0])


def _chained(frame: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit of each segment of a conversation, from its tables."""
    tops, chosen, names = {0: (0, 0)}, [], []
    for name, own in frame.sort_values("segment").groupby("segment", sort=True):
        best: dict[int, tuple[int, int, int, int]] = {}
        for entry, leave, cost, rank in own[["entry", "exit", "cost", "rank"]].itertuples(index=False):
            if entry in tops:
                way = (tops[entry][0] + cost, tops[entry][1], rank, entry)
                best[leave] = min(way, best.get(leave, way))
        order = sorted(best, key=lambda t: best[t][1:3])
        tops = {t: (best[t][0], i) for i, t in enumerate(order)}
        chosen.append({t: w[3] for t, w in best.items()})
        names.append(name)
    top = min(tops, key=lambda t: (tops[t][0] + INSERT * len(closing(t)), tops[t][1]))
    out = []
    for i in reversed(range(len(chosen))):
        out.append((names[i], chosen[i][top], top, i == len(chosen) - 1))
        top = chosen[i][top]
    made = pd.DataFrame(out, columns=["segment", "entry", "exit", "last"])
    return made.assign(conv=frame["conv"].iloc[0])


EDITS = "conv string, at long, step int, edit string, times long, role string, text string, cost long"


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 8_192) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _segment_edits(rows: list[tuple]) -> Iterator[tuple]:
    conv, entry, leave, last = rows[0][0], *rows[0][-3:]
    turns = [_turn(role, fault, n) for _, _, _, role, _, n, fault, *_ in rows]
    walk = walked(turns, entry or 0)
    top = walk.end() if leave is None else leave
    way = iter(walk.way(top))
    step = at = 0
    for (_, _, at, role, text, n, *_), (_, gone, truncated, copies) in zip(rows, turns, strict=True):
        step = 0
        if not gone:
            for edit, symbol in zip(*_spread(next(way)), strict=True):
                if edit == "I":
                    yield conv, at, step, "I", 1, ROLES[symbol], "", INSERT
                elif edit == "D":
                    yield conv, at, step, "D", 1, role, text, DELETE
                else:
                    cost = TRUNCATED * truncated + REROLE * (edit == "R")
                    yield conv, at, step, edit, 1, role if edit == "K" else ROLES[symbol], text, cost
                step += 1
        if gone or copies:
            next(way)
            times = n if gone else copies
            yield conv, at, step, "D", times, role, text, DELETE * times
            step += 1
    if last is None or last:
        for symbol in closing(top):
            yield conv, at, step, "I", 1, ROLES[symbol], "", INSERT
            step += 1


def _spread(way: tuple[str, str]) -> tuple[str, str]:
    """Edits with a symbol for each; a delete has none of its own."""
    return way[0], way[1] or " "


def edits(rows: DataFrame) -> DataFrame:
    """(conv, at, step, edit, times, role, text, cost): cheapest edits of ``in_order`` rows.

    Edits are K keep, R rerole, D delete (``times`` equal turns), I insert; role
    and text are those behind the edit, for D those that went. Ordered by (at,
    step) the turns that are not deleted read ``(s?(ua)+)?`` in initials. Of
    equally cheap repairs the one with the least audit is taken. A conversation
    of which nothing can stay ends empty; an empty table gives no rows.
    """
    spans = rows.groupBy("conv").agg(F.min("segment").alias("low"), F.max("segment").alias("high"))
    crossing = spans.where("low < high").select("conv")
    tables = reachable(rows).join(crossing, "conv").select(
        "conv", "segment", "at", "role", "fault", "n").groupBy("conv", "segment").applyInPandas(
        _tables, "entry int, exit int, cost long, rank int, conv string, segment long")
    chained = tables.groupBy("conv").applyInPandas(
        _chained, "segment long, entry int, exit int, last boolean, conv string")
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[c.split()[1]])
                        for c in EDITS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (e for _, own in groupby(_tuples(batches), key=itemgetter(0, 1))
                 for e in _segment_edits(list(own)))
        return _batched(found, schema)

    ready = rows.join(chained, ["conv", "segment"], "left").select(
        "conv", "segment", "at", "role", "text", "n", "fault", "entry", "exit", "last")
    return ready.repartition("conv", "segment").sortWithinPartitions(
        "conv", "segment", "at").mapInArrow(run, EDITS)


def digests(edited: DataFrame) -> DataFrame:
    """(conv, cost, audit, repaired_sha256) of ``edits``, read as a stream in order."""

    schema = pa.schema([("conv", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def read(conv: str, own: Iterator[tuple]) -> tuple[str, int, str, str]:
        total, audit, whole, between = 0, [], hashlib.sha256(), b""
        for _, _, _, edit, times, role, text, cost in own:
            total += cost
            audit.append(edit * times)
            if edit != "D":
                whole.update(between + f"{role}:{text}".encode())
                between = b"\n"
        return conv, total, "".join(audit), whole.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((read(k, own) for k, own in groupby(_tuples(batches), key=itemgetter(0))), schema)

    return reachable(edited).repartition("conv").sortWithinPartitions("conv", "at", "step").mapInArrow(
        run, "conv string, cost long, audit string, repaired_sha256 string")


def repaired(turns: DataFrame, faulty: DataFrame | None = None,
             segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """One row for each conv_id of ``turns``: faults found, cost, audit, digest.

    Repaired are the turns of ``faulty``, by default ``turns`` itself.
    Conversations that have none there come back with zeros, an empty audit and
    the digest of nothing; null is a conv_id like others.
    """
    rows = in_order(turns if faulty is None else faulty, segment_bits)
    whole = turns.select("conv_id", _key("conv_id").alias("conv")).distinct()
    found = whole.join(statistics(rows), "conv", "left").join(digests(edits(rows)), "conv", "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
             for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce(
        "repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
