"""Line dedup over a suffix array of line ids, in DataFrame operations only.

Each text is the sequence of the ids of its lines. Prefix doubling names the
suffixes: the name for depth 2h at a line joins the names for depth h there and
h lines on, so a few rounds reach any depth, and a depth in between joins two
that overlap. Suffixes of one name share their first lines: they are an
interval of the suffix array whose longest common prefix has that depth. A
repeated run counts if it has ``run`` lines, or one line of ``least_chars``
characters; the lines of such runs are what intervals show at depths ``run`` and
1, and deeper ones don't change them, so names go no deeper and the intervals are
not put in order. All suffixes of an interval but the first are later copies, and
the lines they begin with go. Neighbouring ones merge into maximal runs.

Names are pairs of 64-bit hashes, built where the text is. Only names and
places travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.frames import SPACES, once

#: Least lengths of a run: lines of any length, or characters of a single one.
RUN, LEAST_CHARS = 2, 60


def _joined(first: Column, second: Column) -> Column:
    return F.struct(
        F.xxhash64(F.lit(0), first["a"], first["b"], second["a"], second["b"]).alias("a"),
        F.xxhash64(F.lit(1), first["a"], first["b"], second["a"], second["b"]).alias("b"))


def _longer(step: int) -> Column:
    """Names that join each name with the one ``step`` places on."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("names") - 1 - step),
                        lambda i: _joined(F.get("names", i), F.get("names", i + step)))
    return F.when(F.size("names") > step, pairs).otherwise(
        F.array().cast("array<struct<a:bigint,b:bigint>>"))


def _window(s: Column, at: Column, name: Column, chars: Column) -> Column:
    return F.struct(s.alias("s"), at.alias("at"), name["a"].alias("a"), name["b"].alias("b"), chars.alias("chars"))


def named(ids: DataFrame, depth: int) -> DataFrame:
    """Names for ``depth`` in column ``names``, an array as long as there are suffixes."""
    reached = 1
    while reached < depth:
        step = min(reached, depth - reached)
        ids = once(ids, longer=_longer(step)).drop("names").withColumnRenamed("longer", "names")
        reached += step
    return ids


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                run: int = RUN, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with its text column cut, and n_lines, n_removed (long).

    A line goes if it lies in ``run`` or more consecutive lines that also start
    earlier: in a smaller key, or in the same text further up. A line of at least
    ``least_chars`` characters goes if it alone starts earlier. Overlaps count,
    and runs are judged on the input. Lines without a word belong to no run and
    stay. Null keys sort first; rows equal in key and text count as one and come
    back with the same result. Null texts stay null and have no lines; an empty
    table gives no rows. Columns n_lines and n_removed of ``docs`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*kept, F.xxhash64(key, text).alias("row_hash"))
    parts = once(rows.select(F.col(key).alias("k"), "row_hash", F.col(text).alias("t"))
                 .where("t is not null"), lines=F.split("t", "\n")).drop("t")
    ids = once(parts, ids=F.filter(
        F.transform("lines", lambda x, i: F.struct(
            i.alias("i"), F.struct(F.xxhash64(F.lit(0), x).alias("a"),
                                   F.xxhash64(F.lit(1), x).alias("b")).alias("name"),
            F.char_length(x).alias("chars"), (F.regexp_replace(x, SPACES, "") != "").alias("worded"))),
        lambda x: x["worded"])).drop("lines")
    alone = F.filter(F.transform("ids", lambda x, s: _window(s, F.array(x["i"]), x["name"], x["chars"])),
                     lambda w: (w["chars"] >= least_chars) & F.lit(run > 1))
    ids = once(ids, at=F.transform("ids", lambda x: x["i"]), alone=alone,
               names=F.transform("ids", lambda x: x["name"])).drop("ids")
    windows = F.transform("names", lambda n, s: _window(s, F.slice("at", s + 1, run), n, F.lit(0)))
    suffixes = named(ids, run).select("k", "row_hash", F.inline(F.concat(windows, "alone"))).drop("chars")
    place = F.struct("k", "row_hash", "s")
    intervals = suffixes.groupBy("a", "b").agg(
        F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    later = suffixes.join(intervals, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    gone = later.select("k", "row_hash", F.explode("at").alias("line")).groupBy("k", "row_hash").agg(
        F.collect_set("line").alias("gone"))
    found = rows.join(
        gone, rows["row_hash"].eqNullSafe(gone["row_hash"]) & rows[key].eqNullSafe(gone["k"]), "left")
    split = found.select(*[rows[c] for c in kept], "gone", F.split(text, "\n").alias("lines"))
    last = F.size("lines") - 1
    stays = F.when(F.col("gone").isNotNull(), F.array_except(F.sequence(F.lit(0), last), "gone"))
    whole = once(split, stays=stays)
    cut_text = F.when(F.col("gone").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform("stays", lambda i: F.get("lines", i)), "\n"))
    return whole.select(
        *[cut_text.alias(c) if c == text else F.col(c) for c in kept],
        F.when(F.col(text).isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
