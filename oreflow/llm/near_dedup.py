"""Near-duplicate documents by tensored MinHash banding, confirmed on full sets.

A document is the set of its five-word shingles. Two small collections of
sub-bands are made, names of two minima each: eight a collection at 0.85, ten at
0.80. The key of table (i, j) combines name i of the first collection with name
j of the second, so 32 minima give 64 tables of four rows, and 40 give 100. A
pair at the threshold misses all of them with probability below 0.0001.

A name that occurs once can't be part of a shared key, so it is dropped before
any keys are formed. Documents with equal sets are one node. Within a table
key, nodes are compared with the key's smallest node only; links are confirmed
on full sets and joined to components. Keys whose nodes are not all in one
component are then walked again: neighbours in the order of further names are
compared where the next name is equal, as long as that finds links.

What is then still mixed is settled exactly, by a prefix filter over the full
sets of its nodes. Shingles are ordered rarest first. Two sets that are alike
enough share a shingle among the first few of both, and what follows it bounds
what they can share in all; a bitmap of each set bounds how much they differ.
Only pairs in two components that pass all bounds are compared. A shingle's
largest component meets the others only, never itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.frames import components, cut, reachable

WORDS = 5
#: Minima of each sub-band, sub-bands of each collection at most, and minima of these.
ROWS, MOST_BANDS = 2, 64
MINIMA = 2 * MOST_BANDS * ROWS
#: Neighbours compared in keys that hold several components, if one more name is equal.
REACH = 2
#: Bits of the bitmap of a set.
BITS = 2_048

_random = np.random.default_rng(20_240_301)
_PLACE, _MULTIPLY, _SPREAD = (
    _random.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for n in (WORDS + 1, MINIMA, MINIMA))
#: Keeps short sequences apart from shingles.
_WIDTH = np.arange(WORDS + 1, dtype=np.uint64) * _PLACE[WORDS]


def sizes(percent: int) -> tuple[int, int]:
    """Sub-bands of each collection, and equal minima a pair must show before its
    sets are fetched.

    At the threshold a pair misses all tables with probability below 0.0001, and
    shows fewer equal minima with probability below 0.000001.
    """
    like = percent / 100
    bands = next((k for k in range(1, MOST_BANDS) if 2 * (1 - like ** ROWS) ** k < 1e-4), MOST_BANDS)
    n = 2 * bands * ROWS
    below, alike = 0.0, 0
    while alike < n:
        below += math.comb(n, alike) * like ** alike * (1 - like) ** (n - alike)
        if below >= 1e-6:
            break
        alike += 1
    return bands, alike


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; with fewer words, one of all of them."""
    words = text.lower().split()  # both ASCII only, as bytes
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter([digest(w) for w in words], np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    total = np.full(n, _WIDTH[width], np.uint64)
    for k in range(width):
        part = hashes[k:k + n] * _PLACE[k]
        total += part ^ (part >> np.uint64(31))
    total ^= total >> np.uint64(29)
    total *= _PLACE[0]
    return np.unique(total)


def minima(found: np.ndarray, bands: int) -> np.ndarray:
    out = np.empty(2 * bands * ROWS, np.uint64)
    for i in range(len(out)):
        mixed = found * _MULTIPLY[i]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _SPREAD[i]
        out[i] = mixed.min()
    return out


def names(least: np.ndarray) -> np.ndarray:
    """Names of the sub-bands of both collections, each with its place mixed in."""
    pairs = least.reshape(-1, ROWS)
    out = np.arange(len(pairs), dtype=np.uint64) * _PLACE[4]
    for k in range(ROWS):
        out = (out ^ pairs[:, k]) * _PLACE[k]
        out ^= out >> np.uint64(32)
    return out


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, bands: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, print, n, digest, names, minima); digest, names and minima are null without words.

    The print is a hash of the text, null as empty: rows of one id and print have one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2).cast(pa.binary()):
                found = shingles(value.as_py() or b"")
                if not len(found):
                    rows.append((0, None, None, None))
                    continue
                least = minima(found, bands)
                rows.append((
                    len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(),
                    names(least).view(np.int64), (least >> np.uint64(32)).astype(np.uint32).view(np.int32)))
            n, digest, name, least = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1), pa.array(n, pa.int64()),
                pa.array(digest, pa.binary()), pa.array(name, pa.list_(pa.int64())),
                pa.array(least, pa.list_(pa.int32()))], names=["id", "print", "n", "digest", "names", "minima"])

    return reachable(docs).select(F.col(key).cast("long").alias("id"), print_of(text), text).mapInArrow(
        run, "id long, print long, n long, digest binary, names array<long>, minima array<int>")


def print_of(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("print")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough; ``texts`` has node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] | None = None
        for batch in batches:
            kept = []
            columns = (batch.column("a"), *(
                batch.column(c).cast(pa.binary()) for c in ("a_text", "b_text")))
            for a, first, second in zip(*columns, strict=True):
                name = a.as_py()
                if last is None or last[0] != name:
                    last = (name, shingles(first.as_py()))
                kept.append(_similar(last[1], shingles(second.as_py()), percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    # Both sides grow with the data: no join may depend on pairs that fit a broadcast.
    texts = texts.hint("merge")
    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long").distinct()


def _sized(n: str, m: str, percent: int):
    """Whether sets of these sizes can be alike enough."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _alike(pairs: DataFrame, nodes: DataFrame, alike: int) -> DataFrame:
    """Pairs with enough equal minima."""
    least = nodes.select("node", "minima")
    met = pairs.join(least.toDF("a", "x").hint("merge"), "a").join(
        least.toDF("b", "y").hint("merge"), "b")
    equal = F.aggregate(F.zip_with("x", "y", lambda x, y: (x == y).cast("int")), F.lit(0),
                        lambda n, e: n + e)
    return met.where(equal >= alike).select("a", "b").distinct()


def _table_keys(nodes: DataFrame, bands: int) -> DataFrame:
    """(node, n, keys): keys of the tables in which both names are shared with another node."""
    each = nodes.select("node", "n", F.posexplode("names").alias("at", "name"))
    shared = each.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    found = each.join(shared, "name").groupBy("node", "n").agg(
        F.collect_set(F.when(F.col("at") < bands, F.col("name"))).alias("first"),
        F.collect_set(F.when(F.col("at") >= bands, F.col("name"))).alias("second"))
    keys = F.flatten(F.transform("first", lambda x: F.transform(
        "second", lambda y: F.xxhash64(x, y))))
    return found.select("node", "n", keys.alias("keys")).where(F.size("keys") > 0)


def bitmap(found: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in BITS parts of the hash range, as longs.

    Each shingle that only one of two sets has flips one parity, so bitmaps differ
    in no more bits than the sets differ in shingles.
    """
    counts = np.bincount((found >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _full_sets(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component, n, bits, tokens) of ``nodes`` (node, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(value.as_py()) for value in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["node", "component", "n", "bits", "tokens"])

    return nodes.join(texts.hint("merge"), "node").select("node", "component", "text").mapInArrow(
        run, "node long, component long, n long, bits array<long>, tokens array<long>")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(s, node, component, n, at, indexed): the shingles among which alike sets must meet.

    Shingles are ordered by the number of sets that have them, then by hash; ``at``
    is the place in that order. Those of one set only come first and meet nothing,
    so they are counted and not sorted. Of two sets the smaller (by n, node) shares
    one of its ``indexed`` shingles.
    """
    tokens = sets.select("node", "component", "n", F.explode("tokens").alias("s"))
    often = tokens.groupBy("s").agg(F.count("*").alias("often")).where("often > 1")
    shared = tokens.join(often, "s")
    own = Window.partitionBy("node")
    at = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("often", "s")) - 1
    n = F.col("n")
    probed = n - F.ceil(percent * n / 100) + 1
    indexed = n - F.ceil(2 * percent * n / (100 + percent)) + 1
    return shared.withColumn("at", at).where(F.col("at") < probed).select(
        "s", "node", "component", "n", "at", (F.col("at") < indexed).alias("indexed"))


def _candidates(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of two components that pass all bounds."""
    prefixes = cut(_prefixes(sets, percent))
    parts = prefixes.groupBy("s", "component").agg(F.count("*").alias("c")).groupBy("s").agg(
        F.max_by("component", "c").alias("main"), F.count("*").alias("parts")).where("parts > 1")
    met = cut(prefixes.join(parts.select("s", "main"), "s").join(
        sets.select("node", "bits").hint("merge"), "node"))
    x, y = met.where("component <> main").alias("x"), met.alias("y")

    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    both = of("x", "n") + of("y", "n")
    least = F.ceil(percent * both / (100 + percent))
    smaller = F.struct(of("x", "n"), of("x", "node")) < F.struct(of("y", "n"), of("y", "node"))
    behind = F.least(of("x", "n") - of("x", "at"), of("y", "n") - of("y", "at"))
    differ = F.aggregate(F.zip_with(of("x", "bits"), of("y", "bits"), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                         F.lit(0), lambda n, k: n + k)
    pairs = x.join(y, (of("x", "s") == of("y", "s")) & (of("x", "component") != of("y", "component")) & (
        (of("y", "component") == of("y", "main")) | (of("x", "node") < of("y", "node"))) & (
        100 * F.least(of("x", "n"), of("y", "n")) >= percent * F.greatest(of("x", "n"), of("y", "n"))) & F.when(
        smaller, of("x", "indexed")).otherwise(of("y", "indexed")) & (behind >= least) & (
        differ <= both - 2 * least))
    return pairs.select(F.least(of("x", "node"), of("y", "node")).alias("a"),
                        F.greatest(of("x", "node"), of("y", "node")).alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row.

    Rows link where 100 * intersection >= percent * union of their shingle sets.
    component_id is the smallest key reachable, the row's own included, and kept
    says whether that is its own. Null, empty and blank texts have no shingles
    and no links. Repeated rows come back each; rows of one key with different
    texts have the component of their own text. Rows without a key take no part:
    their component is null and they are kept. An empty table gives no rows;
    columns beside key and text are not read. ``docs`` must give the same rows
    again.
    """
    found = _grouped(docs, percent, key, text)
    kind = docs.schema[key].dataType
    return found.select(
        F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"),
        F.col("component").cast(kind).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"))


def distinct_documents(docs: DataFrame, percent: int = 80, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one of the smallest key.

    Decided for each row, not each key: rows of one key with different texts may
    be in two groups. Of rows equal in key and text one stays, whichever comes
    first; of one key with several texts in a group the one with the smallest
    print. Rows without a key and rows without words all stay, repeated ones too.
    """
    found = _grouped(docs, percent, key, text).where("id is not null and digest is not null")
    chosen = found.groupBy("component").agg(F.min(F.struct("id", "print")).alias("x")).select("x.id", "x.print")
    columns = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = docs.select(F.col(key).cast("long").alias("id"), print_of(text), columns, (
        F.col(key).isNull() | ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("apart"))
    # Equal rows go inside each task before they move.
    one = rows.where("not apart").groupBy("id", "print").agg(F.first("row").alias("row"))
    return one.join(chosen.hint("merge"), ["id", "print"], "left_semi").select("row.*").unionByName(
        rows.where("apart").select("row.*"))


def _grouped(docs: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    """(id, print, n, digest, component) for every row; component is an id."""
    bands, alike = sizes(percent)
    signed = cut(signatures(docs, bands, key, text))
    worded = signed.where("digest is not null and id is not null")
    # One node for each set, numbered in the order of ids: the smallest node of a
    # component then has its smallest id.
    sets = worded.groupBy("digest").agg(
        F.min(F.struct("id", "print")).alias("x"), F.first("n").alias("n"), F.first("names").alias("names"),
        F.first("minima").alias("minima")).select("digest", "x.*", "n", "names", "minima")
    nodes = cut(sets.repartitionByRange("id", "print", "digest").sortWithinPartitions(
        "id", "print", "digest").withColumn("node", F.monotonically_increasing_id()))
    keys = cut(_table_keys(nodes, bands))
    members = keys.select("node", "n", F.explode("keys").alias("key"))
    hubs = members.groupBy("key").agg(
        F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("most")).where(
        "hub.node < most").select("key", F.col("hub.node").alias("a"), F.col("hub.n").alias("m"))
    stars = members.join(hubs, "key").where("node <> a").where(_sized("n", "m", percent)).select(
        "a", F.col("node").alias("b")).distinct()
    tested = cut(_alike(stars, nodes, alike))
    # Only rows that share a key can be fetched. Their number grows with the data,
    # so the join must not depend on whether their ids fit a broadcast. Equal rows
    # go inside each task before they move.
    ids = keys.select("node").distinct().join(nodes.select("node", "id", "print"), "node")
    source = docs.select(F.col(key).cast("long").alias("id"), print_of(text),
                         F.coalesce(text, F.lit("")).alias("text")).where("id is not null")
    texts = cut(source.groupBy("id", "print").agg(F.first("text").alias("text")).join(
        ids.hint("merge"), ["id", "print"]).select("node", "text"))
    links = cut(_confirmed(tested, texts, percent))
    grouped = cut(components(links))
    order = nodes.select("node", "names")
    turn = 0
    while True:
        placed = keys.join(grouped, "node", "left").join(order, "node").select(
            "node", "n", F.coalesce("component", "node").alias("component"), "keys", "names")
        spread = placed.select("*", F.explode("keys").alias("key"))
        mixed = spread.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high")).where(
            "low < high").select("key")
        rows = spread.select("key", "node", "n", "component", *[
            F.get("names", F.pmod(F.col("key") + turn + k, F.lit(2 * bands)).cast("int")).alias(f"n{k}")
            for k in (0, 5)]).join(mixed, "key")
        along = Window.partitionBy("key").orderBy("n0", "n5", "node")
        ahead = [F.lead(F.struct("node", "n", "component", "n0"), k).over(along).alias(f"x{k}")
                 for k in range(1, REACH + 1)]
        others = F.filter(F.array(*[f"x{k}" for k in range(1, REACH + 1)]), lambda x: (
            x["component"] != F.col("component")) & (x["n0"] == F.col("n0")))
        near = rows.select("node", "n", "component", "n0", *ahead).select(
            "node", "n", F.explode(others).alias("x"))
        pairs = near.where(_sized("n", "x.n", percent)).select(
            F.least("node", "x.node").alias("a"), F.greatest("node", "x.node").alias("b")).distinct()
        fresh = cut(_alike(pairs.join(tested, ["a", "b"], "left_anti"), nodes, alike))
        more = cut(_confirmed(fresh, texts, percent))
        if more.isEmpty():
            break
        links, tested, turn = links.unionByName(more), tested.unionByName(fresh), turn + 1
        grouped = cut(components(links))
    open_ = rows.select("node", "component").distinct()
    fresh = _candidates(cut(_full_sets(open_, texts)), percent).join(tested, ["a", "b"], "left_anti")
    rest = cut(_confirmed(cut(fresh), texts, percent))
    if not rest.isEmpty():
        grouped = cut(components(links.unionByName(rest)))
    of_node = nodes.select(F.col("node").alias("component"), F.col("id").alias("least"))
    grouped = grouped.join(of_node, "component").select("node", "least")
    whole = nodes.select("digest", "node", F.col("id").alias("own")).join(grouped, "node", "left")
    found = signed.join(whole, "digest", "left")
    return found.select("id", "print", "n", "digest", F.when(
        F.col("id").isNotNull(), F.coalesce("least", "own", "id")).alias("component"))
