"""Ordered operators under key skew: the sliced form must equal a plain loop."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from oreflow.operators import ordered
from oreflow.operators.ordered import Slicing, key_sizes, timeline
from oreflow.operators.scd import asof_join, scd2
from oreflow.plans.silver import life_line
from tests.conftest import at, rows

START = at("2024-01-01 00:00:00")
PLAIN, SLICED = Slicing(), Slicing(rows_per_slice=20)


def minutes(n):
    return START + dt.timedelta(minutes=n)


def skewed(seed, n=600, keys=8, share=0.4, span=5_000):
    """(key, minute) pairs; key 0 holds ``share`` of them; times are unique per key."""
    rng, seen, out = random.Random(seed), set(), []
    while len(out) < n:
        key = 0 if rng.random() < share else rng.randrange(1, keys)
        pair = (key, rng.randrange(span))
        if pair not in seen:
            seen.add(pair)
            out.append(pair)
    return out


def test_sizes_count_all_frames(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    sizes = key_sizes("k", a, b, slicing=Slicing(rows_per_slice=2))
    assert (sizes.hot, sizes.limit, sizes.any_hot) == (1, 2, True)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k int, t timestamp, v int")
    line = timeline(empty, "k", "t", SLICED).with_previous(F.col("v"), "p")
    assert not line.sliced and line.done().count() == 0


@pytest.mark.parametrize("slicing", [PLAIN, SLICED], ids=["plain", "sliced"])
def test_neighbours_equal_a_loop(spark, slicing):
    data = [(k, minutes(m), None if m % 7 == 0 else m) for k, m in skewed(1)]
    df = spark.createDataFrame(data, "k int, t timestamp, v int").repartition(5)
    line = timeline(df, "k", "t", slicing)
    assert line.sliced == (slicing is SLICED)
    found = (
        line.with_previous(F.col("v"), "p").with_next(F.col("t"), "n").carry_forward("v").done()
    )
    expected, by_key = [], {}
    for k, t, v in sorted(data, key=lambda r: (r[0], r[1])):
        by_key.setdefault(k, []).append((t, v))
    for k, items in by_key.items():
        last = None
        for i, (t, v) in enumerate(items):
            last = v if v is not None else last
            expected.append((
                k, t.replace(tzinfo=None), last,
                "first" if i == 0 else items[i - 1][1],
                None if i + 1 == len(items) else items[i + 1][0].replace(tzinfo=None),
            ))
    got = [
        (r.k, r.t, r.v, "first" if r.p is None else r.p.v, None if r.n is None else r.n.v)
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_hot_key_is_cut_into_balanced_slices(spark):
    data = [(k, minutes(m)) for k, m in skewed(2, n=4_000, span=50_000)]
    df = spark.createDataFrame(data, "k int, t timestamp")
    line = timeline(df, "k", "t", Slicing(rows_per_slice=1_000))
    sizes = {
        r["_slice"]: r["count"]
        for r in line.rows.where("k = 0").groupBy("_slice").count().collect()
    }
    assert len(sizes) >= 2 and max(sizes.values()) < 1_600
    assert line.rows.where("k <> 0 and _slice is not null").count() == 0


def test_many_hot_keys_are_joined_instead_of_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(k, t) for k in range(10) for t in range(10)], "k int, t int")
    few = timeline(df, "k", "t", Slicing(rows_per_slice=3)).with_next(F.col("t"), "n").done()
    monkeypatch.setattr(ordered, "MAX_HOT_KEYS", 4)
    sizes = key_sizes("k", df, slicing=Slicing(rows_per_slice=3))
    assert (sizes.limit, sizes.hot, sizes.few) == (3, 10, False)
    many = timeline(df, "k", "t", Slicing(rows_per_slice=3)).with_next(F.col("t"), "n").done()
    assert rows(many, "k", "t", "n.v") == rows(few, "k", "t", "n.v")


def changes(spark, seed):
    """Change history with a hot key, ties, repeats, deletes and null values."""
    rng, out, offset = random.Random(seed), [], 0
    for k, m in skewed(seed, n=500):
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            offset += 1
            op = "d" if rng.random() < 0.1 else "u"
            out.append((k, rng.choice(["a", "b", None]), op, minutes(m), offset, 0))
    return out


def loop_scd2(data):
    settled = {}
    for k, v, op, t, offset, _ in data:
        if (k, t) not in settled or settled[k, t][0] < offset:
            settled[k, t] = (offset, "gone" if op == "d" else ("alive", v))
    out, by_key = [], {}
    for (k, t), (_, state) in sorted(settled.items(), key=lambda i: (i[0][0], i[0][1])):
        line = by_key.setdefault(k, [])
        if not line or line[-1][1] != state:
            line.append((t.replace(tzinfo=None), state))
    for k, line in by_key.items():
        for i, (t, state) in enumerate(line):
            if state != "gone":
                end = line[i + 1][0] if i + 1 < len(line) else None
                out.append((k, state[1], t, end, end is None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slicing", [PLAIN, SLICED], ids=["plain", "sliced"])
@pytest.mark.parametrize("seed", [3, 4])
def test_scd2_equals_a_loop(spark, slicing, seed):
    data = changes(spark, seed)
    df = spark.createDataFrame(
        data, "k int, v string, op string, changed_at timestamp, kafka_offset long, kafka_partition int"
    ).repartition(4)
    out = scd2(df, "k", ["v"], "sk", slicing)
    assert rows(out, "k", "v", "valid_from", "valid_to", "is_current") == loop_scd2(data)
    assert out.select("sk").distinct().count() == out.count()


@pytest.mark.parametrize("slicing", [PLAIN, SLICED], ids=["plain", "sliced"])
def test_asof_join_equals_a_loop(spark, slicing):
    data = changes(spark, 5)
    history = spark.createDataFrame(
        data, "k int, v string, op string, changed_at timestamp, kafka_offset long, kafka_partition int"
    )
    versions = scd2(history, "k", ["v"], "sk", PLAIN)
    rng = random.Random(6)
    facts = [(i, rng.choice([0, 0, 0, 1, 2, 99]), minutes(rng.randrange(-50, 5_100)))
             for i in range(300)]
    # Many facts at one instant, facts exactly on a version start, and nulls.
    facts += [(1_000 + i, 0, minutes(2_500)) for i in range(200)]
    facts += [(2_000 + i, k, t) for i, (k, _, _, t, _, _) in enumerate(data[:80])]
    facts += [(3_000, None, minutes(1)), (3_001, 1, None)]
    df = spark.createDataFrame(facts, "id int, k int, t timestamp")
    got = rows(asof_join(df, versions, "k", "t", ["sk", "v"], slicing), "id", "k", "t", "v")
    intervals = loop_scd2(data)

    def lookup(k, t):
        return next((v for vk, v, lo, hi, _ in intervals
                     if k is not None and t is not None and vk == k and lo <= t
                     and (hi is None or t < hi)), None)

    naive = [(i, k, None if t is None else t.replace(tzinfo=None)) for i, k, t in facts]
    assert got == sorted(((i, k, t, lookup(k, t)) for i, k, t in naive), key=repr)


@pytest.mark.parametrize("slicing", [PLAIN, SLICED], ids=["plain", "sliced"])
def test_life_line_with_equal_times(spark, slicing):
    data = [(0, "s", "u", minutes(i // 3), i, 0) for i in range(90)]
    data += [(k, "s", "u", minutes(1), k, 0) for k in range(1, 5)]
    df = spark.createDataFrame(
        data, "k int, v string, op string, changed_at timestamp, kafka_offset long, kafka_partition int"
    )
    out = life_line(df, "k", ["v"], slicing)
    spent = {r.kafka_offset: r.seconds_in_state for r in out.where("k = 0").collect()}
    assert [spent[i] for i in range(89)] == [60.0 if i % 3 == 2 else 0.0 for i in range(89)]
    assert spent[89] is None and out.count() == len(data)
