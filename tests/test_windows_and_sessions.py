"""KPI windows, gap sessions, session facts, funnel, rankings, empty slots."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from oreflow.operators import sessions, windows
from oreflow.plans import pulse
from tests.builders import event, events
from tests.conftest import at, rows


def test_kpis(spark):
    df = events(spark, [
        event("a", ts="10:00:00", session="s1"),
        event("b", "purchase", ts="10:00:59", session="s1", order_value="2.5"),
        event("c", "purchase", ts="10:00:30", session="s2", order_value="junk"),
        event("d", ts="10:01:00", session=None),
    ])
    out = windows.window_kpis(df, exact=True)
    assert rows(out, "events", "sessions", "purchases", "revenue") == [(1, 0, 0, 0.0), (3, 2, 2, 2.5)]
    assert rows(out) == rows(windows.window_kpis(df))


def test_recent_kpis_takes_windows_after_the_mark(spark):
    df = spark.createDataFrame(
        [(at("10:00"), at("10:01"), 1, 1, 0, 0.0), (at("10:01"), at("10:02"), 2, 1, 0, 1.005)],
        "window_start timestamp, window_end timestamp, events long, sessions long, purchases long, revenue double",
    )
    out = windows.recent_kpis(df, F.lit("2024-03-01 10:10:00").cast("timestamp"))
    assert rows(out, "events") == [(2,)]


def test_gap_sessions_equal_a_loop(spark):
    rng = random.Random(11)
    data = []
    for user in range(6):
        t = 0
        for _ in range(200 if user == 0 else 30):
            t += rng.choice([1, 5, 60, 1_799, 1_800, 1_801, 4_000])
            data.append((user, at("00:00") + dt.timedelta(seconds=t)))
    data += [data[0]] * 50
    df = spark.createDataFrame(data, "u int, event_ts timestamp").repartition(6)
    expected = []
    for user in range(6):
        line = sorted(t for u, t in data if u == user)
        start, last, n = line[0], line[0], 0
        for t in line:
            if (t - last).total_seconds() > 1_800:
                expected.append((user, start, last + dt.timedelta(minutes=30), n))
                start, n = t, 0
            last, n = t, n + 1
        expected.append((user, start, last + dt.timedelta(minutes=30), n))
    naive = [(u, s.replace(tzinfo=None), e.replace(tzinfo=None), n) for u, s, e, n in expected]
    assert rows(sessions.gap_sessions(df, "u")) == sorted(naive, key=repr)


def test_gap_sessions_equal_the_session_window(spark):
    df = events(spark, [
        event(str(i), ts=f"{10 + i // 6}:{(i * 10) % 60:02d}:00", session=f"s{i % 2}") for i in range(30)
    ])
    own = sessions.gap_sessions(df, "session_id", gap_minutes=15)
    builtin = (
        df.groupBy("session_id", F.session_window("event_ts", "15 minutes").alias("w"))
        .agg(F.count("*").alias("events"))
        .select("session_id", "w.start", "w.end", "events")
    )
    assert rows(own) == rows(builtin)


def test_session_facts_and_funnel(spark):
    df = events(spark, [
        event("1", "product_view", "10:00:00", "s1"), event("2", "add_to_cart", "10:01:00", "s1"),
        event("3", "begin_checkout", "10:02:00", "s1"), event("4", "purchase", "10:03:00", "s1"),
        event("5", "product_view", "10:00:00", "s2"), event("6", "add_to_cart", "10:00:30", "s2"),
        event("7", "page_view", "10:00:00", "s3"), event("8", "purchase", "10:00:10", "s3"),
        event("9", "product_view", session=None),
    ])
    assert rows(sessions.session_facts(df), "session_id", "pages", "converted", "duration_seconds") == [
        ("s1", 1, True, 180.0), ("s2", 1, False, 30.0), ("s3", 1, True, 10.0)
    ]
    assert rows(sessions.funnel(df), "stage_no", "sessions", "rate_from_previous") == [
        (1, 2, 1.0), (2, 2, 1.0), (3, 1, 0.5), (4, 1, 1.0)
    ]


def test_funnel_of_nothing(spark):
    out = sessions.funnel(events(spark, [event("1", "page_view")])).collect()
    assert [(r.sessions, r.rate_from_first) for r in out] == [(0, None)] * 4


def test_top_per_window(spark):
    df = spark.createDataFrame(
        [("w", p, 10 - p % 3) for p in range(9)], "month string, product_id int, revenue int"
    )
    order = [F.desc("revenue"), F.asc("product_id")]
    assert rows(windows.top_per_window(df, ["month"], order, 4), "product_id") == [(0,), (1,), (3,), (6,)]


def test_empty_slots_and_rates(spark):
    df = spark.createDataFrame([(at(t),) for t in ("10:00", "10:04", "10:16", "10:31")], "kafka_ts timestamp")
    empty = [r.slot_start.minute for r in windows.empty_slots(df, "kafka_ts", 5).orderBy("slot_start").collect()]
    assert empty == [5, 10, 20, 25]
    flood = spark.createDataFrame([(at("10:00"),)] * 601 + [(at("10:10"),)] * 600, "kafka_ts timestamp")
    assert rows(pulse.dead_letter_rate(flood), "rows") == [(601,)]


def test_speed_against_batch_keeps_both_sides(spark):
    left = spark.createDataFrame([(at("10:00"), 3), (at("10:01"), 1)], "window_start timestamp, events long")
    right = spark.createDataFrame([(at("10:00"), 4), (at("10:02"), 2)], "window_start timestamp, events long")
    assert rows(pulse.speed_against_batch(left, right), "speed_value", "batch_value", "missing") == [
        (1, None, -1), (3, 4, 1), (None, 2, 2)
    ]
