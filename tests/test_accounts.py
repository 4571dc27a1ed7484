"""Session sketches that merge, accounts of what streams drop, versions in a database, null keys."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreflow.functions.wire import decode_clicks
from oreflow.operators import keyed, windows
from oreflow.plans import bronze, gold, quality
from oreflow.sources import log
from oreflow.streaming import accounts, kpis
from oreflow.streaming.ingest import Run
from tests.builders import click, event, events, wire
from tests.conftest import SF_DIR, at, rows
from tests.test_streams import Log, finish
from verification.queries import queries


# --- sketches --------------------------------------------------------------
@pytest.mark.parametrize("width", ["1 hour", "1 day"])
def test_sessions_of_hours_and_days_from_minutes(spark, width):
    """9,000 sessions a day, each in several minutes; within 5 % of the exact count."""
    df = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(1_709_251_200) + F.col("id") * 4).alias("event_ts"),
        F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(9_000))).alias("session_id"))
    exact = df.groupBy(F.window("event_ts", width).alias("w")).agg(F.count_distinct("session_id").alias("n"))
    exact = {r["w"]["start"]: r["n"] for r in exact.collect()}
    sketches = windows.session_sketches(df)
    found = {r["window_start"]: r["sessions"] for r in windows.sessions_per(sketches, width).collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[w] - n) <= 0.05 * n for w, n in exact.items())
    # Neither the sum nor the maximum of the minutes is near.
    minutes = df.groupBy(F.window("event_ts", "1 minute").alias("w")).agg(F.count_distinct("session_id").alias("n"))
    total, most = minutes.agg(F.sum("n"), F.max("n")).first()
    assert total > 1.2 * max(exact.values()) or width == "1 hour"
    assert most < 0.1 * max(exact.values())


def test_hourly_query_is_close(spark):
    exact = queries()["bronze_events"](spark, SF_DIR).groupBy(F.window("event_ts", "1 hour").alias("w")).agg(
        F.count_distinct("session_id").alias("n")).select(F.col("w.start").alias("window_start"), "n")
    both = queries()["kpis_hourly_sessions"](spark, SF_DIR).join(exact, "window_start")
    worst, n = both.agg(F.max(F.abs(F.col("sessions") - F.col("n")) / F.col("n")), F.count("*")).first()
    assert n > 0 and worst <= 0.1


# --- streams ---------------------------------------------------------------
def test_stream_counts_reconcile_with_bronze(spark, tmp_path):
    """What the stream counted, dropped late and dropped as repeats is all of bronze."""
    clicks, kept = Log(spark, tmp_path / "log"), str(tmp_path / "accounts")
    listener = accounts.Accounts(spark, kept)
    spark.streams.addListener(listener)
    path, run = str(tmp_path / "kpis"), Run(str(tmp_path / "progress"), interval=None)
    try:
        steps = (["a", "b", "a"], [("c", "10:20:00")], ["late"], ["late2", ("d", "10:21:00"), ("d", "10:21:00")])
        for step in steps:
            clicks.add(*[wire(click(x) if isinstance(x, str) else click(x[0], ts=x[1])) for x in step])
            finish(kpis.run_kpis(clicks.stream(), kpis.versioned_files(path), run, once=True))
        for _ in range(100):  # progress is reported from another thread
            if accounts.read_accounts(spark, kept).agg(F.sum("read")).first()[0] == 8:
                break
            import time
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    landed = bronze.bronze_events(decode_clicks(log.file_batch(spark, clicks.path, topic="events")))
    out = accounts.reconciled(
        accounts.read_accounts(spark, kept), kpis.read_kpis(spark, path), landed, "kpis").first()
    assert out["bronze_rows"] == 8 and out["unexplained"] == 0
    assert (out["counted"], out["late"], out["repeats"]) == (4, 2, 2)


def test_session_sketches_stream(spark, tmp_path):
    clicks = Log(spark, tmp_path / "log")
    path, run = str(tmp_path / "sketches"), Run(str(tmp_path / "progress"), interval=None)
    for batch in ([("a", "10:00:01", "s1"), ("b", "10:01:00", "s1")], [("c", "10:01:30", "s2"), ("d", "11:00:00", "s1")]):
        clicks.add(*[wire(click(e, ts=t, session=s)) for e, t, s in batch])
        finish(kpis.run_session_sketches(clicks.stream(), kpis.versioned_files(path), run))
    assert [r["sessions"] for r in kpis.read_sessions(spark, path).orderBy("window_start").collect()] == [2, 1]
    assert [r["sessions"] for r in kpis.read_sessions(spark, path, width="1 day").collect()] == [2]


def test_accounts_of_a_batch_that_was_done_again(spark):
    rows_ = [("q", "r1", 0, 5, 1, 0), ("q", "r2", 0, 9, 2, 1), ("q", "r2", 1, 3, 0, 0), ("other", "r9", 0, 9, 9, 9)]
    kept = spark.createDataFrame(rows_, accounts.ACCOUNT)
    counted = spark.createDataFrame([(6,), (3,)], "events long")
    out = accounts.reconciled(kept, counted, spark.range(12), "q").first()
    assert tuple(out) == (9, 2, 1, 12, 0)
    none = accounts.reconciled(kept.limit(0), counted.limit(0), spark.range(2), "q").first()
    assert tuple(none) == (0, 0, 0, 2, 2)


# --- versions in a database ------------------------------------------------
def test_database_rows_carry_their_run(spark):
    """A run that lost its checkpoint counts batches from 0 again, and wins."""
    def batch(run, number, events_):
        df = spark.createDataFrame([(at("10:00"), events_)], "window_start timestamp, events long")
        return kpis.versioned_rows(df, run, number)

    table = batch(1_000, 7, 5).unionByName(batch(2_000, 0, 6)).unionByName(batch(2_000, 0, 6))
    assert {f.name: f.dataType.simpleString() for f in table.schema.fields}["run"] == "bigint"
    newest = keyed.latest_version(table, ["window_start"], ["run", "batch"])
    assert rows(newest, "run", "batch", "events") == [(2_000, 0, 6)]
    started = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    written = []

    class Frame:
        def __init__(self, df):
            self.df = df

        def withColumns(self, columns):  # noqa: N802
            written.append(self.df.withColumns(columns).first())
            raise RuntimeError("no database here")

    with pytest.raises(RuntimeError):
        kpis.database_rows("url", "t", {}, started)(
            Frame(spark.createDataFrame([(at("10:00"), 1)], "window_start timestamp, events long")), 3)
    assert written[0]["run"] == int(started.timestamp() * 1_000_000) and written[0]["batch"] == 3


# --- null keys -------------------------------------------------------------
def test_rows_without_a_key_are_found_and_spread(spark):
    now = F.lit("2024-03-02 00:00:00").cast("timestamp")
    clicks = events(spark, [event(f"e{k}", "purchase", "10:00", **({"order_id": str(k)} if k % 2 else {}))
                            for k in range(40)])
    history = spark.createDataFrame([(k,) for k in (*range(20), None)], "order_id long")
    missing = quality.unmatched_purchases(clicks, history, now)
    assert rows(missing, "event_id") == sorted((f"e{k}",) for k in range(40) if k % 2 == 0 or k >= 20)
    orders = spark.createDataFrame([(k, k % 5 or None, "paid") for k in range(20)],
                                   "order_id long, customer_id long, order_status string")
    known = spark.createDataFrame([(1,), (2,), (2,), (None,)], "customer_id long")
    lost = gold.facts_without_customer(orders, known)
    assert lost.columns == orders.columns
    assert rows(lost, "order_id") == sorted([(k,) for k in range(20) if k % 5 not in (1, 2)], key=repr)
    for frame in (missing, lost):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in plan and "LeftAnti" in plan


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    orders = spark.range(4_000).select(
        F.col("id").alias("order_id"), F.lit(None).cast("long").alias("customer_id"), F.lit("paid").alias("order_status"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        known = spark.range(10).select(F.col("id").alias("customer_id"))
        sizes = gold.facts_without_customer(orders, known).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 4_000 and max(r["count"] for r in sizes) < 1_000
