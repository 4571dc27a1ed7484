"""What survives replays, erasures, restarts, damage and jobs that died."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from oreflow.functions.wire import Payload, decode_clicks
from oreflow.operators import keyed, windows
from oreflow.operators.checks import QualityGateError
from oreflow.plans import bronze, jobs, pulse, silver, upkeep
from oreflow.schemas import CDC_TABLES
from oreflow.sources import tables
from oreflow.streaming import ingest, kpis
from tests.builders import HEADER, cdc, change, click, event, events, order, record, records, wire
from tests.conftest import at, rows

ORDERS = CDC_TABLES["orders"]


def typed(spark, *changes):
    return silver.typed_changes(cdc(spark, list(changes)), ORDERS)


CREATE = change("orders", "c", "10:00", after=order(1), offset=1)
DELETE = change("orders", "d", "10:05", before=order(1), offset=2)
LATE = change("orders", "u", "10:03", before=order(1), after=order(1, "paid"), offset=9)
AGAIN = change("orders", "c", "10:09", after=order(1, "shipped"), offset=12)


def test_replay_after_a_delete_brings_nothing_back(spark):
    state = typed(spark, CREATE).limit(0)
    for batch in ([CREATE], [DELETE], [CREATE], [LATE], [DELETE, CREATE]):
        state = keyed.merge_changes(state, typed(spark, *batch), "order_id")
    assert keyed.live_rows(state).count() == 0 and rows(state, "op") == [("d",)]
    state = keyed.merge_changes(state, typed(spark, AGAIN), "order_id")
    assert rows(keyed.live_rows(state), "order_id", "status") == [(1, "shipped")]


def test_old_markers_are_forgotten(spark):
    state = typed(spark, DELETE)
    mark = F.lit("2024-03-01 10:06:00").cast("timestamp")
    kept = keyed.merge_changes(state, typed(spark, CREATE).limit(0), "order_id")
    gone = keyed.merge_changes(state, typed(spark, CREATE).limit(0), "order_id", mark)
    assert kept.count() == 1 and gone.count() == 0


def test_merge_rewrites_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "state")
    first = typed(spark, *[change("orders", "c", "10:00", after=order(k), offset=k) for k in range(40)])
    assert tables.merge_table(spark, path, first, "order_id", 8) == 8
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("*.parquet") if "_merging" not in str(p)}
    assert tables.merge_table(spark, path, typed(spark, LATE), "order_id", 8) == 1
    after = {p.name for p in (tmp_path / "state").rglob("*.parquet") if "_merging" not in str(p)}
    assert len(set(before) - after) == 1
    state = spark.read.parquet(path)
    assert state.count() == 40 and rows(state.where("order_id = 1"), "status") == [("paid",)]
    assert tables.merge_table(spark, path, first.limit(0), "order_id", 8) == 0


def test_increments_equal_a_rebuild(spark, tmp_path):
    root = str(tmp_path / "silver")
    clicks = [event("a", ts="10:00"), event("a", ts="10:00", ingested="10:05", offset=3),
              event("b", ts="10:01", ingested="10:06"), event("c", ts="10:02", ingested="10:07")]
    feed = [CREATE, change("customers", "c", "10:00", after={"customer_id": "7", "email": "e", "full_name": "Ann"}, offset=3),
            change("products", "c", "10:01", after={"product_id": "3", "unit_price": "1.5"}, offset=4), LATE, DELETE]
    for n_clicks, n_feed in ((1, 2), (3, 4), (4, 5), (4, 5)):
        jobs.hourly_increment(spark, events(spark, clicks[:n_clicks]), cdc(spark, feed[:n_feed]), root, "salt", 4)
    landed = spark.read.parquet(f"{root}/events")
    assert rows(landed, "event_id", "ingested_at") == [
        (e, at(t).replace(tzinfo=None)) for e, t in (("a", "10:00:01"), ("b", "10:06"), ("c", "10:07"))]
    history = spark.read.parquet(f"{root}/orders_history")
    assert rows(history, "kafka_offset") == [(1,), (2,), (9,)]
    current = spark.read.parquet(f"{root}/orders_current")
    assert keyed.live_rows(current).count() == 0 and current.count() == 1
    person = spark.read.parquet(f"{root}/customers_current").first()
    assert person.full_name == "A." and person.email != "e" and len(person.email) == 64
    assert spark.read.parquet(f"{root}/marks").count() == 6


DAMAGE = [
    lambda p: p[:-30], lambda p: p + b"}", lambda p: p + b"," + p, lambda p: p.replace(b'"event_ts": ', b'"event_ts": "x'),
    lambda p: json.dumps({**json.loads(p), "event_ts": "soon"}).encode(),
    lambda p: json.dumps({**json.loads(p), "customer_id": {}}).encode(), lambda p: b"[" + p + b"]", lambda p: b"",
]


@pytest.mark.parametrize("kind", range(len(DAMAGE)))
def test_damaged_payloads_are_quarantined_whole(spark, kind):
    good = json.dumps(click("a", x=1)).encode()
    value = HEADER + DAMAGE[kind](good)
    decoded = decode_clicks(records(spark, [record(value, 1), record(HEADER + good + b" \n", 2)]))
    assert rows(decoded.where("is_valid"), "offset") == [(2,)]
    assert bytes(bronze.bad(decoded).first().value) == value


def test_every_entry_point_takes_avro(spark, tmp_path):
    schema = '{"type": "record", "name": "E", "fields": [{"name": "event_id", "type": "string"}]}'
    avro, log = Payload("avro", schema), records(spark, [record(wire(click("a")), 1)])
    run = ingest.Run(str(tmp_path / "p"), None)
    calls = [
        lambda: decode_clicks(log, avro), lambda: bronze.split_counts(log, avro),
        lambda: kpis.live_events(log, avro), lambda: ingest.land_events(log, "x", run, avro),
        lambda: ingest.land_quarantine(log, "x", run, avro), lambda: ingest.send_quarantine(log, "s", "t", run, avro),
        lambda: upkeep.replay(bronze.dead_letters(log), lambda r: r, log, avro),
        lambda: ingest.run_ingest(log, log, "x", run, avro), lambda: kpis.run_kpis(log, print, run, avro),
        lambda: kpis.run_product_counts(log, print, run, avro), lambda: kpis.run_sessions(log, "x", run, payload=avro),
    ]
    for call in calls:  # the module with the codec is not here; nothing else may be missing
        with pytest.raises((PySparkException, TypeError)) as error:
            call()
        assert "avro" in str(error.value).lower() or "JavaPackage" in str(error.value)


def test_failed_gates_are_kept(spark, tmp_path):
    from oreflow.operators.checks import Check, run_gate

    df, path = spark.range(3), str(tmp_path / "results")
    with pytest.raises(QualityGateError):
        run_gate([Check("all", df, "id")], results_path=path)
    run_gate([Check("none", df, "id", F.col("id") > 9)], results_path=path)
    assert rows(spark.read.parquet(path), "check", "violations") == [("all", 3), ("none", 0)]


def test_builds_that_died_do_not_count(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS durable")
    name = "durable.t"
    for v in range(3):
        tables.replace_table(spark, name, spark.range(v, v + 1))
    for k in range(6):  # left by jobs that were stopped before the view moved
        spark.range(9).write.saveAsTable(f"{name}__v2099010100000{k}000000")
    now = dt.datetime.now(dt.timezone.utc)
    assert [r.id for r in tables.version_as_of(spark, name, now).collect()] == [2]
    assert len(tables.versions(spark, name)) == 3
    gone = tables.expire_versions(spark, name, dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc), keep=1)
    assert len(gone) == 8 and [r.id for r in spark.table(name).collect()] == [2]
    spark.sql("DROP DATABASE durable CASCADE")


def test_kpis_outlive_a_lost_checkpoint(spark, tmp_path):
    path, closed = str(tmp_path / "kpis"), str(tmp_path / "closed")

    def batch(*items):
        return spark.createDataFrame([(at(t), n) for t, n in items], "window_start timestamp, events long")

    start = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    first = kpis.versioned_files(path, start)
    first(batch(("10:00", 1), ("10:01", 5)), 0)
    first(batch(("10:00", 2)), 7)
    again = kpis.versioned_files(path, start + dt.timedelta(hours=1))
    again(batch(("10:02", 4)), 0)
    again(batch(("10:02", 4)), 0)
    again(batch(("10:00", 3)), 1)
    expected = [(at(t).replace(tzinfo=None), n) for t, n in (("10:00", 3), ("10:01", 5), ("10:02", 4))]
    assert rows(kpis.read_kpis(spark, path), "window_start", "events") == expected
    for _ in range(2):
        kpis.fold_days(spark, path, closed, dt.date(2024, 3, 2))
    assert rows(kpis.read_kpis(spark, closed), "window_start", "events") == expected
    assert rows(kpis.read_kpis(spark, path, closed), "window_start", "events") == expected
    assert kpis.read_kpis(spark, path, since=dt.date(2024, 3, 2)).count() == 0


def test_compaction_leaves_large_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.range(2_000).withColumn("d", F.col("id") % 2).withColumn("x", F.uuid())
    rows_.repartition(1).write.partitionBy("d").parquet(path)
    large = {p.name for p in (tmp_path / "t").rglob("part-*.parquet")}
    size = min(p.stat().st_size for p in (tmp_path / "t").rglob("part-*.parquet"))
    rows_.limit(40).repartition(8).write.mode("append").partitionBy("d").parquet(path)
    out = upkeep.compact_small_files(spark, path, ["d"], target_bytes=size)
    assert out["written"] == 2 and out["read"] >= 4
    after = [p for p in (tmp_path / "t").rglob("part-*.parquet")]
    assert large <= {p.name for p in after} and len(after) == 4
    assert spark.read.parquet(path).count() == 2_040
    assert upkeep.compact_small_files(spark, path, ["d"], target_bytes=size) == {"read": 0, "written": 0}


def test_a_stall_that_lasts_is_seen(spark):
    df = spark.createDataFrame([(at("10:01"),), (at("10:16"),)], "t timestamp")

    def empty(until=None):
        until = until and F.lit(f"2024-03-0{until}").cast("timestamp")
        return [r[0].strftime("%d %H:%M") for r in windows.empty_slots(df, "t", 5, until).orderBy(1).collect()]

    assert empty() == ["01 10:05", "01 10:10"]
    assert empty("1 10:29") == ["01 10:05", "01 10:10", "01 10:20"]
    assert len(empty("3 10:20")) == 2 + 2 * 288
    assert windows.empty_slots(df.limit(0), "t", 5).count() == 0


def test_a_bad_record_at_the_end_is_not_lag(spark):
    log = records(spark, [record(b"x", o) for o in range(100, 105)] + [record(b"x", 50, partition=1)])
    handled = spark.createDataFrame([("events", 0, 103), ("events", 0, 104)], "topic string, partition int, offset long")
    assert rows(pulse.offset_lag(log, handled)) == [("events", 1, False)]
    starts = spark.createDataFrame([("events", 1, 40)], "topic string, partition int, offset long")
    assert rows(pulse.offset_lag(log, handled, starts=starts)) == [("events", 11, False)]
