"""Streams over log files: sinks, restarts, late data, duplicates, sessions."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from oreflow.operators.windows import window_kpis
from oreflow.plans import bronze
from oreflow.functions.wire import decode_clicks
from oreflow.sources import log
from oreflow.streaming import ingest, kpis
from oreflow.streaming.ingest import Run
from tests.builders import change, click, order, record, records, wire
from tests.conftest import at, rows

BAD = b'{"broken": true}'


class Log:
    """A topic log in a folder; every ``add`` is one file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files, self.offset = spark, str(path), 0, 0

    def add(self, *values, arrival="10:00:00", topic="events", partition=0):
        out = []
        for value in values:
            out.append(record(value, self.offset, arrival, topic=topic, partition=partition))
            self.offset += 1
        records(self.spark, out).coalesce(1).write.mode("append").parquet(self.path)
        self.files += 1

    def stream(self, **options):
        options.setdefault("topic", "events")
        return log.file_stream(self.spark, self.path, **options)


@pytest.fixture
def clicks(spark, tmp_path):
    return Log(spark, tmp_path / "log")


@pytest.fixture
def run(tmp_path):
    return Run(str(tmp_path / "progress"), interval=None)


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_resumes_without_loss_or_repeats(spark, tmp_path, clicks, run):
    root = str(tmp_path / "bronze")
    clicks.add(wire(click("a")), BAD, None, wire(click("b", ts="23:59:59")))
    changes = Log(spark, clicks.path)
    changes.offset = 100
    changes.add(change("orders", "c", "10:00", after=order(1))[2].encode(), topic="cdc.store.public.orders")
    changes.add(change("products", "c", "10:00", after={})[2].encode(), topic="cdc.store.public.products")

    def once():
        queries = ingest.run_ingest(
            clicks.stream(), log.file_stream(spark, clicks.path, pattern=r"cdc\.store\.public\..*"), root, run
        )
        ingest.wait(spark, queries)

    once()
    events = lambda: spark.read.parquet(f"{root}/events")
    assert rows(events(), "event_id", "kafka_offset") == [("a", 0), ("b", 3)]
    dead = spark.read.parquet(f"{root}/quarantine").orderBy("offset").collect()
    assert [None if r.value is None else bytes(r.value) for r in dead] == [BAD, None]
    raw = spark.read.parquet(f"{root}/cdc_raw")
    assert rows(raw, "topic") == [("cdc.store.public.orders",), ("cdc.store.public.products",)]
    assert json.loads(raw.where("topic like '%orders'").first().value)["op"] == "c"

    once()
    clicks.offset = 10
    clicks.add(wire(click("c")), BAD)
    once()
    assert rows(events(), "event_id") == [("a",), ("b",), ("c",)]
    assert spark.read.parquet(f"{root}/quarantine").count() == 3
    assert rows(events().where("event_date = '2024-03-01'"), "event_id") == [("a",), ("b",), ("c",)]


def test_admission_limit_and_start_position(spark, tmp_path, clicks, run):
    for i in range(3):
        clicks.add(wire(click(str(i))), arrival=f"10:0{i}:00")
    query = ingest.land_events(clicks.stream(files_per_trigger=1), str(tmp_path / "out"), run)
    finish(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    live = clicks.stream(since=F.lit("2024-03-01 10:01:00").cast("timestamp"))
    finish(ingest.land_events(live, str(tmp_path / "live"), Run(str(tmp_path / "live-progress"), None)))
    assert rows(spark.read.parquet(str(tmp_path / "live")), "event_id") == [("1",), ("2",)]


def test_readers_are_independent(spark, tmp_path, clicks, run):
    clicks.add(wire(click("a")))
    finish(ingest.land_events(clicks.stream(), str(tmp_path / "one"), run))
    clicks.add(wire(click("b")))
    finish(ingest.land_events(clicks.stream(), str(tmp_path / "two"), Run(str(tmp_path / "p2"), None)))
    assert spark.read.parquet(str(tmp_path / "one")).count() == 1
    assert spark.read.parquet(str(tmp_path / "two")).count() == 2


def test_topic_choice(spark, clicks):
    clicks.add(wire(click("a")))
    clicks.add(b"x", topic="events.other")
    assert log.file_batch(spark, clicks.path, topic="events").count() == 1
    assert log.file_batch(spark, clicks.path, pattern=r"events.*").count() == 2
    assert log.file_batch(spark, clicks.path, pattern=r"event").count() == 0
    for wrong in ({}, {"topic": "a", "pattern": "b"}):
        with pytest.raises(ValueError):
            log.file_batch(spark, clicks.path, **wrong)


def test_first_failure_stops_the_others(spark, tmp_path, clicks):
    clicks.add(wire(click("a")))
    slow = Run(str(tmp_path / "p"), "1 second")

    def fail(rows_, batch_id):
        raise RuntimeError("sink is down")

    good = ingest.land_events(clicks.stream(), str(tmp_path / "out"), slow)
    bad = kpis.run_kpis(clicks.stream(), fail, slow)
    with pytest.raises(StreamingQueryException):
        ingest.wait(spark, [good, bad])
    assert not good.isActive and not bad.isActive


def purchase(event_id, ts, value="2.0", session="s1"):
    return wire(click(event_id, "purchase", ts=ts, session=session, order_value=value))


def test_kpis_late_data(spark, tmp_path, clicks, run):
    """A window is sent again while it is inside the watermark, and dropped after."""
    out = str(tmp_path / "kpis")
    clicks.add(wire(click("a", ts="10:00:10")), purchase("b", "10:00:20"))
    clicks.add(wire(click("c", ts="10:01:30")))
    clicks.add(purchase("late", "10:00:40", "3.0", "s2"))
    clicks.add(wire(click("d", ts="10:10:00")))
    clicks.add(wire(click("e", ts="10:10:10")))
    clicks.add(purchase("too late", "10:00:50", "100.0"))
    query = kpis.run_kpis(clicks.stream(files_per_trigger=1), kpis.versioned_files(out), run)
    finish(query)
    latest = kpis.read_kpis(spark, out)
    assert rows(latest.where("window_start = '2024-03-01 10:00:00'"),
                "events", "sessions", "purchases", "revenue") == [(3, 2, 2, 5.0)]
    versions = kpis.read_versions(spark, out).where("window_start = '2024-03-01 10:00:00'")
    assert rows(versions, "events") == [(2,), (3,)]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1
    # The batch figure has the row the stream gave up on.
    batch = window_kpis(bronze.valid_payloads(decode_clicks(log.file_batch(spark, clicks.path, "events"))))
    assert rows(batch.where("window_start = '2024-03-01 10:00:00'"), "events") == [(4,)]
    assert latest.count() == batch.count()


def test_kpis_on_time_equal_batch(spark, tmp_path, clicks, run):
    out = str(tmp_path / "kpis")
    for i in range(4):
        clicks.add(*[wire(click(f"{i}-{j}", ts=f"10:0{i}:{j * 7:02d}", session=f"s{j % 3}")) for j in range(8)])
    finish(kpis.run_kpis(clicks.stream(files_per_trigger=1), kpis.versioned_files(out), run))
    batch = window_kpis(bronze.valid_payloads(decode_clicks(log.file_batch(spark, clicks.path, "events"))), exact=True)
    assert rows(kpis.read_kpis(spark, out).select(*batch.columns)) == rows(batch)


def test_repeated_batch_leaves_one_copy(spark, tmp_path):
    df = spark.createDataFrame([(at("10:00"), 1)], "window_start timestamp, events long")
    write = kpis.versioned_files(str(tmp_path / "v"))
    write(df, 0)
    write(df, 0)
    write(df.withColumn("events", F.lit(5).cast("long")), 11)
    write(df.withColumn("events", F.lit(4).cast("long")), 9)
    assert kpis.read_versions(spark, str(tmp_path / "v")).count() == 3
    assert rows(kpis.read_kpis(spark, str(tmp_path / "v")), "events", "batch") == [(5, 11)]


def test_top_products(spark, tmp_path, clicks, run):
    out = str(tmp_path / "products")
    for batch in (["p1", "p2", "p2", "p3"], ["p1", "p1", "p4"]):
        clicks.add(*[wire(click(f"{i}{p}{len(batch)}", "product_view", product_id=p)) for i, p in enumerate(batch)])
    finish(kpis.run_product_counts(clicks.stream(files_per_trigger=1), kpis.versioned_files(out), run))
    assert rows(kpis.read_top_products(spark, out, 2), "product_id", "events") == [("p1", 3), ("p2", 2)]


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path, clicks, run):
    clicks.add(wire(click("a", ts="10:00:00")), wire(click("a", ts="10:00:00")), wire(click("b", ts="10:00:01")))
    clicks.add(wire(click("a", ts="10:00:00")), wire(click("c", ts="10:00:02")))
    unique = kpis.once_per_event(kpis.live_events(clicks.stream(files_per_trigger=1)))
    writer = unique.writeStream.format("parquet").option("path", str(tmp_path / "u"))
    finish(run.start(writer, "unique"))
    assert rows(spark.read.parquet(str(tmp_path / "u")), "event_id") == [("a",), ("b",), ("c",)]


def test_sessions_close_behind_the_watermark(spark, tmp_path, clicks, run):
    clicks.add(*[wire(click(str(i), ts=f"10:{i * 10:02d}:00")) for i in range(3)],
               wire(click("x", ts="10:05:00", session="s2")))
    clicks.add(wire(click("y", ts="10:50:00")), wire(click("z", ts="11:00:00", session=None)))
    clicks.add(wire(click("far", ts="14:00:00", session="s3")))
    clicks.add(wire(click("far2", ts="14:00:01", session="s3")))
    finish(kpis.run_sessions(clicks.stream(files_per_trigger=1), str(tmp_path / "s"), run))
    out = spark.read.parquet(str(tmp_path / "s"))
    # 10:50 is exactly one gap after 10:20 and still belongs to the session.
    assert rows(out, "session_id", "events", "session_end") == [
        ("s1", 4, at("11:20").replace(tzinfo=None)), ("s2", 1, at("10:35").replace(tzinfo=None))
    ]


def test_broker_sources_need_their_module(spark):
    for build in (
        lambda: log.topic_stream(spark, "nowhere:9", topic="t"),
        lambda: log.topic_batch(spark, "nowhere:9", pattern="t.*"),
    ):
        with pytest.raises(Exception, match="(?i)kafka"):
            build()


def test_progress_lives_in_the_session_folder(spark):
    class Conf:
        def __init__(self, folder):
            self.folder = folder

        def get(self, key, default):
            return self.folder if key == "spark.checkpoint.dir" else default

    class Session:
        def __init__(self, folder, master):
            self.conf = Conf(folder)
            self.sparkContext = type("Context", (), {"master": master})

    shared = Session("hdfs://shared", "yarn")
    assert Run.of_session(shared, "ingest").checkpoint_root == "hdfs://shared/ingest"
    for master in ("local[2]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            Run.of_session(Session(None, master), "x")
