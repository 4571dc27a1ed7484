"""Snapshots, replaceable tables, upkeep, and the jobs end to end."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from oreflow.functions.wire import HEADER_BYTES, add_header, decode_clicks, has_header
from oreflow.operators.checks import Check, QualityGateError, report, run_gate
from oreflow.plans import bronze, jobs, quality, silver, upkeep
from oreflow.schemas import BRONZE_CDC, BRONZE_EVENTS, SNAPSHOTS
from oreflow.sources import lakehouse, tables
from tests.builders import cdc, change, click, event, events, order, record, records, wire
from tests.conftest import at, rows



def now():
    return F.lit("2024-03-02 00:00:00").cast("timestamp")


@pytest.fixture
def database():
    return f"db_{uuid.uuid4().hex[:8]}"


def frame(spark, *values):
    return spark.createDataFrame([(v, str(v)) for v in values], "k long, v string")


# --- snapshots -------------------------------------------------------------
def test_snapshot_day_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(frame(spark, 1, 2), path, "2024-03-01")
    tables.write_snapshot(frame(spark, 3), path, "2024-03-02")
    tables.write_snapshot(frame(spark, 9), path, "2024-03-02")
    out = tables.read_snapshots(spark, path)
    assert rows(out, "k", "ds") == [(1, "2024-03-01"), (2, "2024-03-01"), (9, "2024-03-02")]
    assert out.schema["ds"].dataType.simpleString() == "string"
    plan = out.where("ds = '2024-03-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_snapshot_stores_money_as_double(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.sql("select cast(1.25 as decimal(12,2)) as m"), path, "2024-03-01")
    assert tables.read_snapshots(spark, path).schema["m"].dataType.simpleString() == "double"


def test_load_day_is_idempotent(spark, tmp_path, database):
    path, name = str(tmp_path / "t"), f"{database}.t"
    for ds, values in (("2024-03-01", [1, 2]), ("2024-03-02", [3])):
        tables.write_snapshot(frame(spark, *values), path, ds)
        tables.load_day(spark, tables.read_snapshots(spark, path), name, ds)
    tables.load_day(spark, tables.read_snapshots(spark, path), name, "2024-03-01")
    assert rows(spark.table(name), "k", "ds") == [(1, "2024-03-01"), (2, "2024-03-01"), (3, "2024-03-02")]
    assert tables.newest_ds(spark, name) == "2024-03-02"
    tables.create_like(spark, name, frame(spark, 1), None)
    assert spark.table(name).count() == 3


def test_incremental_extract(spark):
    df = spark.createDataFrame([(1, at("10:00")), (2, at("11:00"))], "k int, updated_at timestamp")
    mark = tables.high_water_mark(df.where("k = 1")).first()[0]
    assert rows(tables.changed_since(df, F.lit(mark)), "k") == [(2,)]


def test_retained_snapshots(spark):
    days = [(f"2024-01-{d:02d}",) for d in range(1, 4)] + [("2024-02-28",), ("2024-03-01",)] * 2
    out = dict(rows(tables.retained_snapshots(spark.createDataFrame(days, "ds string"), "2024-03-02")))
    assert all(out.values()) and len(out) == 5
    more = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 10)], "ds string")
    kept = dict(rows(tables.retained_snapshots(more, "2024-03-02")))
    assert sorted(d for d, k in kept.items() if k) == [f"2024-01-0{d}" for d in range(5, 10)]


# --- replaceable tables ----------------------------------------------------
def test_replace_keeps_old_versions_until_they_expire(spark, database):
    name = f"{database}.t"
    assert tables.versions(spark, name) == []
    for v in range(7):
        before = spark.table(name) if v else None
        tables.replace_table(spark, name, frame(spark, v))
        assert rows(spark.table(name), "k") == [(v,)]
        if v:
            assert rows(before, "k") == [(v - 1,)]
    built = tables.versions(spark, name)
    assert len(built) == 7 and built[0][1] > built[-1][1]
    assert rows(tables.version_as_of(spark, name, built[3][1]), "k") == [(3,)]
    with pytest.raises(LookupError):
        tables.version_as_of(spark, name, built[-1][1] - dt.timedelta(seconds=1))
    assert tables.expire_versions(spark, name, built[-1][1]) == []
    gone = jobs.expire_builds(spark, [name, f"{database}.none"],
                              dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=30))
    assert len(gone[name]) == 2 and gone[f"{database}.none"] == []
    assert rows(spark.table(name), "k") == [(6,)]


def test_replace_partitioned(spark, database):
    name = f"{database}.p"
    version = tables.replace_table(spark, name, frame(spark, 1, 2, 3), ["v"])
    assert rows(spark.table(name), "k") == [(1,), (2,), (3,)]
    assert spark.sql(f"SHOW PARTITIONS {version}").count() == 3


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    small, one, two = (str(tmp_path / n) for n in ("small", "one", "two"))
    spark.range(1_000).withColumn("d", F.col("id") % 2).repartition(20).write.parquet(small)
    source = spark.read.parquet(small)
    assert tables.file_inventory(source).count() == 20
    assert upkeep.compact(source, one) == 1
    assert tables.file_inventory(spark.read.parquet(one)).count() == 1
    upkeep.compact(source, two, ["d"])
    out = spark.read.parquet(two)
    assert len(out.inputFiles()) == 2 and out.agg(F.sum("id")).first()[0] == 499_500


# --- dead letters ----------------------------------------------------------
def dead(spark, *offsets):
    return bronze.dead_letters(records(spark, [record(b"x%d" % o, o) for o in offsets]))


def test_archive_only_grows(spark, tmp_path):
    path = str(tmp_path / "archive")
    upkeep.archive_dead_letters(spark, dead(spark, 1, 2), path)
    upkeep.archive_dead_letters(spark, dead(spark, 2, 3), path)
    upkeep.archive_dead_letters(spark, dead(spark, 3), path)
    assert rows(spark.read.parquet(path), "kafka_offset") == [(1,), (2,), (3,)]


def test_replay_outcomes(spark):
    whole = [wire(click(i)) for i in ("new", "known", "ok")]
    archived = bronze.dead_letters(records(spark, [
        record(whole[0][HEADER_BYTES:], 1), record(whole[1][HEADER_BYTES:], 2),
        record(b"junk", 3), record(None, 4),
    ]))
    landed = bronze.bronze_events(decode_clicks(records(spark, [record(whole[1], 9), record(whole[1], 10)])))

    def repair(df):
        return df.withColumn("value", F.when(has_header(F.col("value")), F.col("value"))
                             .otherwise(add_header(F.col("value"))))

    replayed = upkeep.replay(archived, repair, landed)
    assert dict(rows(upkeep.replay_report(replayed))) == {
        "recovered": 1, "already landed": 1, "still bad": 2
    }
    recovered = upkeep.recovered_events(replayed)
    assert recovered.columns == BRONZE_EVENTS.fieldNames()
    assert rows(recovered, "event_id", "kafka_offset") == [("new", 1)]


# --- quality ---------------------------------------------------------------
def test_report_lists_passed_checks_too(spark):
    df = frame(spark, 3, 1, 2)
    out = report([Check("all", df, "k"), Check("none", df, "k", F.col("k") > 9)])
    assert rows(out) == [("all", 3, "1"), ("none", 0, None)]
    with pytest.raises(QualityGateError, match="all.*3"):
        run_gate([Check("all", df, "k"), Check("none", df, "k", F.col("k") > 9)])
    assert run_gate([Check("none", df.where("k > 9"), "k")]).count() == 1


def test_unmatched_purchases_ignore_recent_ones(spark):
    clicks = events(spark, [
        event("old", "purchase", "10:00", order_id="5"), event("fresh", "purchase", "23:55", order_id="5"),
        event("known", "purchase", "10:00", order_id="1"), event("none", "purchase", "10:00"),
        event("text", "purchase", "10:00", order_id="abc"), event("view", "page_view", "10:00"),
    ])
    history = spark.createDataFrame([(1,), (1,), (None,)], "order_id long")
    out = quality.unmatched_purchases(clicks, history, now())
    assert rows(out, "event_id") == [("none",), ("old",), ("text",)]


# --- jobs ------------------------------------------------------------------
def bronze_inputs(spark, total="10.00"):
    clicks = events(spark, [
        event("a", ts="10:00"), event("a", ts="10:00", ingested="10:05", offset=3),
        event("b", "purchase", "10:01", order_id="1", order_value="10.0"),
    ])
    raw = cdc(spark, [
        change("orders", "c", "10:00", after=order(1, total=total), offset=1),
        change("customers", "c", "10:00", after={"customer_id": "7", "email": "e"}, offset=2),
        change("products", "c", "10:00", after={"product_id": "3", "unit_price": "1.5"}, offset=3),
    ])
    return clicks, raw


def test_hourly_job_passes_then_fails_on_a_bad_total(spark, database, tmp_path):
    results = str(tmp_path / "results")
    outcome = jobs.hourly_silver(
        spark, *bronze_inputs(spark), database, now=now(), results_path=results, salt="s")
    assert len(spark.table(f"{database}.customers_current").first().email) == 64
    assert rows(outcome, "violations") == [(0,)] * 5
    assert spark.table(f"{database}.events").count() == 2
    assert rows(spark.table(f"{database}.orders_current"), "order_id", "op") == [(1, "c")]
    jobs.hourly_silver(spark, *bronze_inputs(spark), database, now=now(), results_path=results)
    assert spark.read.parquet(results).count() == 10
    with pytest.raises(QualityGateError, match="negative order totals"):
        jobs.hourly_silver(spark, *bronze_inputs(spark, "-1.00"), database, now=now())


def extracts(spark, status="paid"):
    t = at("10:00")

    def table(name, data):
        fields = [f for f in SNAPSHOTS[name].fields if f.name != "ds"]
        return spark.createDataFrame(data, type(SNAPSHOTS[name])(fields))

    return {
        "customers": table("customers", [(7, "e", "n", "DE", True, t, t)]),
        "products": table("products", [(100, "s", "n", "c", "sc", 5.0, True, t, t)]),
        "inventory": table("inventory", [(100, 4, t)]),
        "orders": table("orders", [(1, 7, status, "USD", 10.0, t, t)]),
        "order_items": table("order_items", [(1, 1, 100, 2, 5.0)]),
        "payments": table("payments", [(1, 1, "card", "captured", 10.0, t)]),
    }


def test_daily_job_twice_for_a_day(spark, database, tmp_path):
    lake, raw, marts = str(tmp_path / "lake"), f"{database}_raw", f"{database}_marts"
    for ds in ("2024-03-01", "2024-03-02", "2024-03-02"):
        outcome = jobs.daily_batch(spark, extracts(spark), lake, ds, raw, marts)
        assert outcome.where("violations > 0").count() == 0
    assert spark.table(f"{raw}.orders").count() == 2
    assert rows(spark.table(f"{marts}.mart_daily_revenue"), "orders", "units_sold") == [(1, 2)]
    assert spark.table("stg_payments").count() == 1
    with pytest.raises(QualityGateError, match="accepted values"):
        jobs.daily_batch(spark, extracts(spark, "returned"), lake, "2024-03-03", raw, marts)


def test_weekly_job(spark, database, tmp_path):
    small, target, archive = (str(tmp_path / n) for n in ("small", "target", "archive"))
    spark.range(100).withColumn("d", F.col("id") % 2).repartition(10).write.parquet(small)
    name = f"{database}.t"
    for v in range(6):
        tables.replace_table(spark, name, frame(spark, v))
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=8)
    for _ in range(2):
        out = jobs.weekly_upkeep(
            spark, {target: (spark.read.parquet(small), ["d"])}, [name], dead(spark, 1), archive, later
        )
    assert out["compacted"] == {target: 1} and out["expired"] == {name: []}
    assert len(tables.versions(spark, name)) == 5
    assert spark.read.parquet(target).count() == 100 and spark.read.parquet(archive).count() == 1


def test_increment_appends_only_new_events(spark):
    first = events(spark, [event("a", session="old"), event("b")])
    second = events(spark, [event("a", session="again"), event("c"), event("c", ingested="10:09")])
    present = silver.silver_events(first)
    assert rows(silver.new_events(second, present), "event_id", "ingested_at") == [
        ("c", at("10:00:01").replace(tzinfo=None))
    ]


def test_lakehouse_statements_are_valid_sql(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    for text in (
        lakehouse.create_statement("lake.bronze.events", BRONZE_EVENTS, "days(event_ts)", "iceberg"),
        lakehouse.create_statement("lake.bronze.cdc_raw", BRONZE_CDC, "topic", "iceberg"),
        lakehouse.merge_statement("lake.silver.orders_current", "order_id", "changes"),
        lakehouse.compact_statement("lake", "bronze.events"),
        lakehouse.expire_statement("lake", "bronze.events", dt.datetime(2024, 3, 1), 5),
        "SELECT * FROM lake.bronze.events VERSION AS OF 7",
    ):
        assert parser.parsePlan(text) is not None
    with pytest.raises(ValueError):
        lakehouse.read_version(spark, "t")
    assert lakehouse.expire(spark, "spark_catalog", "default.none", dt.datetime(2024, 3, 1)) is None
