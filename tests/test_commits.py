"""Swaps and versions: jobs that die between any two steps, offset marks, the incremental gate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from oreflow.operators.checks import QualityGateError
from oreflow.operators.keyed import live_rows
from oreflow.plans import jobs, silver, upkeep
from oreflow.schemas import CDC_TABLES
from oreflow.sources import marks, swaps, tables
from oreflow.sources.versioned import VersionedTable
from tests.builders import cdc, change, event, events, order
from tests.conftest import at, rows

ORDERS = CDC_TABLES["orders"]


class Died(Exception):
    pass


def dying(step):
    """A watcher that stops the job after its n-th step; counts the steps it saw."""
    seen = []

    def watch(name):
        seen.append(name)
        if len(seen) == step:
            raise Died(name)

    watch.seen = seen
    return watch


def until_it_lives(act):
    """Run ``act`` with a job that dies at step 1, 2, ... until one gets through."""
    for step in range(1, 200):
        watch = dying(step)
        try:
            act(step, watch)
        except Died:
            continue
        return watch.seen
    raise AssertionError("never ends")


# --- compaction ------------------------------------------------------------
def test_compaction_can_die_at_any_step(spark, tmp_path):
    schema = spark.range(1).withColumn("d", F.lit(0)).schema

    def act(step, watch):
        path = str(tmp_path / f"t{step}")
        data = spark.range(60).withColumn("d", (F.col("id") % 2).cast("int"))
        data.repartition(3).write.partitionBy("d").parquet(path)
        whole = rows(data)
        try:
            upkeep.compact_small_files(spark, path, ["d"], watch=watch)
        except Died:
            # Readers that settle see all rows once, whatever the step was.
            assert rows(swaps.read_settled(spark, path, schema)) == whole
            assert swaps.settle(spark, path) == (watch.seen[-1] != "end")
            assert swaps.settle(spark, path) == 0
            assert rows(spark.read.schema(schema).parquet(path)) == whole
            out = upkeep.compact_small_files(spark, path, ["d"])
            assert rows(spark.read.schema(schema).parquet(path)) == whole
            assert len(spark.read.parquet(path).inputFiles()) == 2 and out["read"] in (0, 6)
            raise
        assert rows(spark.read.schema(schema).parquet(path)) == whole

    seen = until_it_lives(act)
    assert seen.count("delete") == 6 and seen.count("move") == 2
    assert seen[:2] == ["write", "manifest"] and seen[-1] == "end"


def test_an_undecided_swap_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    with pytest.raises(Died):
        swaps.replace_files(spark, path, [], lambda aside: spark.range(9).write.parquet(aside), dying(1))
    assert spark.read.parquet(path).count() == 5
    assert swaps.settle(spark, path) == 1
    assert spark.read.parquet(path).count() == 5 and not list((tmp_path / "t" / "_swap").iterdir())


def test_weekly_job_merges_in_place(spark, tmp_path):
    path, archive = str(tmp_path / "bronze"), str(tmp_path / "archive")
    spark.range(90).withColumn("d", F.col("id") % 2).repartition(9).write.partitionBy("d").parquet(path)
    from oreflow.plans import bronze
    from tests.builders import record, records

    dead = bronze.dead_letters(records(spark, [record(b"x", 1)]))
    out = jobs.weekly_upkeep(spark, {}, [], dead, archive, in_place={path: ["d"]})
    assert out["merged"] == {path: {"read": 18, "written": 2}}
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 45 * 89


# --- merge -----------------------------------------------------------------
def typed(spark, *changes):
    return silver.typed_changes(cdc(spark, list(changes)), ORDERS)


def test_merge_can_die_at_any_step(spark, tmp_path):
    first = [change("orders", "c", "10:00", after=order(k), offset=k) for k in range(12)]
    more = [change("orders", "u", "11:00", after=order(k, "paid"), offset=100 + k) for k in range(0, 12, 2)]
    more.append(change("orders", "d", "11:00", before=order(3), offset=200))
    expected = rows(typed(spark, *first, *more).where("op <> 'c' or order_id % 2 = 1 and order_id <> 3"),
                    "order_id", "status", "op")

    def act(step, watch):
        path = str(tmp_path / f"s{step}")
        tables.merge_table(spark, path, typed(spark, *first), "order_id", 4)
        try:
            tables.merge_table(spark, path, typed(spark, *more), "order_id", 4, watch=watch)
        except Died:
            schema = spark.read.parquet(path).schema if tables.is_table(spark, path) else typed(spark, *first).schema
            columns = typed(spark, *first).schema.names
            settled = swaps.read_settled(spark, path, schema).select(*columns)
            assert settled.select("order_id").distinct().count() == settled.count() == 12
            tables.merge_table(spark, path, typed(spark, *more), "order_id", 4)
            assert rows(spark.read.parquet(path), "order_id", "status", "op") == expected
            raise
        assert rows(spark.read.parquet(path), "order_id", "status", "op") == expected

    assert {"write", "manifest", "delete", "move", "end"} == set(until_it_lives(act))


# --- versions --------------------------------------------------------------
def test_readers_see_one_version(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v string, bucket int").schema

    def frame(*items):
        return spark.createDataFrame([(k, v, k % 4) for k, v in items], schema)

    table = VersionedTable(spark, str(tmp_path / "t"), schema, "bucket")
    assert table.read().count() == 0 and table.version().number == 0
    table.replace(frame(*[(k, "a") for k in range(8)]), range(4), {"run": "1"})
    old = table.read()
    for step in (1, 2):
        base = table.version()
        with pytest.raises(Died):
            table.replace(frame((1, "b")), [1, 2], {"run": "2"}, base, dying(step))
        assert rows(old, "k", "v") == [(k, "a") for k in range(8)]
        if step == 1:  # written, not committed
            assert table.version().notes == {"run": "1"} and table.read().count() == 8
    assert table.version().notes == {"run": "2"} and sorted(table.version().folders) == ["0", "1", "3"]
    assert rows(table.read(), "k", "v") == [(0, "a"), (1, "b"), (3, "a"), (4, "a"), (7, "a")]
    assert rows(table.read([1, 2, 9]), "k") == [(1,)]
    assert rows(table.read(version=table.version(1)), "k") == [(k,) for k in range(8)]
    with pytest.raises(FileExistsError):  # another job was first
        table.replace(frame((1, "c")), [1], base=table.version(1))
    with pytest.raises(ValueError):
        table.replace(frame((1, "c")), [2])
    assert table.expire(keep=1) > 0
    assert rows(table.read(), "k") == [(0,), (1,), (3,), (4,), (7,)] and table.numbers() == [2]
    assert table.expire(keep=1) == 0


def test_split_values_can_be_days_and_null(spark, tmp_path):
    rows_ = spark.createDataFrame([(at("2024-03-01 10:00:00"), 1), (None, 2)], "t timestamp, n int").select(
        F.to_date("t").alias("day"), "n")
    table = VersionedTable(spark, str(tmp_path / "t"), rows_.schema, "day")
    days = [r[0] for r in rows_.select("day").collect()]
    table.replace(rows_, days)
    table.replace(rows_.where("n = 2").withColumn("n", F.lit(5)), [None])
    assert rows(table.read(), "n") == [(1,), (5,)] and rows(table.read([None]), "n") == [(5,)]


# --- marks -----------------------------------------------------------------
def test_rows_of_the_marks_own_time_are_read_once(spark):
    feed = [change("orders", "c", "10:00", after=order(k), offset=k, partition=k % 2) for k in range(8)]
    feed += [change("customers", "c", "10:00", after={"customer_id": "7"}, offset=2)]
    visible = [feed[:3], feed[:6], feed[:6], feed, feed + [
        # A topic that was set up again counts from 0, but arrives later.
        change("orders", "c", "10:30", after=order(99), offset=0)]]
    mark, read = marks.Mark(), []
    for items in visible:
        bronze = cdc(spark, items)
        new = marks.behind(bronze, mark)
        end = marks.reached(new)
        late = cdc(spark, items + [change("orders", "c", "10:00", after=order(50), offset=70)])
        if end.time is None:
            assert new.count() == 0
            continue
        got = marks.within(marks.behind(late, mark), end)  # what lands meanwhile waits
        read += [(r["topic"], r["kafka_partition"], r["kafka_offset"], r["ingested_at"]) for r in got.collect()]
        mark = mark.joined(end)
    assert len(read) == len(set(read)) == len(feed) + 1


def test_marks_are_kept(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert marks.load(spark, path) == {}
    one = marks.Mark(at("10:00").replace(tzinfo=None), {("a/b", 0): 5, ("c", 1): 2})
    marks.keep(spark, path, {"x": one})
    marks.keep(spark, path, {"x": marks.Mark(at("11:00").replace(tzinfo=None), {("c", 1): 9}), "y": marks.Mark(
        at("09:00").replace(tzinfo=None), {})})
    marks.keep(spark, path, {})
    assert marks.load(spark, path) == {
        "x": marks.Mark(at("11:00").replace(tzinfo=None), {("a/b", 0): 5, ("c", 1): 9}),
        "y": marks.Mark(at("09:00").replace(tzinfo=None), {})}


def test_increment_reads_late_visible_rows_of_the_same_time(spark, tmp_path):
    root = str(tmp_path / "silver")
    clicks = [event(f"e{k}", ingested="10:00", offset=k) for k in range(6)]
    feed = [change("orders", "c", "10:00", after=order(k), offset=k) for k in range(6)]
    for n in (2, 5, 5, 6):
        jobs.hourly_increment(spark, events(spark, clicks[:n]), cdc(spark, feed[:n]), root, "salt", 4)
    assert rows(spark.read.parquet(f"{root}/events"), "event_id") == [(f"e{k}",) for k in range(6)]
    assert rows(spark.read.parquet(f"{root}/orders_history"), "kafka_offset") == [(k,) for k in range(6)]


# --- the gate of the increment ---------------------------------------------
def test_a_failed_gate_stops_the_marks(spark, tmp_path):
    root, results = str(tmp_path / "silver"), str(tmp_path / "results")
    now = F.lit("2024-03-01 12:00:00").cast("timestamp")

    def run(clicks, feed):
        return jobs.hourly_increment(spark, events(spark, clicks), cdc(spark, feed), root, "salt", 4,
                                     now=now, results_path=results)

    clicks = [event("a"), event("b", "purchase", order_id="5", ingested="10:10", offset=1)]
    feed = [change("orders", "c", "10:00", after=order(1), offset=1),
            change("orders", "c", "10:20", after=order(2, total="-1.00"), offset=2),
            change("orders", "u", "10:30", after=order(2), offset=3),
            change("orders", "c", "10:40", after=order(5), offset=4)]
    out = run(clicks[:1], feed[:1])
    assert rows(out["outcome"], "violations") == [(0,)] * 5
    before = marks.load(spark, f"{root}/marks")
    for _ in range(2):
        with pytest.raises(QualityGateError, match="negative order totals.*purchase without matching order"):
            run(clicks, feed[:2])
        assert marks.load(spark, f"{root}/marks") == before
    # What arrives later mends both; the run starts where it did and reads further.
    assert rows(run(clicks, feed)["outcome"], "violations") == [(0,)] * 5
    assert rows(spark.read.parquet(f"{root}/orders_history"), "kafka_offset") == [(k,) for k in (1, 2, 3, 4)]
    assert rows(live_rows(spark.read.parquet(f"{root}/orders_current")), "order_id") == [(1,), (2,), (5,)]
    assert run(clicks, feed)["outcome"] is None
    assert spark.read.parquet(results).count() == 20
