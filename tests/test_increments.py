"""Gold tables from increments in any order and any cut: equal to a rebuild after each."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from oreflow.operators.ordered import Slicing
from oreflow.operators.scd import scd2, scd2_shape
from oreflow.operators.sessions import gap_sessions, session_facts
from oreflow.plans import gold, increments, jobs, silver
from oreflow.schemas import BRONZE_CDC, CDC_TABLES
from tests.builders import cdc, change, event, events, order
from tests.conftest import rows
from tests.test_commits import Died, dying

PRODUCTS = CDC_TABLES["products"]
TRACKED = gold.PRODUCT_TRACKED


def clock(rng, hours=6, step=60):
    minute = rng.randrange(0, hours * 60, step) if step > 1 else rng.randrange(hours * 60)
    return f"{10 + minute // 60:02d}:{minute % 60:02d}"


def product(k, price, name="n"):
    return {"product_id": None if k is None else str(k), "sku": "s", "name": name, "unit_price": str(price)}


def product_changes(rng, n):
    out = []
    for i in range(n):
        k, ts = rng.choice([*range(6), None]), clock(rng, step=30)
        if rng.random() < 0.15:
            out.append(change("products", "d", ts, before=product(k, 1), offset=i))
        else:  # few prices, so many changes change nothing
            out.append(change("products", rng.choice("cu"), ts, after=product(k, rng.choice([1, 2])), offset=i,
                              partition=i % 2))
    return out


# --- dimensions ------------------------------------------------------------
@pytest.mark.parametrize("seed, slicing", [(1, Slicing()), (2, Slicing(rows_per_slice=3))])
def test_dimension_increments_equal_a_rebuild(spark, tmp_path, seed, slicing):
    rng = random.Random(seed)
    feed = product_changes(rng, 70)
    rng.shuffle(feed)
    shape = silver.typed_changes(cdc(spark, feed[:1]), PRODUCTS).schema
    points = increments.bucketed(spark, str(tmp_path / "points"), shape)
    table = increments.bucketed(
        spark, str(tmp_path / "dim"), scd2_shape(shape, "product_id", TRACKED, "product_key"))
    cuts = [0, 4, 30, 70]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        new = silver.cdc_history(cdc(spark, feed[low:high]), PRODUCTS)
        run = f"{i:03d}"
        before = table.version()
        for _ in range(2):  # the second time nothing happens
            increments.merge_points(points, new, "product_id", run, 4)
            increments.merge_dimension(
                table, points, new, "product_id", TRACKED, "product_key", run, 4, slicing)
        after = table.version()
        assert after.number == before.number + 1
        keys = {r[0] for r in new.select("product_id").collect()} - {None}
        touched = {str(r[0]) for r in spark.createDataFrame([(k,) for k in keys], "product_id long").select(
            increments.bucket_of("product_id", 4)).collect()} if keys else set()
        assert {b for b in before.folders if before.folders[b] == after.folders.get(b)} == (
            set(before.folders) - touched)
        whole = scd2(silver.typed_changes(cdc(spark, feed[:high]), PRODUCTS), "product_id", TRACKED, "product_key")
        assert rows(table.read().drop("bucket")) == rows(whole)


def test_a_late_change_splits_and_rejoins(spark, tmp_path):
    shape = silver.typed_changes(spark.createDataFrame([], BRONZE_CDC), PRODUCTS).schema
    points = increments.bucketed(spark, str(tmp_path / "points"), shape)
    table = increments.bucketed(
        spark, str(tmp_path / "dim"), scd2_shape(shape, "product_id", TRACKED, "product_key"))

    def after(run, *changes):
        new = silver.cdc_history(cdc(spark, list(changes)), PRODUCTS)
        increments.merge_points(points, new, "product_id", run, 2)
        increments.merge_dimension(table, points, new, "product_id", TRACKED, "product_key", run, 2)
        found = table.read().orderBy("valid_from").collect()
        return [(f"{r.valid_from:%H}", r.valid_to and f"{r.valid_to:%H}", float(r.unit_price)) for r in found]

    def put(ts, price, offset):
        return change("products", "u", ts, after=product(1, price), offset=offset)

    assert after("1", put("10:00", 1, 1)) == [("10", None, 1.0)]
    assert after("2", put("14:00", 1, 2)) == [("10", None, 1.0)]  # no change
    assert after("3", put("12:00", 2, 3)) == [("10", "12", 1.0), ("12", "14", 2.0), ("14", None, 1.0)]
    # The same instant again, later in the log: what lay between is no change any more.
    assert after("4", put("12:00", 1, 4)) == [("10", None, 1.0)]
    gone = change("products", "d", "13:00", before=product(1, 1), offset=5)
    assert after("5", gone) == [("10", "13", 1.0), ("14", None, 1.0)]


# --- sessions --------------------------------------------------------------
@pytest.mark.parametrize("seed", [3, 4])
def test_sessions_of_any_cut_equal_one_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    items = [event(f"e{i}", rng.choice(["page_view", "purchase", "product_view"]), clock(rng, 10, 1),
                   session=rng.choice(["s1", "s2", "s3", None]), customer=rng.choice([1, 2, None]))
             for i in range(120)]
    whole = events(spark, items)
    sessions = increments.bucketed(spark, str(tmp_path / "s"), gap_sessions(whole, "session_id").schema)
    facts = increments.bucketed(spark, str(tmp_path / "f"), session_facts(whole).schema)
    cuts = sorted(rng.sample(range(1, 120), 2))
    for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, 120])):
        new = events(spark, items[low:high])
        for _ in range(2):
            increments.merge_sessions(sessions, new, "session_id", f"{i}", 4)
            increments.merge_session_facts(facts, new, f"{i}", 4)
        so_far = events(spark, items[:high])
        assert rows(sessions.read().drop("bucket")) == rows(gap_sessions(so_far, "session_id"))
        assert rows(facts.read().drop("bucket")) == rows(session_facts(so_far))


def test_a_late_event_joins_two_sessions(spark, tmp_path):
    def batch(*times):
        return events(spark, [event(t, ts=t) for t in times])

    table = increments.bucketed(
        spark, str(tmp_path / "s"), gap_sessions(batch("10:00"), "session_id").schema)
    increments.merge_sessions(table, batch("10:00", "10:50", "12:00"), "session_id", "1", 2)
    assert rows(table.read(), "events") == [(1,), (1,), (1,)]
    increments.merge_sessions(table, batch("10:25"), "session_id", "2", 2)
    assert rows(table.read(), "events") == [(1,), (3,)]


# --- daily revenue ---------------------------------------------------------
def item(k, order_id, quantity=1, price="2.50"):
    return {"order_item_id": str(k), "order_id": str(order_id), "product_id": "1", "quantity": str(quantity),
            "unit_price_at_purchase": price}


def dated(order_id, status, day):
    return order(order_id, status) | {"created_at": day and f"2024-{day[0]:02d}-{day[1]:02d}T10:00:00.000000Z"}


def plain_revenue(spark, raw):
    orders = silver.cdc_current(silver.typed_changes(raw, CDC_TABLES["orders"]), CDC_TABLES["orders"])
    items = silver.cdc_current(silver.typed_changes(raw, CDC_TABLES["order_items"]), CDC_TABLES["order_items"])
    return gold.daily_revenue(items, orders.select(
        "order_id", F.col("status").alias("order_status"), F.col("created_at").alias("order_created_at")))


def test_daily_revenue_follows_status_changes_and_late_items(spark, tmp_path):
    rng, feed = random.Random(5), []
    days = {k: rng.choice([(3, 1), (3, 2), (4, 3), (5, 4), None]) for k in range(12)}
    for i in range(110):
        k, ts = rng.randrange(12), clock(rng, step=1)
        kind = rng.random()
        if kind < 0.45:
            feed.append(change("orders", "u", ts, after=dated(k, rng.choice(["pending", "paid", "cancelled", "shipped"]),
                                                              days[k]), offset=i))
        elif kind < 0.5:
            feed.append(change("orders", "d", ts, before=dated(k, "paid", days[k]), offset=i))
        elif kind < 0.9:
            n = rng.randrange(3)
            feed.append(change("order_items", "c", ts, after=item(10 * k + n, k, rng.randint(1, 4)), offset=i))
        else:
            feed.append(change("order_items", "d", ts, before=item(10 * k, k), offset=i))
    raw = cdc(spark, feed)
    typed = {n: silver.typed_changes(raw, CDC_TABLES[n]) for n in ("orders", "order_items")}
    tables = {n: increments.bucketed(spark, str(tmp_path / n), t.schema) for n, t in typed.items()}
    totals = increments.bucketed(
        spark, str(tmp_path / "totals"), increments.order_totals(*typed.values()).schema)
    mart = increments.daily_mart(spark, str(tmp_path / "mart"))
    cuts = [0, 30, 31, 70, 110]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        new = cdc(spark, feed[low:high])
        run = f"{i}"
        changes = {n: silver.cdc_history(new, CDC_TABLES[n]) for n in typed}
        increments.merge_state(tables["orders"], changes["orders"], "order_id", run, 4)
        increments.merge_state(tables["order_items"], changes["order_items"], "order_item_id", run, 4, "order_id")
        touched = changes["orders"].select("order_id").unionByName(changes["order_items"].select("order_id"))
        increments.merge_order_totals(totals, tables["orders"], tables["order_items"], touched, run, 4)
        if i == 1:
            continue  # the mart misses a run, as if the job had died
        before = mart.version()
        rebuilt = increments.refresh_daily_revenue(mart, totals)
        assert increments.refresh_daily_revenue(mart, totals) == []
        assert rows(increments.read_days(mart)) == rows(plain_revenue(spark, cdc(spark, feed[:high])))
        assert rows(increments.read_days(mart, rebuilt)) == rows(mart.read().where(
            F.coalesce(F.col("order_date").cast("string"), F.lit("null")).isin(rebuilt)).drop("month"))
        kept, months = mart.version().folders, {d if d == "null" else d[:7] for d in rebuilt}
        assert all(kept[m] == f for m, f in before.folders.items() if m not in months)


# --- the job ---------------------------------------------------------------
def rebuilt(spark, clicks, feed):
    first = silver.silver_events(clicks.where("event_id is not null"))
    typed = {n: silver.typed_changes(feed, CDC_TABLES[n]) for n in jobs.GOLD_FEEDS}
    customers = silver.masked_customers(typed["customers"], "salt")
    dims = {"dim_products": gold.dim_product_scd2(typed["products"]), "dim_customers": gold.dim_customer_scd2(customers)}
    return dims | {
        "sessions": gap_sessions(first, "session_id"), "session_facts": session_facts(first),
        "daily_revenue": plain_revenue(spark, feed),
        "event_facts": increments.event_facts(first, *dims.values()),
    }


def job_feeds():
    rng = random.Random(6)
    clicks, feed = [], []
    for i in range(60):
        minute, e = rng.randrange(600), i - (i % 7 == 1)  # every seventh event comes twice
        clicks.append(event(
            f"e{e}", "purchase" if e % 3 else "page_view", f"2024-03-0{1 + e % 3} 1{e % 9}:00:00", session=f"s{e % 5}",
            customer=e % 4, ingested=f"{10 + i // 6}:{i % 6}0", offset=i, product_id=e % 6))
        ts = f"2024-03-0{rng.randint(1, 3)} {10 + minute // 60}:{minute % 60:02d}:00"
        k = rng.randrange(6)
        made = [
            ("products", product(k, rng.choice([1, 2, 3]))),
            ("customers", {"customer_id": str(k), "email": rng.choice(["a@x", "b@x"]), "full_name": "Ann"}),
            ("orders", dated(k, rng.choice(["paid", "pending"]), (3, 1 + k % 3))), ("order_items", item(k, k))][i % 4]
        topic, key, value, *_ = change(made[0], "u", ts, after=made[1], offset=i)
        arrived = event("x", ingested=f"{10 + i // 6}:{i % 6}0")[-1]
        feed.append((topic, key, value, 0, i, arrived, arrived))
    return clicks, feed


def test_gold_job_equals_a_rebuild_whatever_dies(spark, tmp_path):
    clicks, feed = job_feeds()
    root = str(tmp_path / "gold")
    for (n, m), step in zip(((25, 15), (55, 55)), (13, 24)):
        with pytest.raises(Died):
            jobs.gold_increment(spark, events(spark, clicks[:n]), cdc(spark, feed[:m]), root, "salt", 3,
                                watch=dying(step))
        # More has arrived when the job is run again: it finishes its run, then reads on.
        ahead = events(spark, clicks[:n + 5]), cdc(spark, feed[:m + 3])
        for _ in range(3):
            out = jobs.gold_increment(spark, *ahead, root, "salt", 3)
        assert out == {"reached": {}, "days": {}, "outcome": None}
        kept = jobs.gold_tables(spark, *ahead, root)
        for name, expected in rebuilt(spark, *ahead).items():
            found = kept[name].read()
            assert rows(found.select(*expected.columns)) == rows(expected), name


def test_gold_job_gates_what_it_made(spark, tmp_path):
    clicks, feed = job_feeds()
    results = str(tmp_path / "results")
    out = jobs.gold_increment(
        spark, events(spark, clicks[:9]), cdc(spark, feed[:8]), str(tmp_path / "gold"), "salt", 2, results)
    assert out["outcome"].where("violations > 0").count() == 0 and spark.read.parquet(results).count() == 8
    assert out["days"]["event_facts"]
