"""Physical plans: what must be in them, and what must not."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from tests.conftest import SF_DIR


def plan(spark, name):
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "silver_events", "cdc_current", "state_as_of", "incremental_merge", "latest_version_read",
    "top_products_per_window",
])
def test_rows_per_key_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", [
    "mart_daily_revenue", "kpis_minute", "kpis_minute_approx", "session_windows", "fct_sessions",
    "mart_funnel_conversion", "gate_duplicate_keys", "orders_by_status", "dlq_rate",
])
def test_aggregates_start_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "session_windows")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert "ReadSchema: struct<>" in plan(spark, "table_row_counts")


def test_filters_reach_the_scan(spark):
    from oreflow.plans.gold import paid
    from verification import feeds

    orders = feeds.table(spark, SF_DIR, "orders")
    text = paid(orders, "o_orderstatus")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderstatus" in text


def test_anti_joins_are_anti_joins(spark):
    for name in ("gate_unmatched_purchases", "facts_without_customer", "dlq_archive"):
        assert "LeftAnti" in plan(spark, name), name


def test_top_rows_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "last_orders")
    assert "TakeOrderedAndProject" in plan(spark, "last_days_revenue")


def test_daily_revenue_counts_orders_without_distinct(spark):
    text = plan(spark, "mart_daily_revenue")
    assert "distinct" not in text.lower()


@pytest.mark.parametrize("name", ["gate_unmatched_purchases", "quality_report"])
def test_known_orders_are_never_broadcast(spark, name):
    text = plan(spark, name)
    assert "LeftAnti" in text and "BroadcastHashJoin" not in text


def test_purchases_without_an_order_stay_spread_in_the_join(spark):
    text = plan(spark, "gate_unmatched_purchases")
    assert "_key#" in text.split("SortMergeJoin")[1].split("LeftAnti")[0] and "_salt#" not in text


def test_many_hot_keys_are_never_broadcast(spark, monkeypatch):
    from oreflow.operators import ordered

    monkeypatch.setattr(ordered, "MAX_HOT_KEYS", 4)
    for name in ("order_lifecycle_sliced", "dim_product_scd2_sliced"):
        text = plan(spark, name)
        assert "SortMergeJoin" in text and "Broadcast" not in text, name


@pytest.mark.parametrize("name", [
    "scd2_asof_join", "scd2_asof_join_sliced", "fct_events", "bronze_events", "cdc_history",
])
def test_records_are_built_by_all_tasks(spark, name):
    text = plan(spark, name)
    assert "Exchange RoundRobinPartitioning(8)" in text


def test_key_sizes_are_taken_without_record_texts(spark):
    from verification.queries import Shapes

    for keys in (Shapes(spark, SF_DIR).order_keys(), Shapes(spark, SF_DIR).product_keys(),
                 Shapes(spark, SF_DIR).customer_keys()):
        assert "StructsToJson" not in keys._jdf.queryExecution().executedPlan().toString()


def test_product_orders_are_combined_in_all_tasks(spark):
    text = plan(spark, "mart_product_performance")
    assert "REPARTITION_BY_NUM" in text.split("SortMergeJoin")[0].split("BroadcastHashJoin")[0]


def test_increments_write_their_feed_once(spark, monkeypatch):
    from verification import queries as registered

    built = []
    for name in ("product_changes", "customer_changes"):
        made = getattr(registered.feeds, name)
        monkeypatch.setattr(registered.feeds, name, lambda *a, made=made, **k: built.append(1) or made(*a, **k))
    folders, staged = [], registered._staged
    monkeypatch.setattr(registered, "_staged", lambda rows, path: folders.append(path) or staged(rows, path))
    for name in ("dim_product_scd2_increments", "dim_customer_scd2_increments"):
        assert "StructsToJson" not in plan(spark, name)
    assert len(built) == len(folders) == 2
    queries()["mart_daily_revenue_increments"](spark, SF_DIR)
    assert [f.rsplit("/", 1)[1] for f in folders[2:]] == [
        "orders", "items", "touched-0", "touched-1", "touched-2"]
