"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores. The
tables there are one file each, so they are first written once as a file for each
core, to a folder of this run; that is not timed.
Every query runs once to warm up code paths and is then timed, planning
included, with all rows written to a sink that discards them.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

from oreflow.session import build_session
from verification.queries import queries

HEADLINE = (
    "stg_orders", "stg_order_items", "fct_orders", "mart_daily_revenue",
    "mart_product_performance", "revenue_by_category", "orders_by_status", "latest_snapshot",
    "cdc_history", "cdc_current", "state_as_of", "order_lifecycle", "dim_product_scd2",
    "dim_customer_scd2", "scd2_asof_join", "stale_status", "incremental_merge",
    "wire_split_counts", "bronze_events", "silver_events", "gate_unmatched_purchases",
    "quality_report", "kpis_minute", "kpis_minute_approx", "latest_version_read",
    "session_windows", "fct_sessions", "mart_funnel_conversion", "top_products_per_window",
    "fct_events", "dlq_replay_report", "offset_lag",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    dealt = f"file://{tempfile.mkdtemp(prefix='bench-')}"
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        rows = spark.read.parquet(path)
        rows.repartition(int(cpus)).write.parquet(f"{dealt}/{os.path.basename(path)}")
    registered, seconds = queries(), {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            began = time.perf_counter()
            registered[name](spark, dealt).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
