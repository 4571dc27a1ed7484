"""Every registered query against its SQL on the driver tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.conftest import SF_DIR
from verification.compare import compare, duck
from verification.oracle import oracle_sql
from verification.queries import queries

SQL = oracle_sql()
# Neither joins that pair everything nor Python in the data path.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in UNWANTED:
        assert word not in plan, word
    if name in SQL:
        assert compare(spark, con, name, lambda *_: df, SQL[name], SF_DIR) is None
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["order_date", "orders", "units_sold", "revenue"]
    assert entry(spark).count() > 0


def test_approximate_sessions_are_close(spark):
    exact = queries()["kpis_minute"](spark, SF_DIR)
    approx = queries()["kpis_minute_approx"](spark, SF_DIR)
    both = exact.join(approx.selectExpr("window_start", "sessions as guess"), "window_start")
    worst = both.selectExpr("max(abs(guess - sessions) / greatest(sessions, 1)) as e").first().e
    assert both.count() == exact.count() and worst <= 0.15
