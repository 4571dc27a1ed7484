from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oreflow.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session("tests", "local[8]", 8, **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(warehouse),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """UTC instant from ``HH:MM[:SS]`` of one day, or from a full timestamp."""
    if len(text) <= 8:
        text = f"2024-03-01 {text}"
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def rows(df, *columns):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
