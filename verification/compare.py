"""Run registered queries next to their SQL and compare columns, types and values."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification.feeds import TABLES
from verification.oracle import oracle_sql
from verification.queries import queries

# Spark type -> DuckDB type of the compared outputs.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark: SparkSession, con, name: str, function, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = function(spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    if set(types) != set(expected_types):
        return f"columns {sorted(types)} against {sorted(expected_types)}"
    actual = _rows(df.columns, df.collect())
    expected = _rows(list(expected_types), result.fetchall())
    if actual != expected:
        missing = [r for r in expected if r not in set(actual)][:3]
        extra = [r for r in actual if r not in set(expected)][:3]
        return f"{len(actual)} rows against {len(expected)}; missing {missing}; extra {extra}"
    wrong = {c: (t, expected_types[c]) for c, t in types.items()
             if TYPE_NAMES.get(t, t) != expected_types[c]}
    if wrong:
        return f"types {wrong}"
    return None


def main() -> int:
    from oreflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("compare", "local[8]", 8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, function in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, function, sqls[name], sf_dir)
            else:
                problem = None if function(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        bad += problem is not None
        state = "ok" if name in sqls else "rows only"
        print(f"{name:32s} {time.time() - began:6.2f}s {problem or state}", flush=True)
    print(f"{bad} with problems")
    return bad


if __name__ == "__main__":
    sys.exit(main())
