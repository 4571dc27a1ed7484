"""Quality checks: a check is a frame of violating keys; no rows means passed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    """At least one check of a gate found violations."""


@dataclass(frozen=True)
class Check:
    """A named check over ``rows``.

    With a ``predicate`` the violations are the rows that satisfy it; with
    ``unique`` they are the non-null keys that occur more than once. All such
    checks of one frame share a single pass. Without either, every row is a
    violation: the frame is the result of a grouping or a join.
    """

    name: str
    rows: DataFrame
    key: str
    predicate: Column | None = None
    unique: bool = False

    @property
    def whole(self) -> bool:
        """Whether the frame itself is the list of violations."""
        return self.predicate is None and not self.unique

    @property
    def violations(self) -> DataFrame:
        if self.unique:
            return not_unique(self.rows, self.key)
        return self.rows if self.whole else self.rows.where(self.predicate)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return duplicates(df.where(F.col(column).isNotNull()), column)


def any_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which one of the columns is null."""
    return df.where(is_any_null(*columns))


def is_any_null(*columns: str) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def not_accepted(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list with their row count; null passes."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
    )


def report(checks: Iterable[Check]) -> DataFrame:
    """One row per check: name, number of violations, smallest violating key.

    Each frame is read once for all its checks. Row checks leave one row per
    task. Where a frame also has a uniqueness check, rows are first counted per
    key, row checks along with them, and the counts are then summed.
    """
    groups: dict[int, list[Check]] = {}
    for position, check in enumerate(checks):
        same_scan = -1 - position if check.whole else id(check.rows)
        groups.setdefault(same_scan, []).append(check)
    return reduce(DataFrame.unionByName, [_one_scan(group) for group in groups.values()])


def _one_scan(checks: list[Check]) -> DataFrame:
    keys = sorted({check.key for check in checks if check.unique})
    if len(keys) > 1:
        # One pass per key: row checks go with the first.
        parts = [[c for c in checks if c.unique and c.key == k or not c.unique and k == keys[0]]
                 for k in keys]
        return reduce(DataFrame.unionByName, map(_one_scan, parts))
    rows, sums = checks[0].rows, {}
    for i, check in enumerate(checks):
        if check.unique:
            continue
        hit = F.lit(True) if check.whole else check.predicate
        key = F.when(hit, F.col(check.key).cast("string"))
        sums[f"n{i}"], sums[f"k{i}"] = F.count(F.when(hit, 1)), F.min(key)
    if keys:
        per_key = rows.groupBy(keys[0]).agg(
            F.count("*").alias("_rows"), *[c.alias(n) for n, c in sums.items()])
        twice = (F.col("_rows") > 1) & F.col(keys[0]).isNotNull()
        sums = {n: F.coalesce(F.sum(n), F.lit(0)) if n[0] == "n" else F.min(n) for n in sums}
        for i, check in enumerate(checks):
            if check.unique:
                sums[f"n{i}"] = F.count_if(twice)
                sums[f"k{i}"] = F.min(F.when(twice, F.col(check.key).cast("string")))
        rows = per_key
    outcomes = F.array(*[
        F.struct(
            F.lit(check.name).alias("check"), F.col(f"n{i}").alias("violations"),
            F.col(f"k{i}").alias("sample"),
        )
        for i, check in enumerate(checks)
    ])
    return rows.agg(*[c.alias(n) for n, c in sums.items()]).select(F.inline(outcomes))


def run_gate(
    checks: Sequence[Check], examples: int = 5, results_path: str | None = None,
    run_at: Column | None = None,
) -> DataFrame:
    """Run all checks, then fail once, naming every check that was violated.

    With ``results_path`` the report is kept there first, whatever it says.
    ``examples`` bounds the rows quoted in the error; counts are complete.
    """
    outcome = report(checks)
    # One row per check: as many rows as checks were written.
    rows = outcome.collect()
    found = outcome.sparkSession.createDataFrame(rows, outcome.schema)
    if results_path is not None:
        keep_results(found, results_path, run_at)
    failed = {row["check"]: row["violations"] for row in rows if row["violations"]}
    if failed:
        details = {
            check.name: [str(r) for r in check.violations.limit(examples).collect()]
            for check in checks
            if check.name in failed
        }
        raise QualityGateError(f"quality gate failed: {failed}; examples: {details}")
    return found


def keep_results(outcome: DataFrame, path: str, run_at: Column | None = None) -> None:
    """Append a report with its run time, so results can be followed over time."""
    stamped = outcome.withColumn("run_at", F.current_timestamp() if run_at is None else run_at)
    stamped.coalesce(1).write.mode("append").parquet(path)
