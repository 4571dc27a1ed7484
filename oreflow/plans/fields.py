"""Field registry: which fields a change feed has, versioned, and what they hold.

A feed may gain fields at any time: those widen the history by themselves, with a
type that all values seen so far fit. A known field whose values no longer fit its
type is a conflict, and conflicts stop the gate before anything is written.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.checks import Check
from oreflow.plans.increments import RUN, contains
from oreflow.schemas import CdcTable
from oreflow.sources.swaps import Watcher, quiet
from oreflow.sources.versioned import VersionedTable

#: Types that a new field may get, narrowest first; text fits everything.
CANDIDATES = ("bigint", "decimal(38,9)", "boolean", "timestamp", "string")
SHAPE = "feed string, version int, field string, type string, since string"


def registry(spark: SparkSession, path: str) -> VersionedTable:
    """The table of field lists. Lists are short: fields of a feed times its versions."""
    return VersionedTable(spark, path, spark.createDataFrame([], SHAPE).schema, "feed")


def _unfit(value: Column, kind: str) -> Column:
    """Whether a value is there and doesn't fit a type."""
    fits = value.try_cast(kind).isNotNull()
    if kind == "bigint":  # 1.5 is no whole number, though it can be cast to one
        fits = value.rlike(r"^\s*[+-]?\d{1,19}\s*$") & fits
    return value.isNotNull() & ~fits


def observed_fields(raw: DataFrame, table: CdcTable, known: dict[str, str]) -> DataFrame:
    """(field, records, unfit, fits): the fields in the images of a feed, in one pass.

    ``unfit`` counts values that don't fit the known type of the field; ``fits``
    lists the candidate types that all its values fit. One row for each field.
    """
    # A value that is no text comes as its JSON, so an object or a list is just text here.
    image = F.coalesce(F.get_json_object("value", "$.after"), F.get_json_object("value", "$.before"))
    of_topic = raw.where((F.col("topic") == table.topic) & F.col("value").isNotNull())
    values = of_topic.select(F.explode(F.from_json(image, "map<string,string>")).alias("field", "v"))
    unfit = F.lit(False)
    for name, text in known.items():
        unfit = F.when(F.col("field") == name, _unfit(F.col("v"), text)).otherwise(unfit)
    wrong = [F.max(_unfit(F.col("v"), t).cast("int")).alias(f"w{i}") for i, t in enumerate(CANDIDATES)]
    counted = values.groupBy("field").agg(
        F.count("*").alias("records"), F.count("v").alias("filled"), F.count_if(unfit).alias("unfit"), *wrong)
    fits = F.filter(F.array(*[
        F.when(F.col(f"w{i}") == 0, F.lit(t)) for i, t in enumerate(CANDIDATES)]), lambda t: t.isNotNull())
    return counted.select("field", "records", "filled", "unfit", fits.alias("fits"))


def known_fields(fields: VersionedTable, table: CdcTable) -> dict[str, str]:
    """Field to type of a feed: the fixed columns and what was registered since."""
    rows = fields.read([table.name]).collect()
    newest = max((r["version"] for r in rows), default=0)
    later = {r["field"]: r["type"] for r in rows if r["version"] == newest}
    return {**later, **table.columns}


def widened(fields: VersionedTable, table: CdcTable) -> CdcTable:
    """The table spec with the registered fields behind the fixed ones."""
    known = known_fields(fields, table)
    return replace(table, columns={**table.columns, **{f: t for f, t in known.items() if f not in table.columns}})


def register(
    fields: VersionedTable, raw: DataFrame, table: CdcTable, run: str, watch: Watcher = quiet,
) -> tuple[CdcTable, list[Check]]:
    """Take the fields of an increment in; returns the wider spec and the gate's checks.

    A new field is registered as soon as it holds a value; until then nothing is
    known of it. Versions grow by one with each run that adds fields. Types of
    registered fields never change here: that is for a person to decide.
    """
    known = known_fields(fields, table)
    seen = observed_fields(raw, table, known)
    # One row for each field name.
    rows = seen.collect()
    base = fields.version()
    done = contains(_run_of(base, table), run)
    new = {r["field"]: r["fits"][0] for r in rows if r["field"] not in known and r["filled"]}
    if new and not done:
        old = fields.read([table.name], base).collect()
        version = max((r["version"] for r in old), default=0) + 1
        kept = [(r["feed"], r["version"], r["field"], r["type"], r["since"]) for r in old]
        lists = {r["field"]: (r["type"], r["since"]) for r in old if r["version"] == version - 1}
        lists |= {field: (kind, run) for field, kind in new.items()}
        added = [(table.name, version, field, kind, since) for field, (kind, since) in sorted(lists.items())]
        fields.replace(fields.spark.createDataFrame(kept + added, SHAPE), [table.name],
                       {f"{RUN}.{table.name}": run}, base, watch)
    spark = fields.spark
    found = spark.createDataFrame(
        [(table.name, r["field"], known.get(r["field"], ""), r["unfit"]) for r in rows],
        "feed string, field string, type string, unfit long")
    return widened(fields, table), [
        Check(f"changed type in {table.name}", found, "field", F.col("unfit") > 0)]


def _run_of(version, table: CdcTable):
    return replace(version, notes={RUN: version.notes.get(f"{RUN}.{table.name}", "")})
