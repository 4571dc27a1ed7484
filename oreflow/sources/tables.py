"""Tables: database extracts, daily snapshots, catalog tables, replaceable tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from oreflow.operators.keyed import merge_changes
from oreflow.schemas import RETENTION_DAYS, RETENTION_MIN_SNAPSHOTS, SNAPSHOTS
from oreflow.sources.files import Files
from oreflow.sources.swaps import Watcher, quiet, replace_files, settle

_VERSION_FORMAT = "%Y%m%d%H%M%S%f"
_PUBLISHED = "oreflow.published"
_VERSION_MARK = "__v"


# ---------------------------------------------------------------------------
# Database extracts
# ---------------------------------------------------------------------------
def database_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Full read of a database table in parallel key ranges.

    Rows outside the bounds are read too: the outer ranges are open.
    """
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={"fetchsize": str(fetch_size), **(properties or {})},
    )


def changed_since(rows: DataFrame, mark: Column, column: str = "updated_at") -> DataFrame:
    """Incremental extract: rows touched after the last high-water mark."""
    return rows.where(F.col(column) > mark)


def high_water_mark(rows: DataFrame, column: str = "updated_at") -> DataFrame:
    """The mark the next incremental extract starts from."""
    return rows.agg(F.max(column).alias("high_water_mark"))


# ---------------------------------------------------------------------------
# Daily snapshots, ``table/ds=YYYY-MM-DD``
# ---------------------------------------------------------------------------
def stamp(rows: DataFrame, ds: str) -> DataFrame:
    """A full extract becomes the snapshot of one day."""
    return rows.withColumn("ds", F.lit(ds))


def write_snapshot(rows: DataFrame, path: str, ds: str) -> None:
    """Write one day; writing it again replaces that day and no other.

    Decimals are stored as double, as analytical file exports do.
    """
    flat = rows.select(*[
        F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in rows.schema.fields
    ])
    (
        stamp(flat, ds)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """All days of a snapshot table; filters on ``ds`` prune directories.

    The schema of a known table is fixed. Otherwise it comes from the files.
    """
    reader = spark.read
    if table is not None:
        reader = reader.schema(SNAPSHOTS[table])
    return reader.parquet(path)


def create_like(spark: SparkSession, name: str, rows: DataFrame, partition_by: str | None) -> None:
    """Create an empty table with the columns of ``rows`` unless it exists."""
    if spark.catalog.tableExists(name):
        return
    ensure_database(spark, name)
    writer = rows.limit(0).write.format("parquet")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


def load_day(spark: SparkSession, snapshots: DataFrame, name: str, ds: str) -> None:
    """Load one day into a table partitioned by ``ds``, replacing that day."""
    create_like(spark, name, snapshots, "ds")
    columns = [c for c in spark.table(name).columns if c != "ds"]
    day = snapshots.where(F.col("ds") == ds).select(*columns)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (ds = '{date.fromisoformat(ds)}') "
        "SELECT * FROM {day}",
        day=day,
    )


def newest_ds(spark: SparkSession, name: str) -> str | None:
    """Newest day of a partitioned table, from its partition list alone."""
    parts = spark.sql(f"SHOW PARTITIONS {name}")
    newest = parts.select(F.max(F.regexp_extract("partition", r"ds=([^/]+)", 1))).first()
    return newest[0]


# ---------------------------------------------------------------------------
# Tables that are replaced as a whole
# ---------------------------------------------------------------------------
def ensure_database(spark: SparkSession, name: str) -> None:
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")


def replace_table(
    spark: SparkSession,
    name: str,
    rows: DataFrame,
    partition_by: Sequence[str] = (),
    lakehouse: bool = False,
) -> str:
    """Create or replace a table; readers see the old or the new one, never half.

    A lakehouse catalog swaps atomically itself. Parquet cannot, so each build
    is a table of its own and a view of the given name moves to it at the end.
    Returns the name of the table that was written.
    """
    ensure_database(spark, name)
    if lakehouse:
        writer = rows.writeTo(name)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        return name
    version = f"{name}{_VERSION_MARK}{datetime.now(timezone.utc).strftime(_VERSION_FORMAT)}"
    if partition_by:
        # Even file sizes also where one partition value holds most rows.
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).saveAsTable(version)
    else:
        rows.write.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    # From now on readers see this build; one that never gets here was never seen.
    seen = datetime.now(timezone.utc).strftime(_VERSION_FORMAT)
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{_PUBLISHED}' = '{seen}')")
    return version


def _builds(spark: SparkSession, name: str) -> list[tuple[str, datetime, datetime | None]]:
    """(build, begun, published) of a replaceable table; published is None if it never was."""
    database, table = name.rsplit(".", 1) if "." in name else ("default", name)
    try:
        listed = spark.catalog.listTables(database, f"{table}{_VERSION_MARK}*")
    except AnalysisException:
        return []
    found = []
    for entry in listed:
        version = f"{database}.{entry.name}"
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {version}").collect()}
        begun, published = (
            text and datetime.strptime(text, _VERSION_FORMAT).replace(tzinfo=timezone.utc)
            for text in (entry.name.rsplit(_VERSION_MARK, 1)[1], properties.get(_PUBLISHED)))
        found.append((version, begun, published))
    return found


def versions(spark: SparkSession, name: str) -> list[tuple[str, datetime]]:
    """Builds that readers have seen, newest first, with the time they became visible."""
    seen = [(version, at) for version, _, at in _builds(spark, name) if at is not None]
    return sorted(seen, key=lambda v: v[1], reverse=True)


def version_as_of(spark: SparkSession, name: str, at: datetime) -> DataFrame:
    """The build that readers saw at a point in time."""
    for version, published in versions(spark, name):
        if published <= at:
            return spark.table(version)
    raise LookupError(f"{name} has no version at or before {at}")


def expire_versions(
    spark: SparkSession,
    name: str,
    older_than: datetime,
    keep: int = RETENTION_MIN_SNAPSHOTS,
) -> list[str]:
    """Drop builds older than the cutoff, always keeping the newest ``keep`` published ones.

    Builds that were begun before the cutoff and never published are left from
    jobs that died; they go as well and count for nothing.
    """
    old = [v for v, published in versions(spark, name)[max(keep, 1):] if published < older_than]
    dead = [v for v, begun, at in _builds(spark, name) if at is None and begun < older_than]
    for version in old + dead:
        spark.sql(f"DROP TABLE {version}")
    return old + dead


def bucket_of(key: str, buckets: int) -> Column:
    """Number of the folder that holds a key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether there are data files below a folder."""
    files = Files(spark, path)
    return files.exists("") and bool(files.data_files(""))


def merge_table(
    spark: SparkSession, path: str, increment: DataFrame, key: str, buckets: int,
    forget_before: Column | None = None, watch: Watcher = quiet,
) -> int:
    """Merge changes into a state kept in ``buckets`` folders by key hash; returns how many it rewrote.

    Only folders that hold a changed key are read and replaced, so an increment
    costs as much as what it touches. Old files go when their successors are
    written and named in a manifest, so a run that died at any step is run again
    with the same changes. ``versioned.VersionedTable`` is for readers that must
    always see one version.
    """
    settle(spark, path)
    changes = increment.withColumn("bucket", bucket_of(key, buckets))
    # At most ``buckets`` numbers.
    touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]
    if not touched:
        return 0
    changes.limit(0).write.mode("append").partitionBy("bucket").parquet(path)
    files = Files(spark, path)
    old = [name for b in touched for name in files.data_files(f"bucket={b}")]
    state = spark.read.schema(changes.schema).parquet(path).where(F.col("bucket").isin(touched))
    merged = merge_changes(state, changes, key, forget_before)
    replace_files(
        spark, path, old, lambda aside: merged.write.partitionBy("bucket").parquet(aside), watch)
    return len(touched)


def file_inventory(rows: DataFrame) -> DataFrame:
    """Data files behind a file-based frame, with their size and row count."""
    return rows.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count("*").alias("rows"))


def retained_snapshots(
    snapshots: DataFrame,
    today: str,
    days: int = RETENTION_DAYS,
    at_least: int = RETENTION_MIN_SNAPSHOTS,
) -> DataFrame:
    """Snapshot days with a flag: inside retention, or among the newest few."""
    present = snapshots.select("ds").distinct()
    newest = present.orderBy(F.desc("ds")).limit(at_least).agg(F.min("ds")).scalar()
    cutoff = F.date_format(F.date_sub(F.to_date(F.lit(today)), days), "yyyy-MM-dd")
    return present.withColumn(
        "kept", (F.col("ds") >= cutoff) | (F.col("ds") >= newest)
    )
