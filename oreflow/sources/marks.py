"""How far a feed has been read: the highest offset of every topic partition.

A time alone can't say it: a micro-batch stamps all its rows with one time, and
rows of that time may become visible after the mark was taken. Offsets of a
partition become visible in order, so what lies behind the highest one read is
new. A row that arrived later than anything read is new as well, whatever its
offset says; that covers a topic that was set up again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "feed string, mark timestamp, offsets map<string,bigint>"


def _topic(rows: DataFrame) -> Column:
    return F.col("topic") if "topic" in rows.columns else F.lit("")


@dataclass(frozen=True)
class Mark:
    """Newest arrival and highest offset of each (topic, partition) that was read."""

    time: datetime | None = None
    offsets: Mapping[tuple[str, int], int] = field(default_factory=dict)

    def joined(self, other: Mark) -> Mark:
        """What is covered by either."""
        both = {**self.offsets}
        for place, offset in other.offsets.items():
            both[place] = max(offset, both.get(place, offset))
        times = [t for t in (self.time, other.time) if t is not None]
        return Mark(max(times, default=None), both)


    def to_json(self) -> dict:
        return {"time": self.time and self.time.isoformat(),
                "offsets": {_named(p): o for p, o in self.offsets.items()}}

    @classmethod
    def from_json(cls, known: dict) -> Mark:
        time = known["time"] and datetime.fromisoformat(known["time"])
        return cls(time, {_place(n): o for n, o in known["offsets"].items()})


def _places(rows: DataFrame, mark: Mark, compare) -> Column:
    """Rows of known places whose offset compares; plain comparisons, for the scan to use."""
    found = [(_topic(rows) == topic) & (F.col("kafka_partition") == partition) & compare(
        F.col("kafka_offset"), offset) for (topic, partition), offset in sorted(mark.offsets.items())]
    return reduce(Column.__or__, found, F.lit(False))


def _unread(rows: DataFrame, mark: Mark) -> Column:
    if mark.time is None:
        return F.lit(True)
    known = _places(rows, mark, lambda own, last: own.isNotNull())
    later = _places(rows, mark, lambda own, last: own > last)
    return F.coalesce((F.col("ingested_at") > F.lit(mark.time)) | later | ~known, F.lit(False))


def behind(rows: DataFrame, mark: Mark) -> DataFrame:
    """Rows that a reader with this mark has not read."""
    return rows if mark.time is None else rows.where(_unread(rows, mark))


def covered(rows: DataFrame, mark: Mark) -> DataFrame:
    """Rows that a reader with this mark has read."""
    return rows.where(~_unread(rows, mark))


def reached(rows: DataFrame) -> Mark:
    """The mark of a reader of these rows. One row for each topic partition is collected."""
    ends = rows.groupBy(_topic(rows).alias("topic"), "kafka_partition").agg(
        F.max("kafka_offset").alias("offset"), F.max("ingested_at").alias("time")).collect()
    times = [r["time"] for r in ends if r["time"] is not None]
    return Mark(max(times, default=None), {
        (r["topic"], r["kafka_partition"]): r["offset"] for r in ends if r["offset"] is not None})


def within(rows: DataFrame, end: Mark) -> DataFrame:
    """Rows up to a mark: what lands while a job runs belongs to the next one."""
    upto = _places(rows, end, lambda own, last: own <= last)
    return rows.where((F.col("ingested_at") <= F.lit(end.time)) & upto)


def _named(place: tuple[str, int]) -> str:
    return f"{place[0]}/{place[1]}"


def _place(name: str) -> tuple[str, int]:
    topic, partition = name.rsplit("/", 1)
    return topic, int(partition)


def load(spark: SparkSession, path: str) -> dict[str, Mark]:
    """The marks kept under ``path``, one for each feed."""
    spark.createDataFrame([], MARKS).write.mode("append").parquet(path)
    kept = spark.read.schema(MARKS).parquet(path)
    times = kept.groupBy("feed").agg(F.max("mark").alias("mark")).collect()
    offsets = kept.select("feed", F.explode_outer("offsets").alias("place", "offset")).where(
        "place is not null").groupBy("feed", "place").agg(F.max("offset").alias("offset")).collect()
    found: dict[str, dict[tuple[str, int], int]] = {}
    for r in offsets:
        found.setdefault(r["feed"], {})[_place(r["place"])] = r["offset"]
    return {r["feed"]: Mark(r["mark"], found.get(r["feed"], {})) for r in times}


def keep(spark: SparkSession, path: str, marks: Mapping[str, Mark]) -> None:
    """Add marks; the highest of all that were kept counts."""
    rows = [(feed, m.time, {_named(p): o for p, o in m.offsets.items()}) for feed, m in marks.items()]
    if rows:
        spark.createDataFrame(rows, MARKS).write.mode("append").parquet(path)
