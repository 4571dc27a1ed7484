"""Tables of folders behind a pointer: readers always see one version.

A table is split by one column (a bucket number, a day). A write puts new folders
beside the old ones and then adds a version file, which names the folder of every
value. Nothing that a version names is changed or deleted before it expires, so a
job that dies leaves the last version as it was, and readers of a version are not
disturbed. Notes of a version are written with it: marks of what it contains move
exactly when the rows do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreflow.sources.files import Files
from oreflow.sources.swaps import Watcher, quiet

#: Folder names carry the split value under this name; the column itself stays in the files.
_SPLIT = "split"
_VERSIONS, _DATA = "_versions", "data"


def _name(value) -> str:
    return "null" if value is None else str(value)


@dataclass(frozen=True)
class Version:
    """Which folder holds each value of the split column, and notes."""

    number: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)


class VersionedTable:
    """A table below ``path`` whose values of column ``split`` are replaced one by one.

    Split values are few (buckets, days): their names are in the version file and
    on the driver. One job writes at a time; a second one fails at its commit.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, split: str):
        self.spark, self.schema, self.split = spark, schema, split
        self.files = Files(spark, path)

    def numbers(self) -> list[int]:
        names = self.files.children(_VERSIONS)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """A version by number, by default the newest; an empty one if there is none."""
        numbers = self.numbers()
        if number is None and not numbers:
            return Version()
        known = json.loads(self.files.read(f"{_VERSIONS}/{number or numbers[-1]:012d}.json"))
        return Version(known["number"], known["folders"], known["notes"])

    def read(self, values: Iterable | None = None, version: Version | None = None) -> DataFrame:
        """Rows of some or all split values; only their folders are listed and read."""
        version = version or self.version()
        wanted = version.folders if values is None else set(map(_name, values)) & set(version.folders)
        paths = [self.files.path(version.folders[v]) for v in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def replace(
        self, rows: DataFrame, values: Iterable, notes: Mapping[str, object] | None = None,
        base: Version | None = None, watch: Watcher = quiet,
    ) -> Version:
        """Add a version in which ``rows`` are all there is of the split values ``values``.

        ``base`` is the version that ``rows`` were made from. A row with another
        split value is an error. Notes are added to those of ``base``.
        """
        base = base or self.version()
        values = set(map(_name, values))
        folder = f"{_DATA}/{uuid.uuid4().hex}"
        value = F.coalesce(F.col(self.split).cast("string"), F.lit("null"))
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        (rows.select(*typed).withColumn(_SPLIT, value)
         .write.partitionBy(_SPLIT).parquet(self.files.path(folder)))
        watch("write")
        written = {name.split("=", 1)[1]: f"{folder}/{name}"
                   for name in self.files.children(folder) if name.startswith(f"{_SPLIT}=")}
        if not set(written) <= values:
            raise ValueError(f"rows of other values of {self.split}: {sorted(set(written) - values)[:5]}")
        kept = {v: f for v, f in base.folders.items() if v not in values}
        made = Version(base.number + 1, kept | written, {**base.notes, **(notes or {})})
        self.files.write_new(f"{_VERSIONS}/{made.number:012d}.json", json.dumps({
            "number": made.number, "folders": made.folders, "notes": made.notes}))
        watch("commit")
        return made

    def expire(self, keep: int = 5) -> int:
        """Delete all but the newest versions, and folders that no kept one names.

        Folders of a write that is not committed go as well, so no job may be
        writing. Returns the number of folders deleted.
        """
        numbers = self.numbers()
        for number in numbers[:-max(1, keep)]:
            self.files.delete(f"{_VERSIONS}/{number:012d}.json")
        named = {f for n in numbers[-max(1, keep):] for f in self.version(n).folders.values()}
        gone = 0
        for write in self.files.children(_DATA):
            below = [f"{_DATA}/{write}/{name}" for name in self.files.children(f"{_DATA}/{write}")]
            if not named & set(below):
                self.files.delete(f"{_DATA}/{write}")
                gone += 1
                continue
            for folder in below:
                if folder not in named and f"/{_SPLIT}=" in folder:
                    self.files.delete(folder)
                    gone += 1
        return gone
