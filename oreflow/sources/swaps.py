"""Replace files of a plain folder so that a job that dies loses and doubles no row.

New files are written under ``_swap``, which readers skip. A manifest then names
the old files and the new ones: with it the swap is decided. Old files go, new
ones move in, and the manifest goes last. ``settle`` is what every start does
first: a swap with a manifest is finished, one without is undone. One job writes
to a folder at a time; readers that must not meet a swap half-way use
``read_settled``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from oreflow.sources.files import Files

SWAPS = "_swap"
#: Called with the name of each step that is done; tests stop a job there.
Watcher = Callable[[str], None]


def quiet(step: str) -> None:
    pass


def _pending(files: Files) -> list[tuple[str, dict | None]]:
    """(folder, manifest) of the swaps that are under way; undecided ones have none."""
    out = []
    for name in files.children(SWAPS):
        manifest = f"{SWAPS}/{name}/manifest.json"
        out.append((f"{SWAPS}/{name}", json.loads(files.read(manifest)) if files.exists(manifest) else None))
    return out


def _carry_out(files: Files, folder: str, manifest: dict, watch: Watcher) -> None:
    """Every step can be repeated: what is gone or moved already is left alone."""
    for old in manifest["old"]:
        files.delete(old)
        watch("delete")
    for staged, new in manifest["new"].items():
        if files.exists(f"{folder}/files/{staged}"):
            files.move(f"{folder}/files/{staged}", new)
            watch("move")
        elif not files.exists(new):
            raise OSError(f"{files.path(new)} is neither staged nor in place")
    files.delete(folder)
    watch("end")


def settle(spark: SparkSession, path: str) -> int:
    """Finish or undo the swaps that a job left behind; returns how many there were."""
    files = Files(spark, path)
    left = _pending(files)
    for folder, manifest in left:
        if manifest is None:
            files.delete(folder)
        else:
            _carry_out(files, folder, manifest, quiet)
    return len(left)


def replace_files(
    spark: SparkSession, path: str, old: Sequence[str], write: Callable[[str], None],
    watch: Watcher = quiet,
) -> int:
    """Put what ``write`` writes to the folder it is given in place of the files ``old``.

    Names are relative to ``path``. Returns the number of new files.
    """
    files, swap = Files(spark, path), uuid.uuid4().hex
    folder = f"{SWAPS}/{swap}"
    write(files.path(f"{folder}/files"))
    watch("write")
    start = len(f"{folder}/files/")
    new = {}
    for i, name in enumerate(files.data_files(f"{folder}/files")):
        inner, _, base = name[start:].rpartition("/")
        # Names of their own: a task writes to several folders under one name.
        own = f"part-{i:05d}-{swap}.{base.partition('.')[2]}"
        new[name[start:]] = f"{inner}/{own}" if inner else own
    manifest = {"old": list(old), "new": new}
    files.write_new(f"{folder}/manifest.json", json.dumps(manifest))
    watch("manifest")
    _carry_out(files, folder, manifest, watch)
    return len(new)


def read_settled(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a folder as they are before or after each swap, never in between."""
    files = Files(spark, path)
    decided = [(folder, manifest) for folder, manifest in _pending(files) if manifest is not None]
    replaced = {old for _, manifest in decided for old in manifest["old"]}
    frames = [_read(spark, files.root, schema, [
        files.path(name) for name in files.data_files("") if name not in replaced])]
    for folder, _ in decided:
        base = files.path(f"{folder}/files")
        frames.append(_read(spark, base, schema, [
            files.path(name) for name in files.data_files(f"{folder}/files")]))
    return reduce(DataFrame.unionByName, frames)


def _read(spark: SparkSession, base: str, schema: StructType, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*names).select(*schema.names)
