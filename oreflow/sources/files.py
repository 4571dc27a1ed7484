"""The few file operations that commit records need, on any Hadoop file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Files and folders below ``root``, named relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._jvm = spark, spark._jvm
        base = self._jvm.org.apache.hadoop.fs.Path(root)
        self._fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self._fs.makeQualified(base).toString().rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)

    def relative(self, path: str) -> str:
        """Name of a file of this root from the path that Spark reports for it."""
        text = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(path)).toString()
        whole = self._fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(text)).toString()
        if not whole.startswith(f"{self.root}/"):
            raise ValueError(f"{whole} is not below {self.root}")
        return whole[len(self.root) + 1:]

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def children(self, name: str) -> list[str]:
        """Names directly below a folder; none if it is not there."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(name)))

    def data_files(self, name: str) -> list[str]:
        """Data files anywhere below a folder; hidden files and folders are skipped."""
        if not self.exists(name):
            return []
        top = self._path(name)
        found, listing = [], self._fs.listFiles(top, True)
        start = len(top.toString()) + 1
        while listing.hasNext():
            whole = listing.next().getPath().toString()
            below = whole[start:].split("/")
            if not any(part[0] == "." or part[0] == "_" and "=" not in part for part in below):
                found.append(whole[len(self.root) + 1:])
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, name: str) -> None:
        """Delete a file or a folder with all in it; nothing if it is not there."""
        self._fs.delete(self._path(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Write a small file that becomes visible as a whole; it may not be there yet."""
        aside = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(name):
            self.delete(aside)
            raise FileExistsError(self.path(name))
        self.move(aside, name)
