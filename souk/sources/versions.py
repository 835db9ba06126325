"""Versions of a folder of tables, committed by one rename.

``_versions/<n>.json`` says which data folders belong to version n. A writer puts new data where no
version looks yet and then renames the next file into place: a reader sees all of a version or all of
the one before, and a job that fails leaves the last one. One writer per folder at a time; a second
one finds its version taken and fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

VERSIONS = "_versions"  # Spark does not list folders that begin with an underscore


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.folder}/{name}")

    def names(self, folder: str = "") -> list[str]:
        """Names of what a folder below this one holds; none if it does not exist."""
        path = self._at(folder) if folder else self._path(self.folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.names(VERSIONS) if n.endswith(".json"))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._at(f"{VERSIONS}/{number}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """The last version and its content; (0, {}) where nothing was committed yet."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, number: int, content: dict) -> None:
        """Make ``content`` version ``number``; fails if there is one already."""
        target, draft = self._at(f"{VERSIONS}/{number}.json"), self._at(f"{VERSIONS}/_{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise RuntimeError(f"{self.folder}: version {number} is taken by another writer")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
