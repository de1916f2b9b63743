"""Tables in versions: written aside, published by one pointer, read by name or the latest, described and dropped. On any file system that Hadoop knows."""

from __future__ import annotations

import re
import uuid
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_LATEST, _NAME = "LATEST", re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class VersionError(Exception):
    """A version is missing, exists already, or has no legal name."""


class Versions:
    """The versions of one table below a folder. ``<path>/<version>`` are Parquet tables; ``<path>/LATEST`` holds the latest one's name.

    A table is written to a folder of its own that no reader knows, then renamed to its version, then the pointer is replaced by a rename over it. A write
    that fails or is cut off leaves all versions and the pointer as they were. Renames are single steps on HDFS and local disks; on an object store they
    are as good as its connector makes them. Two writers of the same version: the second one's rename fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._at().getFileSystem(self._conf)

    def _at(self, *parts: str) -> Any:
        return self._hadoop.Path("/".join((self.path, *parts)))

    def _move(self, source: Any, target: Any, over: bool) -> None:
        how = self._hadoop.Options.Rename
        ways = self.spark.sparkContext._gateway.new_array(how, 1)
        ways[0] = how.OVERWRITE if over else how.NONE
        self._hadoop.FileContext.getFileContext(self._system.getUri(), self._conf).rename(self._system.makeQualified(source), self._system.makeQualified(target), ways)

    def names(self) -> list[str]:
        """All versions, by name."""
        if not self._system.exists(self._at()):
            return []
        found = [(s.getPath().getName(), s.isDirectory()) for s in self._system.listStatus(self._at())]
        return sorted(n for n, folder in found if folder and _NAME.fullmatch(n))

    def latest(self) -> str | None:
        if not self._system.exists(self._at(_LATEST)):
            return None
        return self.spark.read.text(f"{self.path}/{_LATEST}").first()[0]

    def exists(self, version: str | None = None) -> bool:
        return self.latest() is not None if version is None else version in self.names()

    def save(self, df: DataFrame, version: str | None = None) -> str:
        """Write a version, by default named by the time, and publish it as the latest; its name."""
        version = version or datetime.now(UTC).strftime("%Y-%m-%dT%H.%M.%S.%fZ")
        if not _NAME.fullmatch(version):
            raise VersionError(f"{version!r} is no name of a version")
        if self.exists(version):
            raise VersionError(f"version {version} exists already")
        aside = f"_writing-{uuid.uuid4().hex}"
        try:
            df.write.parquet(f"{self.path}/{aside}")
            self._move(self._at(aside), self._at(version), over=False)
        finally:
            self._system.delete(self._at(aside), True)
        self.publish(version)
        return version

    def publish(self, version: str) -> None:
        """Make a version the latest, an older one as well."""
        if not self.exists(version):
            raise VersionError(f"version {version} is missing")
        aside = self._at(f"_pointer-{uuid.uuid4().hex}")
        out = self._system.create(aside)
        out.write(bytearray(version.encode()))
        out.close()
        self._move(aside, self._at(_LATEST), over=True)

    def load(self, version: str | None = None) -> DataFrame:
        """A version, or the latest one."""
        found = version or self.latest()
        if found is None or not self.exists(found):
            raise VersionError(f"version {found} is missing" if found else f"{self.path} has no version")
        return self.spark.read.parquet(f"{self.path}/{found}")

    def describe(self, version: str | None = None) -> dict[str, Any]:
        """What is known of a version without reading its rows, and all versions' names."""
        found = version or self.latest()
        size = self._system.getContentSummary(self._at(found)) if found and self.exists(found) else None
        return {
            "path": self.path, "version": found, "latest": self.latest(), "versions": self.names(), "files": size.getFileCount() if size else None, "bytes": size.getLength() if size else None,
            "schema": self.load(found).schema.simpleString() if size else None,
        }

    def drop(self, version: str) -> None:
        """Delete a version that isn't the latest."""
        if version == self.latest():
            raise VersionError(f"version {version} is the latest")
        if not self.exists(version):
            raise VersionError(f"version {version} is missing")
        self._system.delete(self._at(version), True)

    def invalidate(self) -> None:
        """Forget cached files and listings of all versions."""
        self.spark.catalog.refreshByPath(self.path)
