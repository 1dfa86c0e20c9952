"""Tables that change all at once: write aside, check, then publish.

A version of a table is a folder of its own. It is written and read back, its
declared keys are checked on what was written, and only then does a manifest
name it as the current one. The manifest is a numbered file that appears by
one rename, so a reader sees the old version or the new one, never a half; two
writers cannot both take a number. A version that fails a check is deleted and
the table stays as it was. ``expire`` removes the folders that no kept manifest
names, those of writers that were lost included.

All files are reached through the store that Spark is configured with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import fk_check, pk_check

Check = Callable[[DataFrame], list[str]]


class CheckFailed(ValueError):
    """A written version broke a declared key; it was not published."""


def unique_key(key: str) -> Check:
    """The key has no null and no value twice."""
    def check(df: DataFrame) -> list[str]:
        row = pk_check({"t": (df, key)}).first()
        return [f"{key}: {row[c]} {what}" for c, what in (("null_keys", "rows without it"), ("duplicate_keys", "values repeat")) if row[c]]
    return check


def references(fk: str, dim: DataFrame, pk: str) -> Check:
    """Every value of ``fk`` is a key of ``dim``."""
    def check(df: DataFrame) -> list[str]:
        n = fk_check(df, {fk: (dim, pk)}).first()["orphan_rows"]
        return [f"{fk}: {n} rows match no {pk}"] if n else []
    return check


class TableStore:
    """Published tables under one folder of the shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def _names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        return sorted(s.getPath().getName() for s in self._fs().listStatus(path)) if self._fs().exists(path) else []

    def manifests(self, name: str) -> list[tuple[int, str]]:
        """(number, version) of every publication, oldest first."""
        found = [n.split(".") for n in self._names(name, "_manifest") if not n.startswith(("_", "."))]
        return [(int(number), version) for number, version in found]

    def current(self, name: str) -> str | None:
        published = self.manifests(name)
        return published[-1][1] if published else None

    def read(self, name: str, version: str | None = None) -> DataFrame:
        version = version or self.current(name)
        if version is None:
            raise LookupError(f"{self.root}/{name}: nothing published")
        return self.spark.read.parquet(f"{self.root}/{name}/{version}")

    def publish(self, name: str, df: DataFrame, checks: list[Check] = (), partition_by: list[str] = ()) -> DataFrame:
        """Write ``df`` as the table's next version and return it as stored."""
        version = uuid.uuid4().hex
        folder = f"{self.root}/{name}/{version}"
        df.write.partitionBy(*partition_by).parquet(folder) if partition_by else df.write.parquet(folder)
        staged = self.spark.read.schema(df.schema).parquet(folder)
        problems = [p for check in checks for p in check(staged)]
        if problems:
            self._fs().delete(self._path(name, version), True)
            raise CheckFailed(f"{name} not published: " + "; ".join(problems))
        self._announce(name, version)
        return staged

    def _announce(self, name: str, version: str) -> None:
        """The next manifest, by renaming a finished file: its name is the
        number that one writer gets, and the version."""
        taken = [n for n, _ in self.manifests(name)] + [int(n) for n in self._names(name, "_claims") if n.isdigit()]
        fs, number = self._fs(), max(taken, default=0) + 1  # a lost writer's number is skipped
        claim = self._path(name, "_claims", f"{number:012d}")
        fs.mkdirs(self._path(name, "_claims"))
        fs.mkdirs(self._path(name, "_manifest"))
        fs.create(claim, False).close()  # fails if another writer has this number
        if not fs.rename(claim, self._path(name, "_manifest", f"{number:012d}.{version}")):
            raise OSError(f"{self.root}/{name}: version {version} could not be published")

    def expire(self, name: str, keep: int = 2) -> list[str]:
        """Delete all versions but the last ``keep`` published, and the older
        manifests; no writer may be at work on the table. Returns the deleted
        versions."""
        published, fs = self.manifests(name), self._fs()
        kept = {version for _, version in published[-keep:]}
        for number, version in published[:-keep]:
            fs.delete(self._path(name, "_manifest", f"{number:012d}.{version}"), False)
        gone = [v for v in self._names(name) if not v.startswith(("_", ".")) and v not in kept]
        for version in gone:
            fs.delete(self._path(name, version), True)
        return gone
