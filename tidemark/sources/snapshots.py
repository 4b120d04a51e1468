"""Versioned tables on plain files: write a new version, then swap a pointer.

A path that is being read is never overwritten.  Partitions by month make
retention and backups directory operations.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files

#: Seconds that a writer may take.
LEASE_S = 6 * 3600


class Conflict(RuntimeError):
    """Someone else has replaced the table since it was read."""


class Table:
    """A directory of ``v=N`` versions and a one-row ``current`` table per swap."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[int]:
        """Committed versions in order; a version counts once its success marker exists."""
        fs, path = self._fs()
        root = path(self.path)
        if not fs.exists(root):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[2:]) for n in found if n.startswith("v=") and fs.exists(path(f"{self.path}/{n}/_SUCCESS")))

    def _dead(self, version: int) -> bool:
        """Whether a version was claimed long ago and isn't there."""
        said = files.text_of(self.spark, f"{self.path}/claims/{version}")
        return bool(said) and time.time() - float(said) > LEASE_S

    def read(self) -> DataFrame | None:
        have = self.versions()
        return self.spark.read.parquet(f"{self.path}/v={have[-1]}") if have else None

    def replace(self, rows: DataFrame, by: str | None = None, keep: int = 2, base: int | None = None) -> int:
        """Write the next version (partitioned ``by`` a column), then drop all but ``keep``.

        The version's number is claimed first by a file that only one writer can create,
        so no two writers share a path.  ``base`` is the version that ``rows`` were made
        from (0: none): if that isn't the latest any more, or its successor is claimed,
        :class:`Conflict` is raised and nothing is written.  A claim that is older than
        ``LEASE_S`` without a version is a dead writer's: its number is passed over.
        """
        have = self.versions()
        new = (have[-1] if have else 0) + 1
        if base is not None and base != new - 1:
            raise Conflict(f"version {new - 1} isn't {base}")
        while not files.create_once(self.spark, f"{self.path}/claims/{new}", f"{time.time():.0f}"):
            if base is not None and not self._dead(new):
                raise Conflict(f"version {new} is claimed")
            new += 1
        fs, path = self._fs()
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(f"{self.path}/v={new}")
        if (now := self.versions())[-1] != new and base is not None:
            raise Conflict(f"version {now[-1]} came while {new} was written")
        for old in [*have, new][:-keep]:
            fs.delete(path(f"{self.path}/v={old}"), True)
        return new


def drop_partitions(spark: SparkSession, path: str, column: str, before: str) -> list[str]:
    """Delete partition directories with values under ``before`` (retention); returns their names."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith(f"{column}=") and name.split("=", 1)[1] < before:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return sorted(gone)


def backups_to_keep(days: list[str], recent: int = 7) -> list[str]:
    """Of dated full backups, the newest ``recent`` and the first of each month."""
    days = sorted(set(days))
    firsts = {min(d for d in days if d[:7] == m) for m in {d[:7] for d in days}}
    return sorted(set(days[-recent:]) | firsts)


def partitions_to_copy(present: list[str], copied: list[str], current: str) -> tuple[list[str], list[str]]:
    """Month partitions to copy (new ones, and the open month again) and copies to delete (source gone)."""
    return sorted(p for p in present if p not in copied or p == current), sorted(c for c in copied if c not in present)
