"""Tables that are merged part by part: only the parts that a delivery touches are read and written.

Rows are dealt to parts by a hash of some columns (an issuer, a series).  A manifest says
in which folder each part lies; a merge writes the touched parts into a new folder and
swaps the manifest, so readers see all of a merge or nothing, and no file that is being
read is overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import snapshots

PARTS = 64


@dataclass(frozen=True)
class Merged:
    """What a merge did: parts read and written, and rows per ``status`` if the merge told one."""

    parts: list[int]
    counts: dict[str, int]


class Partitioned:
    """A table under ``path`` with the columns of ``schema``, dealt by a hash of the columns ``by``.

    ``by`` must be part of every key that merges go by, or rows of one key lie in several
    parts.  The number of parts is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, by: Sequence[str], parts: int = PARTS):
        self.spark, self.path, self.schema, self.by, self.parts = spark, path.rstrip("/"), schema, list(by), parts
        self.columns = spark.createDataFrame([], schema).columns
        self.manifest = snapshots.Table(spark, f"{self.path}/manifest")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("__part", F.pmod(F.xxhash64(*self.by), F.lit(self.parts)).cast("int"))

    def folders(self) -> dict[int, str]:
        """Part to folder; parts without rows have none."""
        rows = self.manifest.read()
        return {} if rows is None else {r.part: r.folder for r in rows.collect()}  # a row per part

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some parts."""
        known = self.folders()
        wanted = [f"{self.path}/data/{f}/__part={p}" for p, f in sorted(known.items()) if parts is None or p in parts]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*wanted)

    def part_of(self, rows: DataFrame) -> list[int]:
        """Parts that rows lie in: ``parts`` numbers at most."""
        return sorted(r[0] for r in self._dealt(rows).select("__part").distinct().collect())

    def merge(self, delta: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> Merged:
        """Replace the touched parts by ``how(old, delta)``: rows of the table's columns, and
        ``status`` if it is to be counted (it isn't kept).

        ``how`` sees the touched parts alone.  If another merge comes in between,
        :class:`snapshots.Conflict` is raised and the table stays as that one left it.
        """
        versions, known = self.manifest.versions(), self.folders()
        touched = self.part_of(delta)
        if not touched:
            return Merged([], {})
        new = how(self.read(touched), delta)
        told = [c for c in ("status",) if c in new.columns and c not in self.columns]
        folder = uuid.uuid4().hex
        # a part may be large: rows of one are dealt to several tasks where there are fewer parts than tasks
        self._dealt(new.select(*self.columns, *told)).repartitionByRange(F.col("__part"), *[F.col(c) for c in self.by]).write.partitionBy("__part").parquet(f"{self.path}/data/{folder}")
        fs, path = self.manifest._fs()
        made = {int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(path(f"{self.path}/data/{folder}")) if s.isDirectory()}
        if stray := made - set(touched):
            raise ValueError(f"a merge made rows of parts that the delivery doesn't touch: {sorted(stray)}")
        counts = {}
        if told:
            written = self.spark.read.schema(f"{self.schema}, status string").parquet(f"{self.path}/data/{folder}")
            counts = {r["status"]: r["count"] for r in written.groupBy("status").count().collect()}  # a few kinds
        now = {p: f for p, f in known.items() if p not in touched} | {p: folder for p in made}
        self.manifest.replace(self.spark.createDataFrame(sorted(now.items()), "part int, folder string").coalesce(1), base=versions[-1] if versions else 0)
        return Merged(touched, counts)

    def vacuum(self) -> int:
        """Delete parts that the manifest doesn't name; returns how many.  No merge or old reader may be under way."""
        fs, path = self.manifest._fs()
        known, gone = self.folders(), 0
        root = path(f"{self.path}/data")
        for s in fs.listStatus(root) if fs.exists(root) else []:
            name = s.getPath().getName()
            if name not in known.values():
                gone += fs.delete(s.getPath(), True)
                continue
            for x in fs.listStatus(s.getPath()):
                part = x.getPath().getName()
                if part.startswith("__part=") and known.get(int(part.partition("=")[2])) != name:
                    gone += fs.delete(x.getPath(), True)
        return gone
