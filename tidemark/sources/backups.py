"""Backups of files: copied by tasks, named by content, noted in a manifest, verified on restore.

A blob is stored once under its SHA-256, whatever file or backup it belongs to, so a
backup moves what is new.  The manifest of a backup (``path``, ``length``, ``modified``,
``digest``) is written last: without one there is no backup.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as store
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files, snapshots

MANIFEST = "path string, length long, modified long, digest string"
_CHUNK = 4 << 20


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (below ``root``), ``length`` and ``modified`` of all files; a row per file."""
    fs, top = files.of(spark, root)
    base = fs.makeQualified(top).toUri().getPath().rstrip("/") + "/"
    found, each = [], fs.listFiles(top, True)
    while each.hasNext():
        s = each.next()
        found.append((s.getPath().toUri().getPath().removeprefix(base), s.getLen(), s.getModificationTime()))
    return spark.createDataFrame(found, "path string, length long, modified long")


def _hashed(source: store.NativeFile, target: store.NativeFile | None = None) -> tuple[int, str]:
    """Length and digest of a stream, copied on the way."""
    h, n = hashlib.sha256(), 0
    while chunk := source.read(_CHUNK):
        h.update(chunk)
        n += len(chunk)
        if target is not None:
            target.write(chunk)
    return n, h.hexdigest()


def _opened(uri: str) -> tuple[store.FileSystem, str]:
    return store.FileSystem.from_uri(uri)


class Backups:
    """Backups under ``path``: ``blobs`` by digest and a manifest table per backup."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def labels(self) -> list[str]:
        fs, root = files.of(self.spark, f"{self.path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(n for n in names if self.manifest(n) is not None)

    def manifest(self, label: str) -> DataFrame | None:
        return snapshots.Table(self.spark, f"{self.path}/manifests/{label}").read()

    def make(self, root: str, label: str) -> dict[str, int]:
        """Back up all files under ``root``; returns how many files there are, and how many were read.

        Files that the newest backup has with the same length and time are taken over
        unread, as data files are never changed in place."""
        now, before = listing(self.spark, root), self.labels()
        known = self.manifest(before[-1]) if before else self.spark.createDataFrame([], MANIFEST)
        same = now.join(known, ["path", "length", "modified"])
        new = now.join(known, ["path", "length", "modified"], "left_anti")
        blobs, source = f"{self.path}/blobs", root.rstrip("/")

        def copy(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fs_in, base = _opened(source)
            fs_out, under = _opened(blobs)
            fs_out.create_dir(under, recursive=True)
            for part in parts:
                digests = []
                for path, length in zip(part["path"], part["length"], strict=True):
                    half = f"{under}/half-{uuid.uuid4().hex}"
                    with fs_in.open_input_stream(f"{base}/{path}") as a, fs_out.open_output_stream(half) as b:
                        n, digest = _hashed(a, b)
                    if n != length:
                        raise OSError(f"{path} has {n} bytes, {length} were listed")
                    fs_out.create_dir(f"{under}/{digest[:2]}", recursive=True)
                    fs_out.move(half, f"{under}/{digest[:2]}/{digest}")  # equal content may be there already
                    digests.append(digest)
                yield part.assign(digest=digests)

        copied = new.repartition("path").mapInPandas(copy, MANIFEST)
        table = snapshots.Table(self.spark, f"{self.path}/manifests/{label}")
        table.replace(copied.unionByName(same.select(*copied.columns)))
        noted = table.read()
        files_, fresh = noted.count(), noted.join(known, ["path", "length", "modified"], "left_anti").count()
        return {"files": files_, "read": fresh}

    def restore(self, label: str, root: str) -> DataFrame:
        """Write a backup's files below ``root``; returns ``path`` and ``error`` of those that couldn't
        be, because a blob is missing or isn't what it was."""
        return self._each(label, root)

    def verify(self, label: str) -> DataFrame:
        """``path`` and ``error`` of files whose blob is missing or broken; nothing is written."""
        return self._each(label, None)

    def _each(self, label: str, root: str | None) -> DataFrame:
        rows = self.manifest(label)
        if rows is None:
            raise KeyError(label)
        blobs, target = f"{self.path}/blobs", root.rstrip("/") if root else None

        def check(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fs_in, under = _opened(blobs)
            for part in parts:
                wrong = []
                for path, length, digest in zip(part["path"], part["length"], part["digest"], strict=True):
                    blob, half = f"{under}/{digest[:2]}/{digest}", None
                    try:
                        with fs_in.open_input_stream(blob) as a:
                            if target is None:
                                got = _hashed(a)
                            else:
                                fs_out, base = _opened(target)
                                fs_out.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                                half = f"{base}/{path}.half-{uuid.uuid4().hex}"
                                with fs_out.open_output_stream(half) as b:
                                    got = _hashed(a, b)
                    except FileNotFoundError:
                        wrong.append((path, "missing"))
                        continue
                    if got != (length, digest):
                        wrong.append((path, "broken"))
                        if half:
                            fs_out.delete_file(half)
                    elif half:
                        fs_out.move(half, f"{base}/{path}")
                yield pd.DataFrame(wrong, columns=["path", "error"])

        found = rows.repartition("path").mapInPandas(check, "path string, error string")
        return self.spark.createDataFrame(found.collect(), "path string, error string")  # files that failed: none, or few

    def prune(self, recent: int = 7) -> list[str]:
        """Drop backups (labels are days) but the newest and the first of each month, and blobs that
        no other one has; returns the labels that went.  No ``make`` may be under way."""
        labels = self.labels()
        gone = sorted(set(labels) - set(snapshots.backups_to_keep(labels, recent)))
        kept = self.spark.createDataFrame([], "digest string")
        for label in labels:
            if label not in gone:
                kept = kept.unionByName(self.manifest(label).select("digest"))
        blobs = listing(self.spark, f"{self.path}/blobs").select("path", F.substring_index("path", "/", -1).alias("digest"))
        dead = blobs.join(kept.distinct(), "digest", "left_anti").collect()  # a row per blob that goes
        for label in gone:
            fs, p = files.of(self.spark, f"{self.path}/manifests/{label}")
            fs.delete(p, True)
        for r in dead:
            fs, p = files.of(self.spark, f"{self.path}/blobs/{r.path}")
            fs.delete(p, False)
        return gone
