"""The ledger of runs, and a lock per job, on files that the cluster shares.

A run is an ``open`` and a ``close`` row of an append-only table; the ledger is the
latest of both.  A lock is a file that only one writer can create, with its owner and the
end of its lease.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

ROWS = "run_id string, job string, at timestamp, status string, error string, stats map<string,string>"


class Busy(RuntimeError):
    """Another run of the job is open."""


class Ledger:
    """Runs and locks; ``lease_s`` is how long a run may hold its lock without renewing it."""

    def __init__(self, spark: SparkSession, path: str, lease_s: float = 6 * 3600):
        self.spark, self.path, self.lease_s = spark, path.rstrip("/"), lease_s

    def _lock(self, job: str) -> str:
        return f"{self.path}/locks/{job}"

    def _append(self, *row) -> None:
        run_id, job, status, error, stats = row
        one = self.spark.createDataFrame([(run_id, job, status, error, stats)], "run_id string, job string, status string, error string, stats map<string,string>")
        one.select("run_id", "job", F.current_timestamp().alias("at"), "status", "error", "stats").write.mode("append").parquet(f"{self.path}/runs")

    def _take(self, run_id: str, job: str) -> bool:
        return files.create_once(self.spark, self._lock(job), f"{run_id} {time.time() + self.lease_s:.3f}")

    def open_run(self, job: str) -> str:
        """Take the job's lock and note a running run.

        If the lock is held, a refused run is noted (so a planner doesn't try again) and
        :class:`Busy` is raised.  A lock whose lease has run out is a dead driver's: its
        run is noted as failed and the lock changes hands.  If the note fails, the lock is
        given back."""
        run_id = uuid.uuid4().hex
        if not self._take(run_id, job):
            held = files.text_of(self.spark, self._lock(job)) or ""
            owner, _, until = held.partition(" ")
            if until and float(until) < time.time() and files.take_away(self.spark, self._lock(job), held):
                self._append(owner, job, "failed", "the lease ran out", None)
            if not until or float(until) >= time.time() or not self._take(run_id, job):
                self._append(run_id, job, "failed", "another run is open", {"lock_busy": "true", "guard_refused": "true"})
                raise Busy(job)
        try:
            self._append(run_id, job, "running", None, None)
        except BaseException:
            self._release(run_id, job)
            raise
        return run_id

    def _release(self, run_id: str, job: str) -> None:
        held = files.text_of(self.spark, self._lock(job))
        if held is not None and held.split(" ")[0] == run_id:
            files.take_away(self.spark, self._lock(job), held)

    def renew(self, run_id: str, job: str) -> None:
        """Hold the lock for another lease; :class:`Busy` if another run has it by now."""
        self._release(run_id, job)
        if not self._take(run_id, job):
            raise Busy(job)

    def close_run(self, run_id: str, job: str, status: str, stats: dict[str, str] | None = None, error: str | None = None) -> None:
        """Note how a run ended and give its lock back, if it still has it and even if the note fails;
        stats that were noted before stay unless new ones come."""
        try:
            self._append(run_id, job, status, error, stats)
        finally:
            self._release(run_id, job)

    def runs(self) -> DataFrame:
        """One row per run: its last status and error, its last stats, when it started and ended."""
        rows = self.spark.read.schema(ROWS).parquet(f"{self.path}/runs")
        ended = F.max(F.when(F.col("status") != "running", F.col("at")))
        last = F.struct("at", (F.col("status") != "running").alias("over"))
        noted = F.max_by("stats", F.when(F.col("stats").isNotNull(), F.col("at")))
        return rows.groupBy("run_id", "job").agg(F.max_by("status", last).alias("status"), F.max_by("error", last).alias("error"), noted.alias("stats"), F.min("at").alias("started_at"), ended.alias("ended_at"))
