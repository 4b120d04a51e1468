"""Sessions with the settings the engine relies on, and tables that end a lineage."""

from __future__ import annotations

import getpass
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: UTC sessions, ANSI casts, adaptive execution with skew handling, and the state store of streams.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # state of streams lies in files beside the checkpoint, entry by entry
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(name: str = "tidemark", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``; without that setting an operator
    refuses to run there, as each machine would write to a disk of its own.  Only a
    session on one machine (``local[…]``: tests, a laptop) gets a local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"tidemark-{getpass.getuser()}")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def cut(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder (with writer ``options``) and return a scan of what was written.

    The lineage ends there, so a lost executor costs a re-read and never a
    recomputation, and the optimizer knows the size of the result.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a plan whose generated method is too long for the JVM to compile is run in short ones."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, 8000)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 1024, mb: int = 16) -> None:
    """Bound the Arrow batches that Python workers get, as texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{mb}m")
