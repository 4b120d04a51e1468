"""Limits, truncation, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def limit_of(asked: int | None, default: int, most: int) -> int:
    """The limit that holds: the default if none is asked, between 1 and ``most``."""
    return default if asked is None else max(1, min(asked, most))


def recent(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows, in ascending order."""
    return rows.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def top(rows: DataFrame, value: str, ties: Sequence[str], n: int) -> DataFrame:
    """Largest values first, rows without one left out, ties in a fixed order."""
    return rows.where(F.col(value).isNotNull()).orderBy(F.col(value).desc(), *ties).limit(n)


def truncated(rows: DataFrame, n: int) -> bool:
    """Whether more than ``n`` rows exist, reading ``n + 1`` at most."""
    return rows.limit(n + 1).count() > n


def per_bucket(rows: DataFrame, bucket: str, order: Sequence[str | Column], n: int) -> DataFrame:
    """Round robin: the first ``n`` rows of every bucket (null is one), first rows of all buckets first."""
    w = Window.partitionBy(bucket).orderBy(*order)
    return rows.withColumn("turn", F.row_number().over(w).cast("long")).where(F.col("turn") <= n)


def overflow(rows: DataFrame, key: str, day: str, cap: int) -> DataFrame:
    """Earliest day per key, ``cap + 1`` at most, and the ``cut`` day if there are more than ``cap``."""
    first = rows.groupBy(key).agg(F.min(day).alias(day)).orderBy(day, key).limit(cap + 1)
    n = Window.orderBy(day, key)
    over = first.withColumn("n", F.row_number().over(n))
    return over.withColumn("cut", F.max(F.when(F.col("n") == cap + 1, F.col(day))).over(Window.partitionBy())).where(F.col("n") <= cap).drop("n")
