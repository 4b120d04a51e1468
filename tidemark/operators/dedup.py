"""Deduplication, stamps and latest rows as windows over keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sliding_dedup(frames: DataFrame, key: Sequence[str], millis: str, order: Sequence[str], window_ms: int = 600_000) -> DataFrame:
    """Add ``dup``: the same content was sighted less than ``window_ms`` before.

    Every sighting, dropped or not, renews the window, so the previous row decides.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return frames.withColumn("dup", F.coalesce(F.col(millis) - F.lag(millis).over(w) < window_ms, F.lit(False)))


def stamp(frames: DataFrame, symbol: str, millis: str, order: Sequence[str]) -> DataFrame:
    """Add ``stamp``: strictly increasing per symbol, ``max(now, last + 1)`` in closed form."""
    w = Window.partitionBy(symbol).orderBy(*order)
    n = F.row_number().over(w).cast("long")
    numbered = frames.withColumn("__n", n)
    return numbered.withColumn("stamp", F.col("__n") + F.max(F.col(millis) - F.col("__n")).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__n")


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row per key in the order of ``order``, by aggregation: a hot key is combined map-side."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*key, "__r.*")


def latest_version(rows: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Rows for which no newer version of their key exists (ties are all kept)."""
    top = rows.groupBy(*key).agg(F.max(F.struct(*version)).alias("__v")).select(*[F.col(k).alias(f"__{k}") for k in key], "__v")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    return rows.join(top, [*same, F.struct(*version) == F.col("__v")], "left_semi")


def keep_best(rows: DataFrame, key: Sequence[str], filled: Sequence[str], position: Sequence[str]) -> DataFrame:
    """Per null-safe key the row with most non-null ``filled`` columns, then the latest position."""
    score = sum((F.col(c).isNotNull().cast("int") for c in filled), F.lit(0))
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(score, *position)).alias("__r"), F.count("*").alias("n_rows"))
    return best.select(*key, "__r.*", "n_rows")


def keep_first(rows: DataFrame, key: Sequence[str], position: Sequence[str]) -> DataFrame:
    """Per key the first row by position, and ``n_dups``, how many it stands for besides."""
    rest = [c for c in rows.columns if c not in key]
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*position)).alias("__r"), (F.count("*") - 1).alias("n_dups"))
    return first.select(*key, "__r.*", "n_dups")
