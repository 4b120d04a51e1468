"""OHLCV bars as mergeable partial aggregates, and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _money(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def partials(ticks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Partial bars: open and close carry their place in the total order ``order``.

    ``ticks`` has ``price``, ``volume`` and ``side``; an unknown side counts in the
    volume only.  Partials of any split of the ticks merge to the same bars.
    """
    at = F.struct(*order)
    p, v = _money(F.col("price")), F.col("volume")
    sided = lambda s: F.sum(F.when(F.col("side") == s, v).otherwise(F.lit(0)))
    return ticks.groupBy(*keys).agg(
        F.min(F.struct(at.alias("at"), p.alias("p"))).alias("first"), F.max(F.struct(at.alias("at"), p.alias("p"))).alias("last"),
        F.max(p).alias("h"), F.min(p).alias("l"), F.sum(v).alias("v"), F.sum((p * v).cast("decimal(38,2)")).alias("val"), sided("B").alias("v_bu"), sided("S").alias("v_sd"),
    )


def combine(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Partial bars from partial ones: one per key."""
    return parts.groupBy(*keys).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("h").alias("h"), F.min("l").alias("l"), F.sum("v").alias("v"), F.sum("val").cast("decimal(38,2)").alias("val"), F.sum("v_bu").alias("v_bu"), F.sum("v_sd").alias("v_sd"))


def merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Final bars from partial ones: ``o h l c v val v_bu v_sd`` per key."""
    return combine(parts, keys).select(*keys, F.col("first.p").alias("o"), "h", "l", F.col("last.p").alias("c"), "v", "val", "v_bu", "v_sd")


def bars(ticks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Bars in one pass: the map side makes the partials."""
    at, p, v = F.struct(*order), _money(F.col("price")), F.col("volume")
    sided = lambda s: F.sum(F.when(F.col("side") == s, v).otherwise(F.lit(0)))
    return ticks.groupBy(*keys).agg(
        F.min_by(p, at).alias("o"), F.max(p).alias("h"), F.min(p).alias("l"), F.max_by(p, at).alias("c"),
        F.sum(v).alias("v"), F.sum((p * v).cast("decimal(38,2)")).cast("decimal(38,2)").alias("val"), sided("B").alias("v_bu"), sided("S").alias("v_sd"),
    )


def index_bars(deltas: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Bars of positive index values; cumulative columns stay null where a minute has none."""
    good = deltas.where("index_value > 0")
    at = F.struct(*order)
    return good.groupBy(*keys).agg(F.min_by("index_value", at).alias("o"), F.max("index_value").alias("h"), F.min("index_value").alias("l"), F.max_by("index_value", at).alias("c"), F.max("total_vol").alias("cum_vol"), F.max("total_value").alias("cum_val"))


def coarser(bars_: DataFrame, keys: list[str], start: str, minutes: int) -> DataFrame:
    """Bars of several minutes from finer ones (an extension)."""
    slot = F.window(start, f"{minutes} minutes").start
    return bars_.groupBy(*keys, slot.alias("slot")).agg(F.min_by("o", start).alias("o"), F.max("h").alias("h"), F.min("l").alias("l"), F.max_by("c", start).alias("c"), F.sum("v").alias("v"), F.sum("val").alias("val"))


def table_counts(tables: dict[str, DataFrame], when: str, since: Column, until: Column) -> DataFrame:
    """How many rows of each table were received from ``since`` to ``until``, both included; a row per table."""
    out = None
    for name, rows in tables.items():
        one = rows.where(F.col(when).between(since, until)).agg(F.count("*").alias("n")).select(F.lit(name).alias("tab"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def verdict(bar: Column, total: Column, minor: float = 0.001) -> Column:
    """p1 if bars exceed the day's total, ok if there is no total, p2 if over ``minor`` of it is missing."""
    b, t = F.coalesce(bar, F.lit(0)), F.coalesce(total, F.lit(0))
    return F.when(b > t, "p1").when(t == 0, "ok").when((t - b) > t * minor, "p2").when(b < t, "minor").otherwise("ok")


def reconcile(bars_: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """Full outer comparison of summed bars ``v`` with cumulative ``total``; missing sides are null."""
    both = bars_.groupBy(key).agg(F.sum("v").alias("bar_v")).join(totals.groupBy(key).agg(F.max("total").alias("total_v")), key, "full_outer")
    return both.select(key, "bar_v", "total_v", verdict(F.col("bar_v"), F.col("total_v")).alias("verdict"))
