"""Data-quality guards: one row of counts against thresholds, judged before any write.

A guard takes a one-row DataFrame of counts (and of the last good run's baseline)
and adds ``reasons``, an array of the names of the rules that it breaks, and ``ok``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``name`` is a reason if ``broken``, an SQL condition over the counts, holds."""

    name: str
    broken: str

    def column(self) -> Column:
        return F.when(F.coalesce(F.expr(self.broken), F.lit(False)), F.lit(self.name))


def judge(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    reasons = F.filter(F.array(*[r.column() for r in rules]), lambda x: x.isNotNull())
    return counts.withColumn("reasons", reasons).withColumn("ok", F.size("reasons") == 0)


def share(name: str, part: str, whole: str, most: float, least: int = 0) -> Rule:
    """More than ``most`` of ``whole``; silent under a sample of ``least``."""
    return Rule(name, f"({whole}) >= {least} and ({whole}) > 0 and ({part}) > ({whole}) * {most}")


def drop(name: str, now: str, before: str, most: float = 0.02) -> Rule:
    return Rule(name, f"{now} < {before} * {1 - most}")


# The thresholds of every job.
REFDATA = (drop("endpoint_drop", "n_items", "base_items"), Rule("missing_indices", "missing_indices > 0"), share("delist", "planned_delist", "listed_now", 0.01))
SCREENER = (
    Rule("not_a_session", "collected = 0 or priced < collected * 0.2"),
    Rule("pages", "collected <> total_count"),
    drop("drop", "total_count", "base_items"),
    share("unmapped", "unmapped", "collected", 0.02),
    share("unknown", "unknown", "collected", 0.02),
)
EVENTS = (
    Rule("all_empty", "collected = 0"),
    Rule("pages", "bad_families > 0"),
    Rule("drop", "dropped_families > 0"),
    Rule("new_issuers", "issuers_new > 20 and not accept_new"),
    share("duplicates", "dup_conflicts", "rows_kept + dup_conflicts", 0.005),
)
PRICE = (
    Rule("no_data", "with_data = 0"),
    share("missing", "invalid + failed + empty", "codes", 0.02),
    Rule("drop", "base_with_data > 0 and with_data < base_with_data * 0.98"),
    Rule("future", "latest > today"),
    Rule("regressed", "latest < base_latest"),
)
SNAPSHOT = (share("floor_changed", "changed_floor", "floor_compared", 0.2, 20), share("failed", "failed", "attempted", 0.2, 20), share("bad_shape", "bad_shape", "attempted", 0.05, 20))
FUNDAMENTALS = (*SNAPSHOT, share("empty", "empty", "attempted", 0.05, 20))
ALL_OR_NOTHING = (Rule("series", "failed + shape + band + stale > 0"),)
RATIO = (share("failed", "failed", "total", 0.2, 20), share("shape", "shape", "total", 0.05, 20), share("band", "band", "total", 0.05, 20), share("stale", "stale", "total", 0.2, 20))
CHARTS = (share("keys_failed", "keys_failed", "keys_total", 0.2, 20), share("shape", "series_shape", "series_total", 0.05, 20), share("band", "series_band", "series_total", 0.05, 20))


def series_tally(points: DataFrame, key: str, day: str, value: str, limits: DataFrame, today: Column) -> DataFrame:
    """One row of a series guard's counts from the latest point per series.

    ``limits`` has the key, ``low``, ``high`` and ``max_age`` (days); series without points failed.
    """
    last = points.groupBy(key).agg(F.max_by(value, day).alias("v"), F.max(day).alias("d"))
    both = limits.join(last, key, "left")
    band = ~F.coalesce(F.col("v").between(F.col("low"), F.col("high")), F.lit(True))
    stale = F.coalesce(F.datediff(today, "d") > F.col("max_age"), F.lit(False))
    return both.agg(F.count("*").alias("total"), F.count_if(F.col("d").isNull()).alias("failed"), F.count_if(F.col("d").isNotNull() & F.col("v").isNull()).alias("shape"), F.count_if(band).alias("band"), F.count_if(stale & ~band).alias("stale"))


def series_state(points: DataFrame, key: str, day: str, value: str, limits: DataFrame, today: Column) -> DataFrame:
    """Per series of ``limits`` its latest day and value and ``state``: failed (no point), shape (no value), band, stale or ok."""
    last = points.groupBy(key).agg(F.max_by(value, day).alias("value"), F.max(day).alias("day"))
    outside = ~F.coalesce(F.col("value").between(F.col("low"), F.col("high")), F.lit(True))
    state = F.when(F.col("day").isNull(), "failed").when(F.col("value").isNull(), "shape").when(outside, "band").when(F.datediff(today, "day") > F.col("max_age"), "stale").otherwise("ok")
    return limits.join(last, key, "left").select(key, "day", "value", state.alias("state"))


def missing_codes(expected: DataFrame, seen: DataFrame, code: str) -> DataFrame:
    """Expected codes that a delivery lacks."""
    return expected.select(code).distinct().join(seen.select(code), code, "left_anti")


def sector_mismatch(issuers: DataFrame, industries: DataFrame) -> DataFrame:
    """Issuers whose company type (NH, CK, BH) and industry disagree, either way.

    ``issuers`` has ``issuer_id``, ``com_type`` and ``industry``; ``industries`` maps
    ``industry`` to the ``com_type`` that it implies.
    """
    implied = industries.select("industry", F.col("com_type").alias("implied"))
    both = issuers.join(implied, "industry", "left")
    own = F.when(F.col("com_type").isin("NH", "CK", "BH"), F.col("com_type"))
    return both.where(~own.eqNullSafe(F.col("implied"))).select("issuer_id", "com_type", "industry", "implied")


def raw_mismatch(stored: DataFrame, fetched: DataFrame, key: str, day: str) -> DataFrame:
    """Stored raw closes that differ from the fetched ones, from each key's first fetched day on."""
    low = fetched.groupBy(key).agg(F.min(day).alias("__low"))
    mine = stored.join(low, key).where(F.col(day) >= F.col("__low")).drop("__low")
    other = fetched.select(key, day, F.col("close_raw").alias("fetched_raw"))
    return mine.join(other, [key, day]).where(~F.col("close_raw").eqNullSafe(F.col("fetched_raw")))
