"""Projections of documents and long facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import per_bucket


def long(rows: DataFrame, keys: Sequence[str], metrics: Column) -> DataFrame:
    """Wide to long: one row per non-null entry of a map column, codes in lower case."""
    return rows.select(*keys, F.explode(F.map_filter(metrics, lambda _, v: v.isNotNull())).alias("metric", "value")).withColumn("metric", F.lower("metric"))


def first_block(rows: DataFrame, keys: Sequence[str], blocks: Sequence[str]) -> DataFrame:
    """Per key and code the value of the first block (in priority order) that has it, and ``conflicts``:
    how many further blocks had another value.  ``rows`` has ``block``, ``code``, ``value``."""
    place = F.array_position(F.array(*map(F.lit, blocks)), F.col("block"))
    ranked = rows.where(place > 0).withColumn("__p", place)
    best = ranked.groupBy(*keys, "code").agg(F.min_by(F.struct("block", "value"), "__p").alias("b"), F.collect_set("value").alias("all"))
    return best.select(*keys, "code", F.col("b.block").alias("block"), F.col("b.value").alias("value"), (F.size("all") - F.when(F.col("b.value").isNull(), 0).otherwise(1)).alias("conflicts"))


def newest_period(quarterly: Column, yearly: Column) -> Column:
    """The period with the greatest (year, quarter) of the quarterly array, else of the yearly one."""
    return F.coalesce(F.array_max(quarterly), F.array_max(yearly))


def whitelist_digest(fields: Column, keep: Sequence[str]) -> Column:
    """SHA-256 of the kept entries of a map, in key order: changes elsewhere don't show."""
    kept = F.map_filter(fields, lambda k, _: k.isin(*keep))
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept)))), 256)


def delta(columns: dict[str, Column], ts_ms: Column) -> Column:
    """Map of the columns that a frame carries, as text, and ``ts`` in milliseconds."""
    entries = [x for k, v in columns.items() for x in (F.lit(k), v.cast("string"))]
    return F.map_concat(F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull()), F.create_map(F.lit("ts"), ts_ms.cast("string")))


def extra(fields: Column, known: Sequence[str]) -> Column:
    """JSON of a frame's other fields in key order; none: empty."""
    rest = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(rest))))).otherwise("")


def periods(facts: DataFrame, keys: Sequence[str], period: Sequence[str], most: int = 20) -> DataFrame:
    """Newest periods of long facts, each with its metrics in order of code."""
    per = facts.groupBy(*keys, *period).agg(F.array_sort(F.collect_list(F.struct("metric", "value"))).alias("metrics"))
    if len(keys) == 1:
        return per_bucket(per, keys[0], [F.col(p).desc() for p in period], most).drop("turn")
    raise ValueError("one key names an issuer")


def ordered_digest(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Digest of a group's rows that doesn't depend on their order."""
    row = F.to_json(F.struct(*columns))
    return rows.groupBy(*keys).agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(row))), 256).alias("digest"))


def merging(summed: Sequence[str], strict: Sequence[str], agree: str) -> list[Column]:
    """Aggregates of rows to be merged: sums, sums that are null if any part is, and ``clash`` if ``agree`` differs."""
    null_sum = lambda c: F.when(F.count(c) == F.count("*"), F.sum(c)).alias(c)
    return [*[F.sum(c).alias(c) for c in summed], *[null_sum(c) for c in strict], F.min(agree).alias(agree), F.coalesce(F.min(agree) < F.max(agree), F.lit(False)).alias("clash")]


def merge_same(rows: DataFrame, keys: Sequence[str], summed: Sequence[str], strict: Sequence[str], agree: str) -> DataFrame:
    """Rows of equal keys merged as ``merging`` says."""
    return rows.groupBy(*keys).agg(*merging(summed, strict, agree))


def unbalanced(rows: DataFrame, totals: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Groups whose rows don't add up to the published total (``total``), with both sums."""
    own = rows.groupBy(*keys).agg(F.sum(amount).alias("summed"))
    return own.join(totals, list(keys), "full_outer").where(~F.col("summed").eqNullSafe(F.col("total")))


def exact_quantile(rows: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """The element at index ``int(q * n)`` of the sorted values, by counts instead of lists."""
    w = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("__c"))
    run = counts.select("*", F.sum("__c").over(w.orderBy(value)).alias("__run"), F.sum("__c").over(w).alias("__n"))
    at = F.least(F.floor(F.col("__n") * q), F.col("__n") - 1)
    return run.where(F.col("__run") > at).groupBy(*keys).agg(F.min(value).alias(value))
