"""Typed columns beside semi-structured payloads, with statistics that a scan can skip by."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KIND = "decimal(38,10)"


def metric(code: str) -> Column:
    """A metric of a screener payload; null where it is missing or no number."""
    return F.expr(f"try_variant_get(payload, '$.stockScreenerItem.{code}', '{KIND}')")


def write(screener: DataFrame, path: str, metrics: Sequence[str], sort: str) -> None:
    """``security_id`` and the ``metrics`` of each session's payloads: a folder per session, rows by
    falling ``sort``, so that its best lie together and a file's range of it is narrow."""
    rows = screener.select("security_id", "trading_date", *[metric(c).alias(c) for c in metrics])
    # a session may be large: its rows are dealt by range of the metric
    rows = rows.repartitionByRange(F.col("trading_date"), F.col(sort).desc_nulls_last()).sortWithinPartitions(F.col("trading_date"), F.col(sort).desc_nulls_last())
    rows.write.partitionBy("trading_date").parquet(path)


def read(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    columns = ", ".join(f"{c} {KIND}" for c in metrics)
    return spark.read.schema(f"security_id long, {columns}, trading_date date").parquet(path)


def literal(value: float) -> Column:
    """A number in the columns' type, so that a comparison reaches the scan; one that it can't hold stays as it is."""
    exact = Decimal(repr(value))
    if not exact.is_finite() or abs(exact) >= 10**28 or exact != round(exact, 10):
        return F.lit(value)
    return F.lit(exact).cast(KIND)
