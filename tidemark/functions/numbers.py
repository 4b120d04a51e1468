"""Numbers at the gate: half-even prices, counts, scales, bands."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def price(x: Column) -> Column:
    """Text to ``decimal(18,2)``, half-even; null if it is no number."""
    return F.bround(x.try_cast("decimal(38,10)"), 2).cast("decimal(18,2)")


def was_rounded(x: Column) -> Column:
    return F.coalesce(x.try_cast("decimal(38,10)") != price(x), F.lit(False))


def count(x: Column) -> Column:
    """Text to a non-negative whole long; anything else: null."""
    d = x.try_cast("decimal(38,10)")
    return F.when((d >= 0) & (d == F.floor(d)), d.cast("long"))


def scaled(x: Column, by: int | str) -> Column:
    return x * F.lit(Decimal(str(by)))


def in_band(x: Column, low: float, high: float, floor: float | None = None) -> Column:
    """Within the band, by size if ``low`` isn't negative, and not under ``floor``."""
    ok = x.between(low, high) if low < 0 else F.abs(x).between(low, high)
    return ok if floor is None else ok & (x >= floor)
