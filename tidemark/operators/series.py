"""Time series: splices, flows, coverage, frequency, calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def splice(points: DataFrame, breaks: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Add ``spliced``: the value times the factors of all later breaks of its series.

    Breaks (``key``, ``break_day``, ``factor``) are few per series; their running
    products form intervals, so a point meets one row.
    """
    w = Window.partitionBy(key).orderBy(F.col("break_day").desc()).rowsBetween(Window.unboundedPreceding, 0)
    steps = breaks.select(key, "break_day", F.exp(F.sum(F.log("factor")).over(w)).alias("product"))
    upto = Window.partitionBy(key).orderBy("break_day")
    steps = steps.select(key, "product", F.lag("break_day").over(upto).alias("__from"), F.col("break_day").alias("__to"))
    own = steps.select(F.col(key).alias("__k"), "product", "__from", "__to")
    inside = (F.col(key) == F.col("__k")) & (F.col(day) < F.col("__to")) & (F.col("__from").isNull() | (F.col(day) >= F.col("__from")))
    both = points.join(own, inside, "left")
    return both.select(*points.columns, (F.col(value) * F.coalesce("product", F.lit(1.0))).alias("spliced"))


def flow(auctions: DataFrame, day: str, tenor: str, amount: str, side: Column | None = None) -> DataFrame:
    """Daily issue, maturity, net and outstanding of auctions.

    An auction adds its amount on its day and takes it back ``tenor`` days later;
    where ``side`` is true (a sale) both are mirrored.
    """
    side = F.lit(False) if side is None else side
    due = F.date_add(F.col(day), F.col(tenor))
    event = lambda d, add: F.struct(d.alias("flow_date"), F.lit(add).alias("adds"))
    events = auctions.select(F.col(amount).alias("amount"), side.alias("sale"), F.explode(F.array(event(F.col(day), True), event(due, False))).alias("e")).select("amount", "sale", "e.*")
    adds = F.col("adds") != F.col("sale")
    zero = F.lit(0).cast("decimal(38,2)")
    put = lambda c: F.sum(F.when(c, F.col("amount").cast("decimal(38,2)")).otherwise(zero)).cast("decimal(38,2)")
    per = events.groupBy("flow_date").agg(put(adds).alias("injected"), put(~adds).alias("matured"))
    net = per.withColumn("net", (F.col("injected") - F.col("matured")).cast("decimal(38,2)"))
    # one row per day: the running total is over a calendar, not over the auctions
    return net.withColumn("outstanding", F.sum("net").over(Window.orderBy("flow_date")).cast("decimal(38,2)"))


def covered(days: DataFrame, day: str, calendar: DataFrame, have: DataFrame, span: int = 140) -> DataFrame:
    """Add ``complete``: every calendar day of the last ``span`` days has data, and data reach back that far.

    ``calendar`` and ``have`` have ``d``; missing days are counted by a running sum.
    """
    missing = calendar.select("d").distinct().join(have.select("d").distinct(), "d", "left_anti").withColumn("m", F.lit(1))
    asked = days.select(F.col(day).alias("d")).distinct().withColumn("m", F.lit(0))
    n = F.datediff("d", F.lit("1970-01-01").cast("date"))
    gaps = asked.unionByName(missing).withColumn("g", F.sum("m").over(Window.orderBy(n).rangeBetween(-span, 0)))
    first = have.agg(F.min("d").alias("first"))
    verdict = gaps.where("m = 0").crossJoin(F.broadcast(first))  # one row
    verdict = verdict.select(F.col("d").alias("__d"), ((F.col("g") == 0) & (F.col("first") <= F.date_sub("d", span))).alias("complete"))
    return days.join(verdict, F.col(day) == F.col("__d")).drop("__d")


def _median(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``median_gap`` per key by counts of distinct values, so a long series is never one list."""
    w = Window.partitionBy(key)
    counts = rows.groupBy(key, value).agg(F.count("*").alias("c"))
    run = counts.select("*", F.sum("c").over(w.orderBy(value)).alias("run"), F.sum("c").over(w).alias("total"))
    at = lambda rank: F.min(F.when(F.col("run") >= rank, F.col(value)))
    return run.groupBy(key).agg(((at(F.floor((F.col("total") + 1) / 2)) + at(F.floor(F.col("total") / 2) + 1)) / 2.0).cast("double").alias("median_gap"))


def frequency(points: DataFrame, key: str, day: str) -> DataFrame:
    """``freq`` of a series by the median gap of its distinct days: d up to 4, m up to 45, q up to 120, else y."""
    w = Window.partitionBy(key).orderBy(day)
    gaps = points.select(key, day).distinct().withColumn("gap", F.datediff(day, F.lag(day).over(w)))
    gap = _median(gaps.where("gap is not null"), key, "gap").join(points.select(key).distinct(), key, "right")
    m = F.col("median_gap")
    return gap.select(key, "median_gap", F.when(m.isNull(), None).when(m <= 4, "d").when(m <= 45, "m").when(m <= 120, "q").otherwise("y").alias("freq"))


def weekend_carry(points: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Drop weekend points that repeat the point right before them (for series on a trading calendar)."""
    w = Window.partitionBy(key).orderBy(day)
    carried = F.dayofweek(day).isin(1, 7) & F.coalesce(F.col(value) == F.lag(value).over(w), F.lit(False))
    return points.withColumn("__c", carried).where("not __c").drop("__c")


def not_increasing(rows: DataFrame, key: str, position: str, day: str) -> DataFrame:
    """Rows whose day isn't after the one before them in source order: each is an error."""
    w = Window.partitionBy(key).orderBy(position)
    return rows.withColumn("__p", F.lag(day).over(w)).where(F.col(day) <= F.col("__p")).drop("__p")


def common_type(rows: DataFrame, key: str, kind: str) -> DataFrame:
    """Per key the kind with most rows, ties by name."""
    n = rows.groupBy(key, kind).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(kind, F.struct(-F.col("n"), F.col(kind))).alias(kind), F.max("n").alias("n"))
