"""What is due: event-triggered and floor checks, re-crawls, ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def due_list(issuers: DataFrame, checks: DataFrame, events: DataFrame, kinds: DataFrame, day: Column, floors: dict[str, int], cold: bool = False) -> DataFrame:
    """``issuer``, ``kind``, ``why`` (event, first or floor) that should be fetched.

    ``checks`` has the last ``checked`` day per issuer and kind; ``events`` has
    ``issuer``, ``event_type``, ``seen`` (day); ``kinds`` maps event types to kinds.
    An event is due unless a check was made on its day or later; a cold start has
    no events to go by.  Floors are days per kind.
    """
    last = checks.groupBy("issuer", "kind").agg(F.max("checked").alias("checked"))
    cadence = F.create_map(*[F.lit(x) for kv in floors.items() for x in kv])
    pairs = issuers.select("issuer").distinct().select("issuer", F.explode(F.array(*map(F.lit, floors))).alias("kind"))
    fired = events.join(kinds, "event_type").groupBy("issuer", "kind").agg(F.max("seen").alias("seen"))
    both = pairs.join(last, ["issuer", "kind"], "left").join(fired, ["issuer", "kind"], "left")
    event = F.coalesce(F.col("seen") > F.coalesce("checked", F.lit("1970-01-01").cast("date")), F.lit(False)) & (not cold)
    old = F.datediff(day, "checked") >= cadence[F.col("kind")]
    why = F.when(event, "event").when(F.col("checked").isNull(), "first").when(old, "floor")
    return both.withColumn("why", why).where("why is not null").select("issuer", "kind", "why")


def recrawl(events: DataFrame, day: Column, types: Sequence[str], back: int = 3) -> DataFrame:
    """Distinct issuers with an ex-date in the last ``back`` days of one of the types."""
    return events.where(F.col("event_type").isin(*types) & F.col("ex_date").between(F.date_sub(day, back), day)).select("issuer").distinct()


def ledger_summary(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of runs by outcome."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return runs.groupBy(*keys).agg(F.count("*").alias("runs"), n("success"), n("failed"), n("refused"), n("running"))


def watermark(old: Column, new: Column, complete: Column, failures: Column) -> Column:
    """A domain's watermark: never earlier than it was, and held unless the run is complete and clean."""
    return F.when(complete & (failures == 0), F.greatest(old, new)).otherwise(old)
