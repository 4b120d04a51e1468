"""URL filters by temporal list join.

Dated list entries become disjoint validity intervals per key, and every capture
is evaluated against the entries that were active when it was fetched.  A capture
is expanded into the keys that could name it (its host, every parent domain, every
path prefix as deep as the list's), which are equi-joined with the ended intervals
on kind, key and year, so the as-of condition only filters among the intervals of one
key in one year, and with the open interval of the key, of which there is one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, row_key

KINDS = ("domain", "host", "prefix")


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """``kind``, ``value``, ``action``, ``since``, ``until`` (exclusive; null: open), disjoint per key.

    ``entries`` has ``kind`` (domain, host or prefix), ``value``, ``action`` (block,
    allow or remove) and the timestamp ``since``; an entry holds until the next one
    of its key.  Of entries of one key and time, block wins over allow over remove;
    repeated entries count once; entries with a null, or an unknown kind or action,
    are ignored.
    """
    rank = F.array_position(F.array(*map(F.lit, ("remove", "allow", "block"))), F.col("action"))
    good = entries.where(F.col("kind").isin(*KINDS) & (rank > 0) & F.col("value").isNotNull() & F.col("since").isNotNull())
    one = good.groupBy("kind", "value", "since").agg(F.max(rank).alias("r"))
    until = F.lead("since").over(Window.partitionBy("kind", "value").orderBy("since"))
    named = F.when(F.col("r") == 3, "block").otherwise("allow")
    return one.select("kind", "value", named.alias("action"), "since", until.alias("until"), "r").where("r > 1").drop("r")


def keys_of(url: Column, deepest: int) -> Column:
    """Array of ``(kind, value)`` that may name a URL, prefixes of ``deepest`` path parts at most; a null or odd URL has none."""
    host, labels = host_of(url), F.split(host_of(url), r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, n), ".").alias("value")))
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(deepest))), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("value")))
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    return F.when(host != "", F.concat(own, domains, prefixes))


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """``captures`` with ``blocked``, ``rule_kind``, ``rule_value``, ``rule_since`` and ``n_active``.

    The longest active prefix decides, else the host, else the longest domain.
    Captures without a URL, a time or an active entry are not blocked and have null
    rules; repeated rows get equal verdicts; columns of those names are replaced.
    """
    names = ("blocked", "rule_kind", "rule_value", "rule_since", "n_active")
    kept = [c for c in captures.columns if c not in names]
    url, time = F.col(url_col), F.col(time_col).cast("timestamp_ntz")
    rows = captures.select(*kept, row_key(url, time).alias("__rk"))
    held = cut(intervals(entries), "url-intervals")
    deepest = held.where("kind = 'prefix'").agg(F.max(F.size(F.split("value", "/")))).first()[0] or 1
    asked = rows.select("__rk", time.alias("__at"), F.explode(keys_of(url, deepest)).alias("__k")).where("__at is not null").select("__rk", "__at", "__k.*", F.year("__at").alias("y"))
    last = F.year(F.col("until") - F.expr("interval 1 microsecond"))
    ended = held.where("until is not null").select("*", F.explode(F.sequence(F.year("since"), last)).alias("y"))
    found = ("__rk", "kind", "value", "action", "since")
    hit = asked.join(ended, ["kind", "value", "y"]).where("since <= __at and __at < until").select(*found)
    hit = hit.unionByName(asked.join(held.where("until is null"), ["kind", "value"]).where("since <= __at").select(*found))
    weight = F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("k"), F.length("value").alias("n"), F.col("action"), F.col("value"), F.col("kind"), F.col("since"))
    best = hit.distinct().groupBy("__rk").agg(F.max(weight).alias("__b"), F.count("*").alias("n_active"))
    best = cut(best.select(F.col("__rk").alias("__r"), (F.col("__b.action") == "block").alias("blocked"), F.col("__b.kind").alias("rule_kind"), F.col("__b.value").alias("rule_value"), F.col("__b.since").alias("rule_since"), "n_active"), "url-verdicts")
    joined = rows.join(best, F.col("__rk") == F.col("__r"), "left")
    return joined.select(*kept, F.coalesce("blocked", F.lit(False)).alias("blocked"), "rule_kind", "rule_value", "rule_since", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"))
