"""Write semantics as pure functions from old and new rows to merged rows.

Files can't be merged in place, so a merge is a full outer join whose result
replaces the table (:mod:`tidemark.sources.snapshots` swaps the pointer); ``status``
says per row what happened, and counters are one aggregation over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sides(old: DataFrame, new: DataFrame, key: Sequence[str], sentinels: dict[str, object]) -> DataFrame:
    def keys(side: str) -> list[Column]:
        return [F.coalesce(F.col(f"{side}.{k}"), F.lit(sentinels[k])) if k in sentinels else F.col(f"{side}.{k}") for k in key]

    same = [a.eqNullSafe(b) for a, b in zip(keys("o"), keys("n"), strict=True)]
    return old.withColumn("__in", F.lit(True)).alias("o").join(new.withColumn("__in", F.lit(True)).alias("n"), same, "full_outer")


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str], once: Sequence[str] = (), maps: Sequence[str] = (), sentinels: dict[str, object] | None = None) -> DataFrame:
    """Merge ``new`` into ``old`` by ``key``; returns key, all columns and ``status``.

    ``columns`` are overwritten, ``once`` keep their first non-null value, ``maps``
    (map columns) are joined with new entries winning.  ``status`` is ``inserted``,
    ``changed`` (some stored value differs, null-safely), ``same`` or ``kept`` (no new
    row).  Keys are unique on each side; ``sentinels`` stand for nulls in keys.
    """
    both = _sides(old, new, key, sentinels or {})
    had, got = F.col("o.__in").isNotNull(), F.col("n.__in").isNotNull()

    def merged(c: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in once:
            return F.coalesce(a, b)
        if c in maps:
            kept = F.map_filter(F.coalesce(a, F.create_map().cast("map<string,string>")), lambda k, _: ~F.coalesce(F.map_contains_key(b, k), F.lit(False)))
            return F.when(got & had & b.isNotNull(), F.map_concat(kept, b)).when(got & b.isNotNull(), b).otherwise(a)
        return F.when(got, b).otherwise(a)

    names = [*columns, *once, *maps]
    entries = lambda x, c: F.array_sort(F.map_entries(x)) if c in maps else x
    differs = F.lit(False)
    for c in names:
        differs = differs | ~entries(merged(c), c).eqNullSafe(entries(F.col(f"o.{c}"), c))
    status = F.when(~had, "inserted").when(~got, "kept").when(differs, "changed").otherwise("same")
    return both.select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in key], *[merged(c).alias(c) for c in names], status.alias("status"))


def counters(merged: DataFrame) -> DataFrame:
    """One row: ``inserted``, ``changed``, ``same``, ``kept`` counts."""
    return merged.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("inserted", "changed", "same", "kept")])


def changed_sample(merged: DataFrame, key: Sequence[str], most: int = 50) -> DataFrame:
    """Keys of the first inserted or changed rows, as evidence for a run's ledger."""
    return merged.where(F.col("status").isin("inserted", "changed")).select(*key, "status").orderBy(*key).limit(most)


def on_change(checks: DataFrame, fetched: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Snapshots to write, and the ledger of checks after a run.

    ``checks`` has ``issuer``, ``kind``, ``digest``, ``checked_at``, ``changed_at`` and
    ``found_by``, one row per issuer and kind; ``fetched`` has ``issuer``, ``kind``,
    ``digest``, ``found_by`` and ``payload``.  A snapshot is written if its digest is
    new; every check is noted, and ``changed_at`` moves only with the digest.  The
    first result says ``first``, ``changed`` or ``unchanged`` per fetched row.
    """
    before = checks.select("issuer", "kind", F.col("digest").alias("__d"), F.col("changed_at").alias("__c"))
    both = fetched.join(before, ["issuer", "kind"], "left")
    result = F.when(F.col("__d").isNull(), "first").when(F.col("__d") != F.col("digest"), "changed").otherwise("unchanged")
    judged = both.withColumn("result", result)
    noted = judged.select("issuer", "kind", "digest", now.alias("checked_at"), F.when(F.col("result") == "unchanged", F.col("__c")).otherwise(now).alias("changed_at"), "found_by")
    kept = checks.join(fetched.select("issuer", "kind"), ["issuer", "kind"], "left_anti").select(*noted.columns)
    return judged.select(*fetched.columns, "result"), kept.unionByName(noted)


def insert_absent(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``old`` lacks, one per key: an idempotent claim."""
    return new.dropDuplicates(list(key)).join(old.select(*key), list(key), "left_anti")


def replace_groups(old: DataFrame, new: DataFrame, group: Sequence[str], digest: str) -> DataFrame:
    """Rows after each group whose ``digest`` changed is replaced as a whole.

    Groups that ``new`` lacks stay: an empty delivery never deletes.
    """
    a = old.select(*group, F.col(digest).alias("__o")).distinct()
    b = new.select(*group, F.col(digest).alias("__n")).distinct()
    changed = b.join(a, list(group), "left").where(~F.col("__o").eqNullSafe(F.col("__n"))).select(*group)
    stay = old.join(changed, list(group), "left_anti")
    return stay.unionByName(new.join(changed, list(group), "left_semi"))


def sync_registry(old: DataFrame, listed: DataFrame, key: Sequence[str], source: str) -> DataFrame:
    """Registry rows after a source's list is applied: rows of other sources stay, this source's
    rows that the list lacks go, listed rows are added or replaced."""
    others = old.where(F.col("source") != source)
    mine = listed.withColumn("source", F.lit(source)).select(*old.columns)
    return others.join(mine.select(*key), list(key), "left_anti").unionByName(mine)


def sync_directory(old: DataFrame, seen: DataFrame, key: str, day: Column, patience: int = 3) -> DataFrame:
    """Directory after a full listing: seen rows are listed, others are marked absent once and
    delisted after ``patience`` days; ``flip`` says what changed.

    ``old`` has ``key``, ``status`` and ``absent_since``; ``seen`` has ``key``.
    """
    s = seen.select(key).distinct().withColumn("__s", F.lit(True))
    both = old.join(s, key, "full_outer")
    here = F.col("__s").isNotNull()
    since = F.when(~here, F.coalesce("absent_since", day))
    gone = ~here & (F.datediff(day, since) >= patience)
    status = F.when(here, "listed").when(gone, "delisted").otherwise(F.col("status"))
    flip = F.when(F.col("status").isNull(), "new").when(here & (F.col("status") == "delisted"), "relisted").when(gone & (F.col("status") != "delisted"), "delisted").when(~here & F.col("absent_since").isNull(), "absent").otherwise("none")
    return both.select(key, status.alias("status"), since.alias("absent_since"), flip.alias("flip"))


def new_revisions(revisions: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` (``key``, ``content``) that differ from the latest revision, with their ``version``."""
    digest = F.sha2("content", 256)
    last = revisions.groupBy(key).agg(F.max("version").alias("__v"), F.max_by("digest", "version").alias("__d"))
    both = incoming.withColumn("digest", digest).join(last, key, "left")
    fresh = both.where(~F.col("digest").eqNullSafe(F.col("__d")))
    return fresh.select(*incoming.columns, "digest", (F.coalesce("__v", F.lit(0)) + 1).alias("version"))


def landed(known: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Raw documents whose digest differs from the last one landed for their key."""
    last = known.groupBy(key).agg(F.max_by("digest", "landed_at").alias("__d"))
    both = documents.withColumn("digest", F.sha2("body", 256)).join(last, key, "left")
    return both.where(~F.col("digest").eqNullSafe(F.col("__d"))).drop("__d")


def minimal_issuers(issuers: DataFrame, events: DataFrame) -> DataFrame:
    """An issuer row per unseen ``org_code``: named by a real name, else its ticker, else its code."""
    rank = F.when(F.col("org_name").isNotNull() & (F.col("org_name") != ""), 2).when(F.col("ticker").isNotNull(), 1).otherwise(0)
    name = F.when(rank == 2, F.col("org_name")).when(rank == 1, F.col("ticker")).otherwise(F.col("org_code"))
    best = events.where("org_code is not null").groupBy("org_code").agg(F.max(F.struct(rank.alias("rank"), name.alias("name"))).alias("b"))
    return best.join(issuers.select("org_code"), "org_code", "left_anti").select("org_code", F.col("b.name").alias("name"))


def derived_tags(tags: DataFrame, pairs: DataFrame, mapping: DataFrame, key: str, via: str) -> DataFrame:
    """New ``(key, tag)`` rows that ``pairs`` imply through ``mapping`` (``via``, ``tag``)."""
    implied = pairs.join(mapping, via).select(key, "tag").distinct()
    return implied.join(tags.select(key, "tag"), [key, "tag"], "left_anti")
