"""Fuzzy joins of titles by trigram similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.session import cut


#: Width of a slot in spans of ``within + 1``.
SLOT = 4


def _numbers(grams: Column) -> Column:
    """Trigrams as numbers of three code points."""
    point = lambda g, i: F.ascii(F.substring(g, i, 1)).cast("long")
    return F.transform(grams, lambda g: F.shiftleft(point(g, 1), 42) + F.shiftleft(point(g, 2), 21) + point(g, 3))


def near_duplicates(articles: DataFrame, key: str, source: str, when: str, within: int, least: float) -> DataFrame:
    """Per article the most similar earlier one (by ``when``) of another source, at most ``within`` before.

    Articles meet by time slot, each with those of its own and, if its time reaches back,
    of the slot before, so sets are moved two or three times however many trigrams they have; a title's trigrams are
    numbers, made once and written.  Times, sources, sizes (which must be in proportion)
    and days are compared before sets are.  Titles that name different days don't match;
    ties go to the smaller key.
    """
    sets = articles.select(F.col(key).alias("id"), F.col(source).alias("src"), F.col(when).alias("at"), _numbers(text.trigrams(F.col("title"))).alias("t"), text.title_dates(F.col("title")).alias("days"))
    sets = cut(sets.withColumn("n", F.size("t")).where("n > 0"), "near-sets")
    width = SLOT * (within + 1)
    slot = F.floor(F.col("at") / width)
    earliest = F.floor((F.col("at") - within) / width)  # mostly the same slot
    side = lambda x, slots: sets.select(slots.alias("slot"), *[F.col(c).alias(c + x) for c in ("id", "src", "at", "n", "t", "days")])
    left, right = side("a", F.explode(F.array_distinct(F.array(slot, earliest)))), side("b", slot)
    na, nb = F.col("na"), F.col("nb")
    timely = (F.col("atb") < F.col("ata")) & (F.col("ata") - F.col("atb") <= within) & (F.col("srca") != F.col("srcb"))
    sized = F.least(na, nb) >= F.greatest(na, nb) * least - 1e-9
    days = (F.size("daysa") == 0) | (F.size("daysb") == 0) | (F.col("daysa") == F.col("daysb"))
    sim = F.round(text.similarity(F.col("ta"), F.col("tb")), 6)
    near = left.join(right, "slot").where(timely & sized & days & (sim >= least)).select(F.col("ida").alias("a"), F.col("idb").alias("b"), sim.alias("sim"))
    return near.groupBy("a").agg(F.max_by(F.struct("b", "sim"), F.struct(F.col("sim"), -F.col("b"))).alias("m")).select(F.col("a").alias(key), F.col("m.b").alias("other"), F.col("m.sim").alias("sim"))
