"""Mixing sources to target weights by a low-discrepancy schedule, natively.

Targets share all words by weight, none above a multiple of its source's size.
Each source gets as many slots as its target has blocks of equal token count.
Slots are the points of the base-2 van der Corput sequence: cut the unit interval
at the cumulative slot counts, and the point that falls on index ``j`` of source
``s`` has time ``bit_reverse(j)``, so sources interleave evenly at every prefix.
The rank of a slot in its source counts the source's indices with an earlier time;
it is found in closed form, bit by bit, without a sort.  The slot of rank ``r`` is
joined with block ``r`` of the source's shuffled, repeating stream of documents.

Documents are shuffled by a hash and laid on their source's token line by a prefix
sum in two levels (hash ranges, then rows of a range), so that no source meets in
one task.  Windows without such ranges run over one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, cut


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code-point order, null last."""

    weights: Sequence[int] = (1, 2, 3)
    most: int = 3
    block: int = 512
    seed: str = "mix-1"
    range_rows: int = 256
    chunk: int = 4096


def order_of(own: Column, text: Column, mix: Mix) -> Column:
    """A document's place in its source's shuffle; only rows that repeat id and text share one."""
    return F.md5(F.concat_ws("|", F.lit(mix.seed), F.coalesce(own.cast("string"), F.lit("")), F.md5(text.cast("binary"))).cast("binary"))


def sizes(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.col(id_col).cast("long")
    return docs.select(*keep, own.alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), order_of(own, text, mix).alias("order"))


def targets(stats: DataFrame, mix: Mix) -> DataFrame:
    """``source``, ``source_size``, ``target`` and the token count ``goal``, a row per source.

    Filling by weight until a source is full equals one level ``x``: a source gets
    ``weight * x``, or its cap if that is less; ``x`` follows from the caps in
    ascending order of cap over weight.
    """
    per = stats.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in mix.weights]), (rank % len(mix.weights) + 1).cast("int"))
    per = per.select("source", "source_size", w.cast("double").alias("w"), (F.col("source_size") * mix.most).cast("double").alias("cap"))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    all_, before = Window.partitionBy(), by.rowsBetween(Window.unboundedPreceding, -1)
    total, weight = F.sum(F.col("source_size").cast("double")).over(all_), F.sum("w").over(all_)
    x = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (weight - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    per = per.select("*", x.alias("x"), F.row_number().over(by).alias("at"))
    # caps over weights ascend: the level is that of the first source it doesn't fill
    level = F.min(F.when(F.col("w") * F.col("x") <= F.col("cap"), F.struct("at", "x"))).over(all_)["x"]
    full = F.coalesce(F.col("w") * level > F.col("cap"), F.lit(False))
    per = per.select("source", "source_size", F.when(full, F.col("cap")).otherwise(F.col("w") * level).alias("target"))
    return per.select("*", F.least(F.floor(F.col("target") + 0.5).cast("long"), F.col("source_size") * mix.most).alias("goal"))


def slots(goals: DataFrame, mix: Mix) -> DataFrame:
    """The schedule: ``source``, ``block`` (the slot's rank in its source) and ``time``."""
    n = F.ceil(F.col("goal") / mix.block).cast("long")
    by = Window.orderBy(F.col("source").asc_nulls_last())
    per = goals.select("source", n.alias("n")).where("n > 0")
    per = per.select("source", "n", F.sum("n").over(by).alias("hi"), F.sum("n").over(Window.partitionBy()).alias("k"))
    per = per.select("source", (F.col("hi") - F.col("n")).alias("lo"), "hi", F.greatest(F.ceil(F.log2(F.col("k").cast("double"))), F.lit(1)).cast("int").alias("bits"))
    parts = per.select("*", F.explode(F.expr(f"sequence(lo, hi - 1, {mix.chunk}L)")).alias("at")).repartition("source", "at")
    rows = parts.select("source", "lo", "hi", "bits", F.explode(F.expr(f"sequence(at, least(at + {mix.chunk}L, hi) - 1)")).alias("j"))
    time = F.expr("aggregate(sequence(0, bits - 1), 0L, (t, b) -> t * 2 + shiftright(j, b) % 2)")
    # j' comes before j if at some bit b of j that is 1 it has 0 there and agrees on the lower bits
    upto = lambda end: f"(({end} - j % shiftleft(1L, b) + shiftleft(2L, b) - 1) div shiftleft(2L, b))"
    rank = F.expr(f"aggregate(sequence(0, bits - 1), 0L, (t, b) -> if(shiftright(j, b) % 2 = 1, t + {upto('hi')} - {upto('lo')}, t))")
    return rows.select("source", rank.alias("block"), time.alias("time"))


def line(stats: DataFrame, mix: Mix) -> DataFrame:
    """Add ``start``, the words before a document on its source's shuffled line."""
    bits = min(24, max(0, (stats.count() // mix.range_rows).bit_length()))
    part = F.shiftright(F.conv(F.substring("order", 1, 6), 16, 10).cast("int"), 24 - bits)
    stats = stats.withColumn("__r", part)
    tie = ["order", F.col("doc_id").asc_nulls_last(), "size"]
    per = stats.groupBy("source", "__r").agg(F.sum("size").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("source").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1))
    base = cut(per.select(F.col("source").alias("__s"), F.col("__r").alias("__q"), F.coalesce(before, F.lit(0).cast("long")).alias("__b")), "mix-ranges")
    rows = stats.join(base, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__r") == F.col("__q")))
    inside = F.sum("size").over(Window.partitionBy("source", "__r").orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1))
    return rows.select(*[c for c in stats.columns if c != "__r"], (F.col("__b") + F.coalesce(inside, F.lit(0).cast("long"))).alias("start"))


def schedule(placed: DataFrame, goals: DataFrame, mix: Mix) -> DataFrame:
    """Every piece of a document that the mix takes, in ``time`` order within the whole mix.

    Returns ``source``, ``start`` (which names the document on its source's line),
    ``time``, ``offset`` (of the slot's part, on the repeating line) and ``words``.
    """
    goal = goals.select(F.col("source").alias("__s"), F.col("source_size").alias("__n"), F.col("goal").alias("__g"))
    rows = placed.where("size > 0").join(cut(goal, "mix-goals"), F.col("source").eqNullSafe(F.col("__s")))
    turns = rows.select("source", "start", "size", "__g", F.explode(F.transform(F.sequence(F.lit(0), F.lit(mix.most - 1)), lambda e: F.col("start") + e * F.col("__n"))).alias("__a"))
    turns = turns.select("source", "start", F.col("__a"), F.least(F.col("__a") + F.col("size"), F.col("__g")).alias("__e")).where("__a < __e")
    pieces = turns.select("*", F.explode(F.expr(f"sequence(__a div {mix.block}, (__e - 1) div {mix.block})")).alias("block"))
    offset = F.greatest(F.col("__a"), F.col("block") * mix.block)
    pieces = pieces.select("source", "start", "block", offset.alias("offset"), (F.least(F.col("__e"), (F.col("block") + 1) * mix.block) - offset).alias("words"))
    plan = slots(goals, mix).select(F.col("source").alias("__s"), F.col("block").alias("__b"), "time")
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__b"))
    # the schedule grows with the corpus: it is never broadcast
    return pieces.join(plan.hint("merge"), same).select("source", "start", "time", "offset", "words")


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """What the mix takes of every document, repeats counted.

    Returns ``keep``, ``doc_id``, ``source``, ``size``, ``order`` (the document's place
    in its source's shuffle), ``source_size``, ``target`` and ``taken``.  Null and empty texts have size 0 and nothing is taken of them;
    null sources are one source, the last; rows that repeat share their place in
    the shuffle and are taken one after the other; an empty table gives an empty
    one; other columns are ignored.
    """
    stats = cut(sizes(docs, mix, id_col, text_col, keep), "mix-sizes")
    goals = cut(targets(stats, mix), "mix-targets")
    placed = cut(line(stats, mix), "mix-line")
    taken = schedule(placed, goals, mix).groupBy("source", "start").agg(F.sum("words").alias("taken"))
    taken = cut(taken.select(F.col("source").alias("__s"), F.col("start").alias("__a"), "taken"), "mix-taken")
    own = goals.select(F.col("source").alias("__g"), "source_size", "target")
    rows = placed.join(taken, F.col("source").eqNullSafe(F.col("__s")) & (F.col("start") == F.col("__a")) & (F.col("size") > 0), "left")
    rows = rows.join(own, F.col("source").eqNullSafe(F.col("__g")))
    return rows.select(*keep, "doc_id", "source", "size", "order", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
