"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit(0xFFFFFFFF)))).first())


def _least(pairs: DataFrame, name: str) -> DataFrame:
    """Per node ``a`` the least of itself and its neighbours ``b``.

    It is written out, so that the join on it has a shuffle on both sides that
    Spark may split where a node has very many neighbours; as it grows with the
    corpus, it is never broadcast.
    """
    return cut(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name).hint("merge")


def components(edges: DataFrame) -> DataFrame:
    """Label every node of an undirected graph with the least node reachable.

    ``edges`` has the long columns ``a`` and ``b``; loops, repeats and nulls are
    ignored.  Returns ``node``, ``root`` for the nodes of at least one edge that
    isn't a loop; no edges give no rows.  The number of rounds grows with the
    logarithm of the number of nodes, and each round ends in a written table.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both, "cc-large"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut(large, "cc-step")
        joined = large.join(_least(large, "cc-small"), "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b"))).where("a <> b")
        now = cut(small.distinct(), "cc-edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
