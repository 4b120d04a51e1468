"""Trees: nearest ancestors, nested groups, manual overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nearest_ancestor(nodes: DataFrame, mapping: DataFrame, path: str, code: str, key: str) -> DataFrame:
    """Add ``target`` and ``matched_at`` (code): the mapping of the node's own code, else of the deepest
    element of its path (``'8000/8300/8350'``) that has one; null if none.

    ``mapping`` has ``map_code`` and ``map_target``, one row per code.
    """
    steps = nodes.select(F.col(key).alias("__k"), F.posexplode(F.split(path, "/")).alias("__pos", "__code"))
    own = nodes.select(F.col(key).alias("__k"), F.lit(1 << 20).alias("__pos"), F.col(code).alias("__code"))
    hit = steps.unionByName(own).join(mapping, F.col("__code") == F.col("map_code"))
    best = hit.groupBy("__k").agg(F.max_by(F.struct("map_target", "map_code"), "__pos").alias("__b"))
    return nodes.join(best, F.col(key) == F.col("__k"), "left").select(*nodes.columns, F.col("__b.map_target").alias("target"), F.col("__b.map_code").alias("matched_at"))


def tree(groups: DataFrame, children: DataFrame, key: str, name: str, child: str, order: str) -> DataFrame:
    """One row per group with its children as an ordered array of names."""
    kids = children.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, child))), lambda x: x[child]).alias("children"))
    return groups.join(kids, key, "left").select(key, name, F.coalesce("children", F.array().cast("array<string>")).alias("children"))


def override(base: DataFrame, manual: DataFrame, key: str) -> DataFrame:
    """Value and origin of a classification: ``manual`` beats ``derived``, else ``none``.

    Both sides have ``key`` and ``value``, one row per key.
    """
    m = manual.select(F.col(key).alias("__k"), F.col("value").alias("__v"))
    both = base.join(m, F.col(key) == F.col("__k"), "left")
    origin = F.when(F.col("__v").isNotNull(), "manual").when(F.col("value").isNotNull(), "derived").otherwise("none")
    return both.select(*[c for c in base.columns if c != "value"], F.coalesce("__v", "value").alias("value"), origin.alias("origin"))
