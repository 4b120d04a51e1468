"""Trigram postings kept beside a directory, for suggestions.

How many trigrams two names share, and how many each has, gives their similarity, so
the postings of the asked name's trigrams are all that a search reads; no other name is
looked at, and none is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.session import small_batches
from tidemark.sources import snapshots

PARTS = 32
#: Names whose postings are put together in one block per trigram.
BLOCK = 8192


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    some, n = [], 0
    for b in batches:
        some.append(b)
        n += b.num_rows
        if n >= BLOCK:
            yield pa.concat_batches(some)
            some, n = [], 0
    if n:
        yield pa.concat_batches(some)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of a batch of ``id``, ``field``, ``t`` (trigrams) in a row per field and trigram."""
    for b in _batched(batches):
        sizes = b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        grams, fields = b.column(2).flatten().dictionary_encode(), b.column(1).dictionary_encode()
        if not len(grams):
            continue
        row = np.repeat(np.arange(len(sizes)), sizes)
        own = fields.indices.to_numpy()[row].astype(np.int64) * len(grams.dictionary) + grams.indices.to_numpy()
        order = np.argsort(own, kind="stable")
        starts = np.flatnonzero(np.diff(own[order], prepend=-1))
        field, gram = np.divmod(own[order][starts], len(grams.dictionary))
        listed = lambda x: pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)), pa.int32()), x)  # noqa: B023, E731
        of = row[order]
        columns = [fields.dictionary.take(pa.array(field)), grams.dictionary.take(pa.array(gram)), listed(b.column(0).take(pa.array(of))), listed(pa.array(sizes[of], pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["field", "gram", "ids", "ns"])


class Grams:
    """Postings under ``path`` in blocks: ``field``, ``gram``, ``ids``, and ``ns``, how many trigrams each name has."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.parts, self.table = spark, parts, snapshots.Table(spark, path)

    def _part(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.parts)).cast("int")

    def build(self, names: DataFrame) -> int:
        """Replace the postings by those of ``id``, ``field``, ``name``; a null or blank name has none."""
        small_batches(self.spark, rows=BLOCK)
        grams = names.select(F.col("id").cast("long").alias("id"), F.col("field").cast("string").alias("field"), text.trigrams(F.coalesce("name", F.lit(""))).alias("t"))
        blocks = grams.mapInArrow(_blocks, "field string, gram string, ids array<long>, ns array<int>").withColumn("part", self._part(F.col("gram")))
        return self.table.replace(blocks.hint("rebalance", F.col("part")).sortWithinPartitions("part", "field", "gram"), by="part")

    def similar(self, asked: str, least: float) -> DataFrame:
        """``id``, ``field``, ``sim`` of names more similar to ``asked`` than ``least``."""
        own = self.spark.range(1).select(text.trigrams(F.lit(asked)).alias("t")).select(F.explode("t").alias("gram")).select("gram", self._part(F.col("gram")).alias("part")).collect()  # a word's trigrams
        if not own:
            return self.spark.createDataFrame([], "id long, field string, sim double")
        hit = self.table.read().where(F.col("part").isin([r.part for r in own]) & F.col("gram").isin([r.gram for r in own]))
        hit = hit.select("field", F.inline(F.arrays_zip("ids", "ns")).alias("id", "n"))
        shared = F.count("*")
        found = hit.groupBy("id", "field").agg((shared / (F.first("n") + len(own) - shared)).alias("sim"))
        return found.where(F.col("sim") > least)
