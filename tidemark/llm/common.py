"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, shared_dir, small_batches

__all__ = ["GAP", "WORD", "cut", "row_key", "shared_dir", "small_batches", "table", "words_of"]
#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` (null or no word: an empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def row_key(*cols: Column) -> Column:
    """128 bits that only repeated rows share: an MD5 over fields with their lengths, nulls marked."""
    said = [c.cast("string") for c in cols]
    return F.unhex(F.md5(F.concat(*[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in said])))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
