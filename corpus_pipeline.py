"""Corpus pipeline: quality rules, near-dedup, surrogates, mixing, tokens.

Every stage takes ``documents``-shaped rows and, but for the last, returns such
rows.  Texts stay where they are wherever a decision follows from a table with a row
per source: quality rules are judged, and copies are counted, in place.  Near-dedup
decides row by row, so there texts and decisions meet in one shuffle, at every size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, pieces, quality, simhash, surrogates
from tidemark.llm.common import cut, row_key, table
from tidemark.llm.queries import MODEL

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep; repeated rows share their fate.

    Texts are written next to their statistics once and judged there."""
    rows = docs.select("doc_id", "text", "lang", "source", F.struct(*COLUMNS).alias("row"))
    return quality.judge(rows, keep=("row",)).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of texts whose five-word shingles
    have a similarity of 0.8 or more.

    Null ids count as larger than all others and as ids of their own (62 bits of a
    hash of the row; rows that share one share their fate, and so do rows that repeat
    an id with another text).  Of rows that repeat id and text one stays."""
    hashed = F.xxhash64(row_key(F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars")))
    stands = F.coalesce("doc_id", hashed.bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62))
    rows = docs.select(*COLUMNS, stands.alias("own"))
    grouped = cut(simhash.similar(rows, id_col="own"), "stage-groups")
    kept = grouped.where("doc_id = component_id").select(F.col("doc_id").alias("own")).distinct()
    left = rows.join(kept.hint("shuffle_hash"), "own", "left_semi")
    if not grouped.groupBy("doc_id").count().where("count > 1").isEmpty():
        left = left.withColumn("tk", row_key(F.col("text"))).dropDuplicates(["own", "tk"])
    return left.select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates and ``n_chars`` counted anew."""
    done = surrogates.replace(docs.select(*COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: its words of a document over the
    document's words, rounded, so only the last document of a source is rounded at all.

    The mix takes all documents of a source ``least`` times and those up to a place in
    the source's shuffle, ``last``, once more; these are read off the operator's result,
    and texts are repeated in place.  Rows that repeat the document at ``last`` may be
    taken unequally often: what that document has beyond ``least`` is added at the end."""
    by = mixing.Mix()
    taken = mixing.mixed(docs.select(*COLUMNS), by).where("size > 0")
    taken = cut(taken.select("source", "order", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")), "stage-copies")
    per = taken.groupBy(F.col("source").alias("s")).agg(F.min("copies").alias("least"), F.max("copies").alias("most"))
    over = F.max(F.when(F.col("copies") > F.col("least"), F.col("order")))
    per = cut(taken.join(per, F.col("source").eqNullSafe(F.col("s"))).groupBy("s", "least").agg(over.alias("last")), "stage-least")
    at_last = taken.join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("order") == F.col("last")))
    more = cut(at_last.groupBy("s", "last").agg(F.sum(F.col("copies") - F.col("least")).alias("more")), "stage-last").withColumnRenamed("last", "o")
    place = mixing.order_of(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")), by)
    words = docs.select(*COLUMNS).where(F.col("text").rlike(mixing.WORD)).join(per, F.col("source").eqNullSafe(F.col("s")))
    times = F.col("least") + F.coalesce((place < F.col("last")).cast("int"), F.lit(0))
    whole = words.select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), times))).select(*COLUMNS)
    last = docs.select(*COLUMNS).where(F.col("text").rlike(mixing.WORD)).join(more, F.col("source").eqNullSafe(F.col("s")) & (place == F.col("o")))
    last = last.groupBy("s", "more").agg(F.first(F.struct(*COLUMNS)).alias("row"))
    return whole.unionByName(last.select("row.*", F.explode(F.array_repeat(F.lit(1), F.col("more").cast("int")))).select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, one row per chunk: ``doc_id``, ``at``, ``ids`` and ``exact``
    (whether they decode to the chunk)."""
    return pieces.encode(docs, pieces.Model.load(MODEL, own_kind=True), columns=("ids", "exact")).select("doc_id", "at", "ids", "exact")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("PII", private_data),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", tokens),
]

#: Near-dedup needs a transitive closure over Hamming links and the last stage a
#: Viterbi fold, which the oracle's SQL can't express at corpus size; the tests hold
#: all stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
