"""Search over an index of all documents' texts, with its oracle SQL.

Every fifth document has a second version, which is the one that counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import postings
from tidemark.plans.market import query, read
from tidemark.session import shared_dir

#: What is asked: words, and whether as a phrase.
ASKED = {"and the": True, "the licensed": False, "inf": False, "under the of": False, "creative": False, "mit der": False}
AGAIN = "again creative "


def index_of(spark: SparkSession, revisions: DataFrame, batches: int = 1) -> postings.Index:
    """A fresh index in the shared folder, filled by so many batches of versions."""
    index = postings.Index(spark, f"{shared_dir(spark)}/tidemark/index-{uuid.uuid4().hex}")
    for i in range(1, batches + 1):
        index.add(revisions.where(F.col("version") == i) if batches > 1 else revisions, name=f"batch {i}")
    return index


def texts(spark: SparkSession, d: str) -> DataFrame:
    """``id``, ``version``, ``text``: all documents, and the second versions."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    again = docs.where("id % 5 = 0").select("id", F.lit(2).alias("version"), F.concat(F.lit(AGAIN), "text").alias("text"))
    return docs.select("id", F.lit(1).alias("version"), "text").unionByName(again)


_TOKENS = f"""WITH t AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(strip_accents(CASE WHEN doc_id % 5 = 0 THEN '{AGAIN}' ELSE '' END || coalesce(text, ''))), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS t FROM documents),
  p AS (SELECT id, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS pos FROM t)"""


@query(f"""{_TOKENS} SELECT w AS token, count(DISTINCT id) AS docs, count(*) AS places, sum(pos - 1)::BIGINT AS place_sum FROM p GROUP BY w""")
def token_postings(spark: SparkSession, d: str) -> DataFrame:
    """All postings of an index that came in two increments, one of them sent twice, and was merged."""
    revisions = texts(spark, d)
    index = index_of(spark, revisions, 2)
    index.add(revisions.where("version = 2"), name="batch 2")
    index.merge()
    own = spark.read.schema(postings.POSTINGS).parquet(*[f"{index.path}/postings/{s}" for s in index.segments()])
    sums = F.aggregate("positions", F.lit(0).cast("long"), lambda s, p: s + p)
    return own.groupBy("token").agg(F.count("*").alias("docs"), F.sum(F.size("positions")).alias("places"), F.sum(sums).alias("place_sum"))


def _asked() -> str:
    rows = ", ".join(f"('{q}', {str(phrase).lower()})" for q, phrase in ASKED.items())
    return f"""{_TOKENS}, q AS (SELECT q, phrase, string_split(q, ' ') AS ws FROM (VALUES {rows}) AS v(q, phrase)),
  m AS (SELECT q, ws, id FROM t, q WHERE list_has_all(t, ws) AND (NOT phrase OR contains('|' || array_to_string(t, '|') || '|', '|' || array_to_string(ws, '|') || '|'))),
  o AS MATERIALIZED (SELECT q, id, ws, w, least(pos, 16383) AS pos FROM (SELECT m.*, p.w, p.pos, row_number() OVER (PARTITION BY q, p.id, p.w ORDER BY p.pos) AS n FROM m JOIN p ON p.id = m.id AND list_contains(m.ws, p.w)) WHERE n <= 255),
  one AS (SELECT q, id, sum(0.1 / (n * n)) / 1.64493406685 AS score FROM (SELECT q, id, row_number() OVER (PARTITION BY q, id) AS n FROM o WHERE len(ws) = 1) GROUP BY q, id),
  two AS (SELECT q, id, 1 - exp(coalesce(sum(ln(1 - 0.1 * sqrt(CASE WHEN far <= 100 THEN 1 / (1.005 + 0.05 * exp(far / 1.5 - 2)) ELSE 1e-30 END))), 0)) AS score
    FROM (SELECT a.q, a.id, abs(a.pos - b.pos) AS far FROM o a JOIN o b ON a.q = b.q AND a.id = b.id AND a.w < b.w WHERE a.pos <> b.pos) GROUP BY q, id),
  s AS (SELECT q AS asked, id AS doc_id, round(coalesce(one.score, two.score, 0), 6) AS score FROM m LEFT JOIN one USING (q, id) LEFT JOIN two USING (q, id))"""


@query(f"""{_asked()} SELECT * FROM s""")
def search_ranked(spark: SparkSession, d: str) -> DataFrame:
    """Every document that matches each of the questions, with its rank."""
    index, out = index_of(spark, texts(spark, d), 2), None
    for q, phrase in ASKED.items():
        one = index.search(q.split(), phrase).scored().select(F.lit(q).alias("asked"), F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""{_asked()} SELECT asked, rank, score FROM (SELECT asked, score, row_number() OVER (PARTITION BY asked ORDER BY score DESC) AS rank FROM s) WHERE rank <= 10""")
def search_top(spark: SparkSession, d: str) -> DataFrame:
    """The ten best scores of each question, found by bounds."""
    index, out = index_of(spark, texts(spark, d)), None
    for q, phrase in ASKED.items():
        one = index.search(q.split(), phrase).top(10).select(F.lit(q).alias("asked"), F.round("score", 6).alias("score"))
        out = one if out is None else out.unionByName(one)
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("asked").orderBy(F.col("score").desc()))
    return out.select("asked", place.cast("long").alias("rank"), "score")
