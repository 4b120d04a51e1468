"""Queries for write semantics, guards over joins, and reshaping, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import dedup, due, guards, merge, ordering, reshape
from tidemark.plans.market import query, read


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0")
def insert_absent(spark: SparkSession, d: str) -> DataFrame:
    o, key = read(spark, d, "orders"), ["o_custkey", "o_orderstatus"]
    return merge.insert_absent(o.where("o_orderkey % 3 <> 0").select(*key), o.where("o_orderkey % 3 = 0").select(*key), key)


@query("""WITH o AS (SELECT o_custkey AS g, o_orderkey AS k, CASE WHEN o_custkey % 4 = 0 THEN 'old' ELSE 'h' || o_custkey END AS h FROM orders WHERE o_orderkey % 2 = 0),
  n AS (SELECT o_custkey AS g, o_orderkey AS k, 'h' || o_custkey AS h FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 5 <> 0),
  c AS (SELECT DISTINCT n.g FROM n LEFT JOIN (SELECT DISTINCT g, h FROM o) AS p ON n.g = p.g WHERE p.h IS DISTINCT FROM n.h)
  SELECT * FROM o WHERE g NOT IN (SELECT g FROM c) UNION ALL SELECT * FROM n WHERE g IN (SELECT g FROM c)""")
def replace_groups(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("k"))
    h = F.concat(F.lit("h"), "g")
    old = o.where("k % 2 = 0").withColumn("h", F.when(F.col("g") % 4 == 0, "old").otherwise(h))
    return merge.replace_groups(old, o.where("k % 3 = 0 and g % 5 <> 0").withColumn("h", h), ["g"], "h")


@query("""SELECT p_partkey, p_brand, source FROM (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'b' END AS source FROM part) WHERE source <> 'a' AND p_partkey % 6 <> 1
  UNION ALL SELECT p_partkey, upper(p_brand), 'a' FROM part WHERE p_partkey % 6 IN (1, 3)""")
def sync_registry(spark: SparkSession, d: str) -> DataFrame:
    """A source's list is applied: its missing rows go, others' stay, a listed key changes hands."""
    p = read(spark, d, "part").select("p_partkey", "p_brand")
    old = p.withColumn("source", F.when(F.col("p_partkey") % 3 == 0, "a").otherwise("b"))
    return merge.sync_registry(old, p.where("p_partkey % 6 in (1, 3)").withColumn("p_brand", F.upper("p_brand")), ["p_partkey"], "a")


@query("""WITH r AS (SELECT o_custkey AS id, o_orderpriority AS content, o_orderkey AS version FROM orders WHERE o_orderkey % 5 <> 0),
  l AS (SELECT id, max(version) AS v, arg_max(content, version) AS c FROM r GROUP BY id), i AS (SELECT o_custkey AS id, max(o_orderpriority) AS content FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1)
  SELECT i.id, i.content, coalesce(v, 0) + 1 AS version FROM i LEFT JOIN l USING (id) WHERE i.content IS DISTINCT FROM l.c""")
def new_revisions(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("content"), F.col("o_orderkey").alias("version"))
    old = o.where("version % 5 <> 0").withColumn("digest", F.sha2("content", 256))
    incoming = o.where("version % 5 = 0").groupBy("id").agg(F.max("content").alias("content"))
    return merge.new_revisions(old, incoming, "id").drop("digest")


@query("""SELECT c AS org_code, CASE WHEN max(r) = 2 THEN max(n) WHEN max(r) = 1 THEN max(t) ELSE c END AS name FROM
  (SELECT 'o' || o_custkey AS c, CASE WHEN o_orderkey % 4 = 0 THEN 'N' || o_custkey END AS n, CASE WHEN o_orderkey % 3 = 0 THEN 'T' || o_custkey END AS t, CASE WHEN o_orderkey % 4 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS r FROM orders WHERE o_custkey % 2 = 1) GROUP BY c""")
def minimal_issuers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    e = read(spark, d, "orders").select(F.concat(F.lit("o"), "o_custkey").alias("org_code"), F.when(k % 4 == 0, F.concat(F.lit("N"), "o_custkey")).alias("org_name"), F.when(k % 3 == 0, F.concat(F.lit("T"), "o_custkey")).alias("ticker"))
    known = read(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("o"), "c_custkey").alias("org_code"))
    return merge.minimal_issuers(known, e)


@query("SELECT DISTINCT doc_id, tag FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'latin' WHEN 'de' THEN 'germanic' END AS tag FROM documents) WHERE tag IS NOT NULL AND NOT (tag = 'latin' AND doc_id % 5 = 0)")
def derived_tags(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    mapping = spark.sql("select * from values ('en', 'latin'), ('de', 'germanic') as m(lang, tag)")
    have = docs.where("doc_id % 5 = 0").select("doc_id", F.lit("latin").alias("tag"))
    return merge.derived_tags(have, docs.select("doc_id", "lang"), mapping, "doc_id", "lang")


@query("""WITH b AS (SELECT l_orderkey AS k, l_returnflag AS block, 'c' || l_linenumber % 3 AS code, max(l_quantity)::INTEGER::VARCHAR AS value FROM lineitem GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY k, code ORDER BY CASE block WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS n, count(DISTINCT value) OVER (PARTITION BY k, code) - 1 AS conflicts FROM b)
  SELECT k, code, block, value, conflicts::INTEGER AS conflicts FROM r WHERE n = 1""")
def block_priority(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("block"), F.concat(F.lit("c"), F.col("l_linenumber") % 3).alias("code")).agg(F.max("l_quantity").cast("int").cast("string").alias("value"))
    return reshape.first_block(rows, ["k"], ["R", "N", "A"])


@query("""WITH f AS (SELECT o_custkey AS k, year(o_orderdate)::INTEGER AS y, quarter(o_orderdate)::INTEGER AS q, o_orderpriority AS metric, max(o_totalprice) AS value FROM orders GROUP BY ALL),
  p AS (SELECT k, y, q, string_agg(metric || '=' || value::DECIMAL(18,2), ';' ORDER BY metric) AS metrics FROM f GROUP BY ALL)
  SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY k ORDER BY y DESC, q DESC) <= 3""")
def period_nesting(spark: SparkSession, d: str) -> DataFrame:
    f = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.col("o_orderpriority").alias("metric")).agg(F.max("o_totalprice").cast("decimal(18,2)").cast("string").alias("value"))
    p = reshape.periods(f, ["k"], ["y", "q"], 3)
    return p.withColumn("metrics", F.array_join(F.transform("metrics", lambda m: F.concat_ws("=", m["metric"], m["value"])), ";"))


@query("""WITH s AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, max(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END) AS close_raw FROM orders GROUP BY ALL), f AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, max(o_totalprice) AS r FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL),
  l AS (SELECT k, min(d) AS low FROM f GROUP BY k)
  SELECT s.k, s.d, s.close_raw, f.r AS fetched_raw FROM s JOIN l ON s.k = l.k AND s.d >= l.low JOIN f ON f.k = s.k AND f.d = s.d WHERE s.close_raw IS DISTINCT FROM f.r""")
def raw_audit(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").withColumns({"k": F.col("o_custkey"), "d": F.to_date("o_orderdate")})
    stored = o.groupBy("k", "d").agg(F.max(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))).alias("close_raw"))
    return guards.raw_mismatch(stored, o.where("o_orderkey % 2 = 0").groupBy("k", "d").agg(F.max("o_totalprice").alias("close_raw")), "k", "d")


@query("""SELECT s_suppkey AS issuer_id, t AS com_type, i AS industry, m AS implied FROM (SELECT *, CASE i WHEN 1 THEN 'NH' WHEN 2 THEN 'CK' WHEN 3 THEN 'BH' END AS m FROM
  (SELECT s_suppkey, s_nationkey % 5 AS i, CASE s_suppkey % 4 WHEN 0 THEN 'NH' WHEN 1 THEN 'CK' WHEN 2 THEN 'XX' END AS t FROM supplier)) WHERE (CASE WHEN t IN ('NH', 'CK', 'BH') THEN t END) IS DISTINCT FROM m""")
def sector_mismatch(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey") % 4
    issuers = read(spark, d, "supplier").select(F.col("s_suppkey").alias("issuer_id"), F.when(k == 0, "NH").when(k == 1, "CK").when(k == 2, "XX").alias("com_type"), (F.col("s_nationkey") % 5).alias("industry"))
    return guards.sector_mismatch(issuers, spark.sql("select * from values (1, 'NH'), (2, 'CK'), (3, 'BH') as i(industry, com_type)"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^http:', 'https:'), '[?]utm_[a-z]*=[^&#]*', ''), '/?(\?[^#]*)?(#.*)?$', '\1') AS canonical FROM pages")
def url_canonical(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", text.canonical_url(F.col("url")).alias("canonical"))


@query("SELECT user_id, event_type, event_id, n_dups FROM (SELECT user_id, event_type, event_id, count(*) OVER (PARTITION BY user_id, event_type) - 1 AS n_dups, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) AS n FROM events) WHERE n = 1")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(read(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["value", "event_id"]).drop("value")


@query("SELECT DISTINCT o_custkey AS issuer FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate::DATE BETWEEN DATE '2001-07-29' AND DATE '2001-08-01'")
def recrawl(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "orders").select(F.col("o_custkey").alias("issuer"), F.col("o_orderpriority").alias("event_type"), F.to_date("o_orderdate").alias("ex_date"))
    return due.recrawl(e, F.lit("2001-08-01").cast("date"), ["1-URGENT", "2-HIGH"])


@query("""WITH f AS (SELECT o_custkey AS k, min(o_orderdate::DATE) AS d FROM orders GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY d, k) AS n FROM f)
  SELECT k, d, (SELECT d FROM n WHERE n = 101) AS cut FROM n WHERE n <= 100""")
def overflow_cut(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d"))
    return ordering.overflow(o, "k", "d", 100)


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE d IS NULL) AS failed, 0::BIGINT AS shape, count(*) FILTER (WHERE v NOT BETWEEN 1000 AND 300000) AS band, count(*) FILTER (WHERE v BETWEEN 1000 AND 300000 AND DATE '2001-08-02' - d > 200) AS stale
  FROM (SELECT c_custkey, max(o_orderdate::DATE) AS d, arg_max(o_totalprice, row(o_orderdate, o_orderkey)) AS v FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)""")
def series_tally(spark: SparkSession, d: str) -> DataFrame:
    o = dedup.latest(read(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey", "o_totalprice"), ["k"], ["o_orderdate", "o_orderkey"]).withColumn("d", F.to_date("o_orderdate"))
    limits = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit(1000.0).alias("low"), F.lit(300000.0).alias("high"), F.lit(200).alias("max_age"))
    return guards.series_tally(o, "k", "d", "o_totalprice", limits, F.lit("2001-08-02").cast("date"))


@query("""WITH g AS (SELECT l_suppkey AS k, sum(l_quantity::DECIMAL(18,2)) AS s FROM lineitem GROUP BY 1), t AS (SELECT k, CASE WHEN k % 10 = 0 THEN s + 1 ELSE s END AS t FROM g WHERE k % 11 <> 0) SELECT k, s::DOUBLE AS summed, t::DOUBLE AS total FROM g LEFT JOIN t USING (k) WHERE s IS DISTINCT FROM t""")
def subtotal_check(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").cast("decimal(18,2)").alias("x"))
    total = rows.groupBy("k").agg(F.sum("x").alias("s")).where("k % 11 <> 0").select("k", F.when(F.col("k") % 10 == 0, F.col("s") + 1).otherwise(F.col("s")).alias("total"))
    out = reshape.unbalanced(rows, total, ["k"], "x")
    return out.select("k", F.col("summed").cast("double").alias("summed"), F.col("total").cast("double").alias("total"))
