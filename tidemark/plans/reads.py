"""Read functions over a warehouse that the test tables stand in for, with their oracle SQL.

``customer`` holds securities and issuers, ``nation`` and ``region`` the industry tree,
``orders`` prices, statements and events, ``events`` the screener's sessions,
``lineitem`` and ``part`` asset prices, ``documents`` the versioned news.  What an
answer says besides its rows comes back as columns.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import grams
from tidemark.plans.market import query, read
from tidemark.plans.search import index_of
from tidemark.serving import METRICS, Answer, Warehouse
from tidemark.session import shared_dir
from tidemark.sources import sidecar

_PRIORITY = {"1-URGENT": "AGM", "2-HIGH": "CashDividend", "3-MEDIUM": "Earning", "4-NOT SPECIFIED": "ShareIssuance", "5-LOW": "IPO"}


def _money(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(18,4)")


def warehouse(spark: SparkSession, d: str) -> Warehouse:
    """The tables of the read functions as projections of the test tables; nothing is computed before a read."""
    c, o, n, e, docs = (read(spark, d, t) for t in ("customer", "orders", "nation", "events", "documents"))
    key, day = F.col("c_custkey"), F.to_date("o_orderdate")
    exchange = F.element_at(F.array(F.lit("HOSE"), F.lit("HNX"), F.lit("UPCOM")), (key % 3 + 1).cast("int"))
    t = {
        "security": c.select(key.alias("security_id"), key.alias("issuer_id"), F.concat(F.lit("C"), key).alias("ticker"), exchange.alias("exchange"), F.when(key % 50 == 49, "index").otherwise("stock").alias("security_type"), F.when(key % 10 == 3, "delisted").otherwise("listed").alias("status")),
        "issuer": c.select(key.alias("issuer_id"), F.col("c_name").alias("short_name")),
        "issuer_industry": c.select(key.alias("issuer_id"), F.col("c_nationkey").alias("industry_id"), F.lit("icb").alias("source")),
    }
    groups = read(spark, d, "region").select((F.col("r_regionkey") + 100).alias("industry_id"), F.lit(None).cast("int").alias("parent_id"), F.concat(F.lit("G"), "r_regionkey").alias("code"), F.col("r_name").alias("name_vi"), F.lit(1).alias("level"), F.col("r_regionkey").alias("sort_order"))
    leaves = n.select(F.col("n_nationkey").alias("industry_id"), (F.col("n_regionkey") + 100).alias("parent_id"), F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("name_vi"), F.lit(2).alias("level"), (F.col("n_nationkey") % 7).alias("sort_order"))
    t["industry"] = groups.unionByName(leaves)
    price = _money("o_totalprice")
    t["price_daily"] = o.groupBy(F.col("o_custkey").alias("security_id"), day.alias("trading_date")).agg(F.max(price).alias("close_adj"), (F.max(price) * 2).alias("close_raw"), F.min(price).alias("open_value"), F.max(price).alias("highest_value"), F.min(price).alias("lowest_value"))
    facts = o.select(F.col("o_custkey").alias("issuer_id"), F.year(day).alias("year_report"), F.explode(F.array(F.lit(5), F.quarter(day))).alias("length_report"), price.alias("p"))
    facts = facts.groupBy("issuer_id", "year_report", "length_report").agg(F.max("p").alias("isa3"), F.min("p").alias("isa9"), F.sum("p").cast("decimal(18,4)").alias("isa10"))
    t["statement"] = facts.select("issuer_id", "year_report", "length_report", F.lit("IS").alias("statement_type"), F.expr("stack(3, 'isa3', isa3, 'isa9', isa9, 'isa10', isa10) as (metric_code, value)"))
    t["metric"] = spark.sql("select * from values ('field_dictionary', 'isa3', 'VND'), ('field_dictionary', 'isa9', 'VND'), ('other', 'isa10', 'VND') as m(dictionary, code, unit)")
    sessions = e.groupBy(F.col("user_id").alias("security_id"), F.to_date("ts").alias("trading_date")).agg(F.max("value").alias("rtd11"), F.min("value").alias("rtd14"), F.count("*").alias("rtd21"))
    t["screener"] = sessions.select("security_id", "trading_date", F.parse_json(F.to_json(F.struct(F.struct("rtd11", "rtd14", "rtd21").alias("stockScreenerItem")))).alias("payload"))
    kind = F.create_map(*[F.lit(x) for kv in _PRIORITY.items() for x in kv])[F.col("o_orderpriority")]
    t["event"] = o.select(kind.alias("event_type"), F.col("o_custkey").alias("issuer_id"), F.when(F.col("o_orderkey") % 9 != 0, day).alias("public_date"))
    t["indicator"] = n.select(F.col("n_nationkey").alias("indicator_id"), F.concat(F.lit("ind"), "n_nationkey").alias("code"), F.col("n_name").alias("name_vi"), F.lit("%").alias("unit"), F.when(F.col("n_nationkey") % 2 == 0, "growth_ref").otherwise("data").alias("role"))
    t["observation"] = o.join(c, F.col("o_custkey") == key).groupBy(F.col("c_nationkey").alias("indicator_id"), F.trunc(day, "month").alias("obs_date")).agg(F.max("o_totalprice").alias("value"))
    t["break"] = n.join(spark.sql("select * from values (date '1996-03-01', 1.6005d), (date '1998-06-15', 0.5d) as b(break_day, factor)")).select(F.col("n_nationkey").alias("indicator_id"), "break_day", "factor")
    part, line = read(spark, d, "part"), read(spark, d, "lineitem")
    t["asset"] = part.select(F.col("p_partkey").alias("asset_id"), F.concat(F.lit("p"), "p_partkey").alias("code"), F.col("p_name").alias("name_vi"), F.col("p_brand").alias("unit"))
    quoted = line.select(F.col("l_partkey").alias("asset_id"), F.to_date("l_shipdate").alias("obs_date"), F.col("l_returnflag").alias("price_type"), F.col("l_extendedprice").alias("value"))
    t["asset_price"] = quoted.where("asset_id % 4 <> 3").groupBy("asset_id", "obs_date", "price_type").agg(F.max("value").alias("value"))
    t["asset_ohlc"] = quoted.where("asset_id % 4 = 3").groupBy("asset_id", "obs_date").agg(F.max("value").alias("close"))
    doc = F.col("doc_id")
    t["article"] = docs.select(doc.alias("article_id"), F.col("source").alias("primary_source"), F.when(doc % 7 != 0, F.timestamp_seconds(1_704_067_200 + doc * 3600)).alias("published_at"), F.timestamp_seconds(1_704_070_800 + doc * 3600).alias("fetched_at"), (doc % 3 + 1).cast("int").alias("group_no"), F.concat((doc % 3 + 1).cast("string"), F.lit("a")).alias("sub"))
    first = F.substring_index("text", "\n", 1)
    revised = docs.where("doc_id % 5 = 0").select(doc.alias("article_id"), F.lit(2).alias("version"), F.concat(F.lit("Again: "), first).alias("title"), F.lit("in short").alias("sapo"), F.col("text").alias("content"))
    t["revision"] = docs.select(doc.alias("article_id"), F.lit(1).alias("version"), first.alias("title"), F.lit(None).cast("string").alias("sapo"), F.col("text").alias("content")).unionByName(revised)
    t["article_ticker"] = docs.select(doc.alias("article_id"), (doc % 20).alias("security_id"), F.explode(F.array(F.lit("url"), F.lit("lookup"))).alias("via"))
    t["article_industry"] = docs.select(doc.alias("article_id"), (doc % 25).cast("int").alias("industry_id"))
    return Warehouse(t)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def searched(spark: SparkSession, d: str) -> Warehouse:
    """The warehouse with an index of its revisions' texts."""
    t = warehouse(spark, d).t
    texts = t["revision"].select(F.col("article_id").alias("id"), "version", F.concat_ws(" ", "title", "sapo", "content").alias("text"))
    return Warehouse(t, index=index_of(spark, texts, 2))


def suggesting(spark: SparkSession, d: str) -> Warehouse:
    """The warehouse with postings of listed tickers and short names."""
    t, names = warehouse(spark, d).t, grams.Grams(spark, _folder(spark, "grams"))
    listed = t["security"].where("status = 'listed'").join(t["issuer"], "issuer_id", "left")
    names.build(listed.select(F.col("security_id").alias("id"), F.expr("stack(2, 'ticker', ticker, 'name', short_name) as (field, name)")))
    return Warehouse(t, names=names)


def typed(spark: SparkSession, d: str) -> Warehouse:
    """The warehouse with the screener's metrics as columns."""
    t, path, metrics = warehouse(spark, d).t, _folder(spark, "metrics"), sorted(METRICS)
    sidecar.write(t["screener"], path, metrics, "rtd11")
    return Warehouse(t | {"screener_metrics": sidecar.read(spark, path, metrics)})


def _rows(answers: dict[str, Answer], *facts: str) -> DataFrame:
    """The rows of several answers under one name each, with some of their facts."""
    parts = [a.rows.withColumns({"asked": F.lit(k)} | {f: F.lit(a.facts[f]) for f in facts}) for k, a in answers.items() if a.rows is not None]
    return reduce(DataFrame.unionByName, parts)


_P = """WITH p AS (SELECT o_custkey AS k, o_orderdate::DATE AS trading_date, max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY ALL)"""


@query(f"""{_P}, s AS (SELECT * FROM p WHERE k IN (5, 12, 19) AND trading_date >= DATE '1996-03-01')
  SELECT 'c' || k AS asked, trading_date, CASE WHEN k = 12 THEN 2 * hi ELSE hi END AS close, lo AS open_value, hi AS highest_value, lo AS lowest_value, count(*) OVER (PARTITION BY k) AS total, count(*) OVER (PARTITION BY k) > 5 AS truncated FROM s
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY trading_date DESC) <= 5""")
def get_price_series(spark: SparkSession, d: str) -> DataFrame:
    """The newest closes of three tickers, one of them raw; nothing for an index and a delisted stock."""
    w = warehouse(spark, d)
    got = {t: w.prices(t, from_date="1996-03-01", adjusted=t != "c12", most=5) for t in ("c5", "c12", "c19", "C49", "c13")}
    return _rows(got, "total", "truncated").withColumns({c: F.col(c).cast("double") for c in ("close", "open_value", "highest_value", "lowest_value")}).withColumn("total", F.col("total").cast("long"))


@query("""WITH f AS (SELECT o_custkey AS k, year(o_orderdate) AS y, unnest([5, quarter(o_orderdate)]) AS q, o_totalprice::DECIMAL(18,4) AS p FROM orders),
  m AS (SELECT k, y, q, max(p) AS hi, min(p) AS lo FROM f GROUP BY ALL), a AS (SELECT 'year' AS asked, * FROM m WHERE k = 12 AND q = 5 AND y >= 1997 UNION ALL SELECT 'quarter', * FROM m WHERE k = 5 AND q < 5)
  SELECT asked, y::INTEGER AS year_report, q::INTEGER AS length_report, 'isa3=' || hi || ';isa9=' || lo AS metrics, count(*) OVER (PARTITION BY asked) > 6 AS truncated FROM a QUALIFY row_number() OVER (PARTITION BY asked ORDER BY y DESC, q DESC) <= 6""")
def get_financials(spark: SparkSession, d: str) -> DataFrame:
    """The newest periods of two issuers; metrics without a unit in the field dictionary are left out."""
    w = warehouse(spark, d)
    got = {"year": w.financials("C12", from_year=1997, codes=["isa3", "isa9", "isa10"], most=6), "quarter": w.financials("c5", period="quy", codes=["isa3", "isa9"], most=6)}
    text = F.array_join(F.transform("metrics", lambda m: F.concat(m["metric_code"], F.lit("="), m["value"].cast("decimal(18,4)").cast("string"))), ";")
    return _rows(got, "truncated").withColumn("metrics", text)


_SESSION = """WITH s AS (SELECT user_id AS k, ts::DATE AS day, max(value) AS rtd11, min(value) AS rtd14, count(*) AS rtd21 FROM events GROUP BY ALL),
  j AS (SELECT 'C' || k AS ticker, ['HOSE', 'HNX', 'UPCOM'][k % 3 + 1] AS exchange, n_name AS industry_name, c_nationkey AS i, rtd11, rtd14, rtd21::DOUBLE AS rtd21 FROM s JOIN customer ON c_custkey = k LEFT JOIN nation ON n_nationkey = c_nationkey WHERE k % 10 <> 3 AND day = (SELECT max(day) FROM s))"""


@query(f"""{_SESSION}, a AS (SELECT 'cheap' AS asked, *, rtd14 AS v FROM j WHERE rtd21 >= 1 AND rtd11 > 5 UNION ALL SELECT 'hnx', *, rtd11 FROM j WHERE exchange = 'HNX')
  SELECT asked, ticker, exchange, industry_name, rtd11, rtd14, rtd21, count(*) OVER (PARTITION BY asked) > 8 AS truncated FROM a QUALIFY row_number() OVER (PARTITION BY asked ORDER BY v DESC, ticker) <= 8""")
def screen_stocks(spark: SparkSession, d: str) -> DataFrame:
    """Listed securities of the latest session by metrics of a JSON payload, best first, without a cut."""
    w = typed(spark, d)
    rule = lambda m, op, v: {"metric_code": m, "operator": op, "value": v}
    got = {"cheap": w.screen([rule("rtd21", ">=", 1), rule("rtd11", ">", 5)], sort_by="rtd14", limit=8), "hnx": w.screen(exchange="HNX", limit=8)}
    shown = _rows(got, "truncated").select("asked", "ticker", "exchange", "industry_name", "rtd11", "rtd14", "rtd21", "truncated")
    return shown.withColumns({c: F.col(c).cast("double") for c in ("rtd11", "rtd14", "rtd21")})


@query(f"""{_SESSION}, m AS (SELECT min(i) AS i FROM j), a AS (SELECT 'some' AS asked, * FROM j WHERE ticker IN ('C1', 'C2', 'C4', 'C5', 'C13') UNION ALL SELECT 'industry', j.* FROM j WHERE i = 19)
  SELECT asked, ticker, industry_name, rtd11, rtd21 FROM a QUALIFY row_number() OVER (PARTITION BY asked ORDER BY ticker) <= 25""")
def compare_peers(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of named tickers (an unknown and a delisted one among them) and of an industry."""
    w = warehouse(spark, d)
    got = {"some": w.peers(["c1", "C2", "c4", "C5", "C13", "zz"], ["rtd11", "rtd21"]), "industry": w.peers(codes=["rtd11", "rtd21"], industry="N19")}
    return _rows(got).withColumns({c: F.col(c).cast("double") for c in ("rtd11", "rtd21")})


@query("""WITH e AS (SELECT o_custkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'AGM' WHEN '2-HIGH' THEN 'CashDividend' WHEN '3-MEDIUM' THEN 'Earning' WHEN '4-NOT SPECIFIED' THEN 'ShareIssuance' ELSE 'IPO' END AS event_type, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE END AS public_date FROM orders),
  a AS (SELECT 'all' AS asked, * FROM e WHERE k = 12 UNION ALL SELECT 'agm', * FROM e WHERE k = 19 AND event_type = 'AGM' AND public_date >= DATE '1995-02-01')
  SELECT asked, event_type, public_date, count(*) OVER (PARTITION BY asked) > 7 AS truncated FROM a QUALIFY row_number() OVER (PARTITION BY asked ORDER BY public_date DESC NULLS LAST, event_type) <= 7""")
def get_corporate_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of an issuer, newest first, undated ones last."""
    w = warehouse(spark, d)
    got = {"all": w.events("C12", limit=7), "agm": w.events("C19", "AGM", from_date="1995-02-01", limit=7)}
    return _rows(got, "truncated").select("asked", "event_type", "public_date", "truncated")


_LEAF = "SELECT 'N' || n_nationkey AS code, n_name AS name, 'G' || r_regionkey AS group_code, r_name AS group_name, n_nationkey % 7 AS so FROM nation JOIN region ON r_regionkey = n_regionkey"


@query(f"""WITH l AS ({_LEAF}), a AS (SELECT 'all' AS asked, * FROM l UNION ALL SELECT 'group', * FROM l WHERE group_code = 'G1')
  SELECT asked, group_code, group_name, string_agg(code || ' ' || name, ',' ORDER BY so, code) AS industries FROM a GROUP BY asked, group_code, group_name
  UNION ALL SELECT 'own', group_code, group_name, code || ' ' || l.name FROM l JOIN customer ON c_custkey = 7 AND 'N' || c_nationkey = code""")
def get_industry_tree(spark: SparkSession, d: str) -> DataFrame:
    """Groups with their industries in order, one group, and the industry of one ticker."""
    w = warehouse(spark, d)
    named = F.array_join(F.transform("industries", lambda x: F.concat_ws(" ", x["code"], x["name"])), ",")
    trees = _rows({"all": w.industries(), "group": w.industries("G1")}).select("asked", "group_code", "group_name", named.alias("industries"))
    own = _rows({"own": w.industries(ticker="C7")}).select("asked", "group_code", "group_name", F.concat_ws(" ", "code", "name_vi").alias("industries"))
    return trees.unionByName(own)


@query("""WITH p AS (SELECT c_nationkey AS k, date_trunc('month', o_orderdate)::DATE AS obs_date, max(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
  SELECT obs_date, value, round(value * (CASE WHEN obs_date < DATE '1996-03-01' THEN 1.6005 ELSE 1 END) * (CASE WHEN obs_date < DATE '1998-06-15' THEN 0.5 ELSE 1 END), 6) AS spliced, count(*) OVER () > 60 AS truncated FROM p WHERE k = 4 AND obs_date >= DATE '1995-02-01' QUALIFY row_number() OVER (ORDER BY obs_date DESC) <= 60""")
def get_macro_series(spark: SparkSession, d: str) -> DataFrame:
    """The newest points of an indicator, spliced over its breaks."""
    got = {"ind4": warehouse(spark, d).series("ind4", from_date="1995-02-01", limit=60)}
    return _rows(got, "truncated").select("obs_date", "value", F.round("spliced", 6).alias("spliced"), "truncated")


@query("""WITH q AS (SELECT l_partkey AS k, l_shipdate::DATE AS obs_date, l_returnflag AS t, max(l_extendedprice) AS value FROM lineitem GROUP BY ALL),
  n AS (SELECT k, t, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, t) AS r FROM q WHERE k % 4 <> 3 GROUP BY k, t),
  c AS (SELECT l_partkey AS k, l_shipdate::DATE AS obs_date, max(l_extendedprice) AS value FROM lineitem WHERE l_partkey % 4 = 3 GROUP BY ALL),
  a AS (SELECT q.k, q.obs_date, q.value, q.t FROM q JOIN n USING (k, t) WHERE r = 1 AND k IN (2, 9) UNION ALL SELECT k, obs_date, value, '' FROM c WHERE k = 7)
  SELECT 'p' || k AS asked, obs_date, value, t AS price_type FROM a QUALIFY row_number() OVER (PARTITION BY k ORDER BY obs_date DESC) <= 9""")
def get_asset_series(spark: SparkSession, d: str) -> DataFrame:
    """Assets by their commonest price type, never mixed, else by closes."""
    w = warehouse(spark, d)
    got = {c: w.series(c, limit=9) for c in ("p2", "p9", "p7")}
    for a in got.values():
        a.facts.setdefault("price_type", "")
    return _rows(got, "price_type").select("asked", "obs_date", "value", "price_type")


@query("""WITH a AS (SELECT 'ind' || n_nationkey AS code, n_name AS name, '%' AS unit, 'macro' AS kind FROM nation UNION ALL SELECT 'p' || p_partkey, p_name, p_brand, 'asset' FROM part)
  SELECT *, count(*) OVER () AS total, count(*) OVER () > 40 AS truncated FROM a WHERE code ILIKE '%red%' OR name ILIKE '%red%' QUALIFY row_number() OVER (ORDER BY code) <= 40""")
def series_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Indicators and assets whose code or name has a keyword, counted before the cut."""
    return _rows({"red": warehouse(spark, d).catalogue("red", most=40)}, "total", "truncated").drop("asked").withColumn("total", F.col("total").cast("long"))


_NEWS = """WITH a AS (SELECT doc_id AS article_id, ((to_timestamp(CASE WHEN doc_id % 7 <> 0 THEN 1704067200 ELSE 1704070800 END + doc_id * 3600) AT TIME ZONE 'UTC') + INTERVAL 7 HOUR)::DATE AS day, source AS primary_source, (doc_id % 3 + 1)::INTEGER AS group_no, (doc_id % 3 + 1) || 'a' AS sub,
    CASE WHEN doc_id % 5 = 0 THEN 'Again: ' ELSE '' END || split_part(text, chr(10), 1) AS title, CASE WHEN doc_id % 5 = 0 THEN 'in short' END AS sapo, list_filter(regexp_split_to_array(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS t FROM documents)"""


@query(f"""{_NEWS}, x AS (SELECT 'ticker' AS asked, * FROM a WHERE article_id % 20 = 5 UNION ALL SELECT 'industry', * FROM a WHERE article_id % 25 = 8 UNION ALL SELECT 'group', * FROM a WHERE group_no = 2 AND sub = '2a' AND day BETWEEN DATE '2024-01-02' AND DATE '2024-01-05')
  SELECT asked, article_id, day, primary_source, group_no, sub, title, sapo, count(*) OVER (PARTITION BY asked) AS total FROM x QUALIFY row_number() OVER (PARTITION BY asked ORDER BY day DESC, article_id DESC) <= 12""")
def get_news(spark: SparkSession, d: str) -> DataFrame:
    """The latest revision of articles by ticker, industry, group and day, newest first."""
    w = warehouse(spark, d)
    got = {"ticker": w.news(ticker="C5", limit=12), "industry": w.news(industry="N8", limit=12), "group": w.news(group_no=2, sub="2a", from_date="2024-01-02", to_date="2024-01-05", limit=12)}
    return _rows(got, "total").withColumn("total", F.col("total").cast("long"))


@query(f"""{_NEWS} SELECT article_id, title, count(*) OVER () AS total FROM a WHERE contains('|' || array_to_string(t, '|') || '|', '|and|the|') AND article_id % 20 = 5""")
def search_news(spark: SparkSession, d: str) -> DataFrame:
    """Articles of one ticker that have a phrase; all are asked for, as the order is by a rank of our own."""
    a = searched(spark, d).news("and the", ticker="C5", most=None)
    return _rows({"and the": a}, "total").select("article_id", "title", F.col("total").cast("long").alias("total"))


_NEAR = """WITH g AS (SELECT c_custkey AS k, list_distinct(list_transform(range(1, length('c' || c_custkey) + 2), lambda i: substr('  c' || c_custkey || ' ', i, 3))) AS g FROM customer WHERE c_custkey % 10 <> 3),
  q AS (SELECT ['  c', ' c1', 'c1x', '1x '] AS q), s AS (SELECT 'C' || k AS ticker, len(list_intersect(g, q)) / len(list_distinct(g || q)) AS sim FROM g, q)"""


@query(f"""{_NEAR} SELECT 'C1' AS ticker, true AS exact, 1::BIGINT AS place UNION ALL SELECT ticker, false, row_number() OVER (ORDER BY sim DESC, ticker) FROM s WHERE sim > 0.3 QUALIFY row_number() OVER (ORDER BY sim DESC, ticker) <= 5""")
def resolve_ticker(spark: SparkSession, d: str) -> DataFrame:
    """A known ticker, and the listed tickers most like an unknown one."""
    w = suggesting(spark, d)
    known, near = w.resolve("c1"), w.resolve("C1x")
    rows = [(known["ticker"], True, 1), *[(t, False, i) for i, t in enumerate(near.facts["suggestions"], 1)]]  # five at most
    return spark.createDataFrame(rows, "ticker string, exact boolean, place long")
