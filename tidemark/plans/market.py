"""Queries over the test tables in the roles of market data, with their oracle SQL.

``events`` stand in for ticks (user is symbol, id is sequence), ``orders`` and
``lineitem`` for dated facts, ``region`` and ``nation`` for the industry tree,
``documents`` for articles.  Sums run over decimals, so they don't depend on order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import bars, dedup, due, guards, hierarchy, merge, ordering, reshape, series, text_joins

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    side = F.when(F.col("event_type") == "purchase", "B").when(F.col("event_type") == "click", "S").otherwise("")
    volume = (F.col("event_id") % 100 + 1).cast("long")
    return read(spark, d, "events").select(F.col("user_id").alias("symbol"), "ts", F.col("event_id").alias("seq"), F.col("value").alias("price"), volume.alias("volume"), side.alias("side"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot"))


_TICKS = """WITH t AS (SELECT user_id AS symbol, ts, event_id AS seq, value::DECIMAL(18,2) AS p, event_id % 100 + 1 AS v, event_type AS e, date_trunc('hour', ts)::TIMESTAMP AS slot FROM events)"""
_BARS = """SELECT symbol, slot, arg_min(p, row(ts, seq))::DOUBLE AS o, max(p)::DOUBLE AS h, min(p)::DOUBLE AS l, arg_max(p, row(ts, seq))::DOUBLE AS c,
  sum(v)::BIGINT AS v, sum(p * v)::DOUBLE AS val, sum(CASE WHEN e = 'purchase' THEN v ELSE 0 END)::BIGINT AS v_bu, sum(CASE WHEN e = 'click' THEN v ELSE 0 END)::BIGINT AS v_sd FROM t GROUP BY symbol, slot"""


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query(f"{_TICKS} {_BARS}")
def bar_ohlcv(spark: SparkSession, d: str) -> DataFrame:
    return _doubles(bars.bars(ticks(spark, d), ["symbol", "slot"], ["ts", "seq"]), "o", "h", "l", "c", "val")


@query(f"{_TICKS} {_BARS}")
def bar_partial_final(spark: SparkSession, d: str) -> DataFrame:
    """Partial bars of interleaved batches, merged on read."""
    parts = bars.partials(ticks(spark, d).withColumn("batch", F.col("seq") % 7), ["symbol", "slot", "batch"], ["ts", "seq"])
    return _doubles(bars.merge(parts, ["symbol", "slot"]), "o", "h", "l", "c", "val")


@query(f"""{_TICKS}, b AS (SELECT symbol, sum(v)::BIGINT AS bar_v FROM t WHERE seq % 11 <> 0 AND symbol % 13 <> 1 GROUP BY symbol),
  x AS (SELECT symbol, (sum(v) + CASE WHEN symbol % 5 = 0 THEN -5000 ELSE 0 END)::BIGINT AS total_v FROM t WHERE symbol % 17 <> 2 GROUP BY symbol)
  SELECT symbol, bar_v, total_v, CASE WHEN coalesce(bar_v, 0) > coalesce(total_v, 0) THEN 'p1' WHEN coalesce(total_v, 0) = 0 THEN 'ok'
    WHEN coalesce(total_v, 0) - coalesce(bar_v, 0) > coalesce(total_v, 0) * 0.001 THEN 'p2' WHEN coalesce(bar_v, 0) < total_v THEN 'minor' ELSE 'ok' END AS verdict
  FROM b FULL OUTER JOIN x USING (symbol)""")
def bar_reconcile(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d)
    made = bars.bars(t.where("seq % 11 <> 0 and symbol % 13 <> 1"), ["symbol", "slot"], ["ts", "seq"])
    total = t.where("symbol % 17 <> 2").groupBy("symbol").agg((F.sum("volume") + F.when(F.col("symbol") % 5 == 0, -5000).otherwise(0)).alias("total"))
    return bars.reconcile(made, total, "symbol")


@query("""WITH i AS (SELECT user_id % 20 AS symbol, ts, event_id AS seq, value::DECIMAL(18,2) AS x, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS n, date_trunc('hour', ts)::TIMESTAMP AS slot FROM events WHERE value > 1)
  SELECT symbol, slot, arg_min(x, row(ts, seq))::DOUBLE AS o, max(x)::DOUBLE AS h, min(x)::DOUBLE AS l, arg_max(x, row(ts, seq))::DOUBLE AS c, max(n) AS cum_vol, max(CASE WHEN n IS NULL THEN NULL ELSE x END)::DOUBLE AS cum_val FROM i GROUP BY symbol, slot""")
def index_bar(spark: SparkSession, d: str) -> DataFrame:
    """Index bars: values of 1 or less don't count, and cumulative columns may be missing."""
    e = read(spark, d, "events")
    n = F.when(F.col("event_id") % 3 != 0, F.col("event_id"))
    x = F.col("value").cast("decimal(18,2)")
    i = e.select((F.col("user_id") % 20).alias("symbol"), "ts", F.col("event_id").alias("seq"), F.when(F.col("value") > 1, x).alias("index_value"), n.alias("total_vol"), F.when(n.isNotNull(), x).alias("total_value"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot"))
    return _doubles(bars.index_bars(i, ["symbol", "slot"], ["ts", "seq"]), "o", "h", "l", "c", "cum_val")


@query("""WITH f AS (SELECT event_id, user_id, event_type, epoch_ms(ts) AS ms FROM events)
  SELECT event_id, user_id, event_type, coalesce(ms - lag(ms) OVER (PARTITION BY user_id, event_type ORDER BY ms, event_id) < 7200000, false) AS dup FROM f""")
def frame_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Sliding dedup with a window of two hours (ten minutes hit one row of the smallest tables)."""
    f = read(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return dedup.sliding_dedup(f, ["user_id", "event_type"], "ms", ["ms", "event_id"], 7_200_000).select("event_id", "user_id", "event_type", "dup")


@query("""WITH f AS (SELECT event_id, user_id, epoch_ms(ts) // 86400000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
  SELECT event_id, user_id, ms, (n + max(ms - n) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS stamp FROM f""")
def monotonic_stamp(spark: SparkSession, d: str) -> DataFrame:
    """Strictly increasing stamps; the clock is a day, so that many arrivals tie."""
    f = read(spark, d, "events").select("event_id", "user_id", F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 86_400_000).cast("long").alias("ms"))
    return dedup.stamp(f, "user_id", "ms", ["event_id"])


@query("SELECT user_id, event_type, ts, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest(read(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"])


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders n WHERE n.o_custkey = o.o_custkey AND n.o_orderdate > o.o_orderdate)")
def latest_version_anti(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest_version(read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate"])


_BREAKS = "SELECT n_nationkey, break_day, factor FROM nation CROSS JOIN (VALUES (DATE '1996-03-01', 1.6005), (DATE '1998-06-15', 0.5), (DATE '2000-01-01', 1.25)) AS b(break_day, factor) WHERE n_nationkey % 3 <> 0 OR break_day < DATE '1998-01-01'"


@query(f"""WITH b AS ({_BREAKS}), p AS (SELECT c_nationkey AS k, o_orderdate::DATE AS day, max(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
  SELECT k, day, round(value * coalesce((SELECT exp(sum(ln(factor))) FROM b WHERE b.n_nationkey = p.k AND b.break_day > p.day), 1.0), 7) AS spliced FROM p""")
def splice_series(spark: SparkSession, d: str) -> DataFrame:
    breaks = read(spark, d, "nation").select("n_nationkey").join(spark.sql("select * from values (date '1996-03-01', 1.6005d), (date '1998-06-15', 0.5d), (date '2000-01-01', 1.25d) as b(break_day, factor)"))
    breaks = breaks.where("n_nationkey % 3 <> 0 or break_day < date '1998-01-01'").withColumnRenamed("n_nationkey", "k")
    joined = read(spark, d, "orders").join(read(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    points = joined.groupBy(F.col("c_nationkey").alias("k"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("value"))
    return series.splice(points, breaks, "k", "day", "value").select("k", "day", F.round("spliced", 7).alias("spliced"))


@query("""WITH a AS (SELECT l_shipdate::DATE AS d, l_quantity::INTEGER AS tenor, l_extendedprice::DECIMAL(38,2) AS x, l_returnflag = 'R' AS sale FROM lineitem),
  e AS (SELECT d AS flow_date, CASE WHEN sale THEN 0 ELSE x END AS i, CASE WHEN sale THEN x ELSE 0 END AS m FROM a UNION ALL SELECT d + tenor, CASE WHEN sale THEN x ELSE 0 END, CASE WHEN sale THEN 0 ELSE x END FROM a),
  g AS (SELECT flow_date::DATE AS flow_date, sum(i) AS i, sum(m) AS m FROM e GROUP BY 1)
  SELECT flow_date, i::DOUBLE AS injected, m::DOUBLE AS matured, (i - m)::DOUBLE AS net, (sum(i - m) OVER (ORDER BY flow_date))::DOUBLE AS outstanding FROM g""")
def omo_flow(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_quantity").cast("int").alias("tenor"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"), (F.col("l_returnflag") == "R").alias("sale"))
    return _doubles(series.flow(a, "day", "tenor", "amount", F.col("sale")), "injected", "matured", "net", "outstanding")


@query("""WITH c AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders), n AS (SELECT l_shipdate::DATE AS d, count(*) AS n FROM lineitem GROUP BY 1),
  h AS (SELECT d FROM n WHERE n * (SELECT count(*) FROM n) * 4 >= (SELECT sum(n) FROM n) * 3),
  q AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders)
  SELECT day, NOT EXISTS (SELECT 1 FROM c WHERE c.d BETWEEN q.day - 5 AND q.day AND c.d NOT IN (SELECT d FROM h)) AND EXISTS (SELECT 1 FROM h WHERE h.d <= q.day - 5) AS complete FROM q""")
def calendar_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Whether a day and those before it are covered; days with under three quarters of a mean day's lines are gaps."""
    o = read(spark, d, "orders")
    day = F.to_date("o_orderdate")
    lines = read(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count("*").alias("n"))
    whole = lines.agg(F.sum("n").alias("total"), F.count("*").alias("days"))  # one row
    have = lines.join(F.broadcast(whole)).where(F.col("n") * F.col("days") * 4 >= F.col("total") * 3).select("d")
    return series.covered(o.select(day.alias("day")).distinct(), "day", o.select(day.alias("d")), have, span=5)


_PATHS = "n_nationkey, concat('R', n_regionkey, '/G', n_nationkey % 7, '/N', n_nationkey)"


@query("""WITH m(map_code, map_target) AS (SELECT * FROM (VALUES ('R0', 'root-0'), ('R1', 'root-1'), ('R3', 'root-3'), ('G2', 'group-2'), ('G5', 'group-5'), ('N7', 'own-7'), ('N12', 'own-12'))),
  n AS (SELECT n_nationkey, ['R' || n_regionkey, 'G' || n_nationkey % 7, 'N' || n_nationkey] AS p FROM nation),
  x AS (SELECT n_nationkey, unnest(p) AS code, unnest(range(1, 4)) AS pos FROM n)
  SELECT n.n_nationkey, arg_max(m.map_target, x.pos) AS target, arg_max(m.map_code, x.pos) AS matched_at FROM n LEFT JOIN (x JOIN m ON x.code = m.map_code) ON n.n_nationkey = x.n_nationkey GROUP BY 1""")
def nearest_ancestor(spark: SparkSession, d: str) -> DataFrame:
    nodes = read(spark, d, "nation").select("n_nationkey", F.concat_ws("/", F.concat(F.lit("R"), "n_regionkey"), F.concat(F.lit("G"), F.col("n_nationkey") % 7), F.concat(F.lit("N"), "n_nationkey")).alias("path"), F.concat(F.lit("N"), "n_nationkey").alias("code"))
    mapping = spark.sql("select * from values ('R0', 'root-0'), ('R1', 'root-1'), ('R3', 'root-3'), ('G2', 'group-2'), ('G5', 'group-5'), ('N7', 'own-7'), ('N12', 'own-12') as m(map_code, map_target)")
    return hierarchy.nearest_ancestor(nodes, mapping, "path", "code", "n_nationkey").select("n_nationkey", "target", "matched_at")


@query("SELECT r_regionkey, r_name, coalesce(string_agg(n_name, ',' ORDER BY n_nationkey), '') AS children FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL")
def industry_tree(spark: SparkSession, d: str) -> DataFrame:
    kids = read(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    tree = hierarchy.tree(read(spark, d, "region"), kids, "r_regionkey", "r_name", "n_name", "n_nationkey")
    return tree.withColumn("children", F.array_join("children", ","))


@query("""SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 9 = 0 THEN 'M' || s_suppkey % 4 END, CASE WHEN s_suppkey % 5 <> 1 THEN n_name END) AS value,
  CASE WHEN s_suppkey % 9 = 0 THEN 'manual' WHEN s_suppkey % 5 <> 1 THEN 'derived' ELSE 'none' END AS origin FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def manual_override(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    base = s.select("s_suppkey", F.when(F.col("s_suppkey") % 5 != 1, F.col("n_name")).alias("value"))
    manual = read(spark, d, "supplier").where("s_suppkey % 9 = 0").select("s_suppkey", F.concat(F.lit("M"), F.col("s_suppkey") % 4).alias("value"))
    return hierarchy.override(base, manual, "s_suppkey")


@query("""SELECT e.event_id, c.c_name, n.n_name, (json_extract_string(e.props, '$.k'))::INTEGER AS metric FROM events e JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE (json_extract_string(e.props, '$.k'))::INTEGER > 40 AND c.c_mktsegment IN ('BUILDING', 'MACHINERY') ORDER BY metric DESC, e.event_id LIMIT 200""")
def screen_topk(spark: SparkSession, d: str) -> DataFrame:
    """Top rows by a metric inside a JSON payload, joined to the directory."""
    metric = F.expr("variant_get(parse_json(props), '$.k', 'int')")
    hit = read(spark, d, "events").select("event_id", "user_id", metric.alias("metric")).where("metric > 40")
    firms = read(spark, d, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    joined = hit.join(firms, F.col("user_id") == F.col("c_custkey")).join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return ordering.top(joined.select("event_id", "c_name", "n_name", "metric"), "metric", ["event_id"], 200)


@query("""SELECT s_suppkey, max(CASE WHEN m = 'qty' THEN x END) AS qty, max(CASE WHEN m = 'tax' THEN x END) AS tax, max(CASE WHEN m = 'disc' THEN x END) AS disc FROM
  (SELECT l_suppkey AS s_suppkey, 'qty' AS m, max(l_quantity) AS x FROM lineitem GROUP BY 1 UNION ALL SELECT l_suppkey, 'tax', max(l_tax) FROM lineitem GROUP BY 1 UNION ALL SELECT l_suppkey, 'disc', min(l_discount) FROM lineitem GROUP BY 1)
  WHERE s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) GROUP BY 1""")
def peers_compare(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of the peers of one industry side by side."""
    peers = read(spark, d, "supplier").where("s_nationkey = 3").select("s_suppkey")
    facts = read(spark, d, "lineitem").join(peers, F.col("l_suppkey") == F.col("s_suppkey"))
    return facts.groupBy("s_suppkey").agg(F.max("l_quantity").alias("qty"), F.max("l_tax").alias("tax"), F.min("l_discount").alias("disc"))


@query("""SELECT o_orderkey, o_orderdate, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01') AS n_total FROM
  (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 500)""")
def price_series_recent(spark: SparkSession, d: str) -> DataFrame:
    """The most recent rows in ascending order, with the number of all that match."""
    rows = read(spark, d, "orders").where("o_orderdate >= timestamp_ntz '1997-01-01 00:00:00'").select("o_orderkey", "o_orderdate", "o_totalprice")
    total = rows.agg(F.count("*").alias("n_total"))
    return ordering.recent(rows, ["o_orderdate", "o_orderkey"], 500).join(F.broadcast(total))  # one row


@query("""SELECT l_orderkey, l_linenumber, m AS metric, x AS value FROM (SELECT l_orderkey, l_linenumber, 'l_quantity' AS m, l_quantity AS x FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', nullif(l_tax, 0) FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem) WHERE x IS NOT NULL""")
def statements_long(spark: SparkSession, d: str) -> DataFrame:
    metrics = F.create_map(F.lit("L_Quantity"), F.col("l_quantity"), F.lit("L_Tax"), F.nullif(F.col("l_tax"), F.lit(0.0)), F.lit("l_discount"), F.col("l_discount"))
    return reshape.long(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], metrics)


@query("SELECT l_suppkey, l_returnflag, n FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1")
def price_type_mode(spark: SparkSession, d: str) -> DataFrame:
    return series.common_type(read(spark, d, "lineitem"), "l_suppkey", "l_returnflag")


@query("SELECT * FROM (SELECT 'macro' AS kind, n_nationkey::BIGINT AS code, n_name AS name FROM nation UNION ALL SELECT 'asset', p_partkey, p_name FROM part) WHERE name ILIKE '%red%' OR name ILIKE '%nation_1%'")
def catalogue_union(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "nation").select(F.lit("macro").alias("kind"), F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("name"))
    b = read(spark, d, "part").select(F.lit("asset").alias("kind"), F.col("p_partkey").alias("code"), F.col("p_name").alias("name"))
    return a.unionByName(b).where(F.col("name").ilike("%red%") | F.col("name").ilike("%nation_1%"))


@query("""WITH e AS (SELECT o_custkey, coalesce(o_orderdate::DATE, DATE '1900-01-01') AS day, o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS b FROM orders)
  SELECT o_custkey, year(day)::INTEGER AS year, o_orderkey, a, b, count(*) OVER (PARTITION BY o_custkey, year(day)) AS n_rows FROM e
  QUALIFY row_number() OVER (PARTITION BY o_custkey, year(day) ORDER BY (a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER DESC, o_orderkey DESC) = 1""")
def event_dedupe_best(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "orders").select("o_custkey", F.year(F.coalesce(F.to_date("o_orderdate"), F.lit("1900-01-01").cast("date"))).alias("year"), "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("a"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("b"))
    return dedup.keep_best(e, ["o_custkey", "year"], ["a", "b"], ["o_orderkey"])


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS raw FROM orders WHERE o_orderkey % 3 <> 0),
  n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice + 1 AS raw FROM orders WHERE o_orderkey % 4 <> 0)
  SELECT coalesce(o.k, n.k) AS k, CASE WHEN n.k IS NULL THEN o.s ELSE n.s END AS s, coalesce(o.raw, n.raw) AS raw,
    CASE WHEN o.k IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'kept' WHEN n.s IS DISTINCT FROM o.s OR coalesce(o.raw, n.raw) IS DISTINCT FROM o.raw THEN 'changed' ELSE 'same' END AS status FROM o FULL OUTER JOIN n ON o.k = n.k""")
def upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").withColumnRenamed("o_orderkey", "k")
    old = o.where("k % 3 <> 0").select("k", F.col("o_orderstatus").alias("s"), F.when(F.col("k") % 5 != 0, F.col("o_totalprice")).alias("raw"))
    new = o.where("k % 4 <> 0").select("k", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"), (F.col("o_totalprice") + 1).alias("raw"))
    return merge.upsert(old, new, ["k"], ["s"], once=["raw"])


@query("""WITH o AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 3 THEN 'delisted' ELSE 'listed' END AS status, CASE WHEN c_custkey % 6 = 0 THEN DATE '2024-01-08' END AS absent_since FROM customer WHERE c_custkey % 8 <> 0),
  s AS (SELECT DISTINCT o_custkey AS k, true AS here FROM orders WHERE o_orderkey % 5 = 0),
  j AS (SELECT coalesce(o.k, s.k) AS k, o.status, o.absent_since, coalesce(here, false) AS here FROM o FULL OUTER JOIN s ON o.k = s.k)
  SELECT k, CASE WHEN here THEN 'listed' WHEN DATE '2024-01-10' - coalesce(absent_since, DATE '2024-01-10') >= 2 THEN 'delisted' ELSE status END AS status,
    CASE WHEN NOT here THEN coalesce(absent_since, DATE '2024-01-10') END AS absent_since,
    CASE WHEN status IS NULL THEN 'new' WHEN here AND status = 'delisted' THEN 'relisted' WHEN NOT here AND DATE '2024-01-10' - coalesce(absent_since, DATE '2024-01-10') >= 2 AND status <> 'delisted' THEN 'delisted'
      WHEN NOT here AND absent_since IS NULL THEN 'absent' ELSE 'none' END AS flip FROM j""")
def directory_diff(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    old = read(spark, d, "customer").where("c_custkey % 8 <> 0").select(key.alias("k"), F.when(key % 10 == 3, "delisted").otherwise("listed").alias("status"), F.when(key % 6 == 0, F.lit("2024-01-08").cast("date")).alias("absent_since"))
    seen = read(spark, d, "orders").where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("k"))
    return merge.sync_directory(old, seen, "k", F.lit("2024-01-10").cast("date"), patience=2)


@query("""WITH p AS (SELECT c_custkey AS issuer, kind, days FROM customer CROSS JOIN (VALUES ('income', 30), ('balance', 90)) AS k(kind, days)),
  c AS (SELECT o_custkey AS issuer, CASE WHEN o_orderkey % 2 = 0 THEN 'income' ELSE 'balance' END AS kind, max(o_orderdate::DATE) AS checked FROM orders GROUP BY ALL),
  e AS (SELECT o_custkey AS issuer, unnest(CASE o_orderpriority WHEN '1-URGENT' THEN ['income', 'balance'] WHEN '2-HIGH' THEN ['income'] ELSE [] END) AS kind, o_orderdate::DATE AS seen FROM orders),
  f AS (SELECT issuer, kind, max(seen) AS seen FROM e GROUP BY ALL),
  j AS (SELECT p.issuer, p.kind, CASE WHEN coalesce(seen > coalesce(checked, DATE '1970-01-01'), false) THEN 'event' WHEN checked IS NULL THEN 'first' WHEN DATE '2001-08-02' - checked >= days THEN 'floor' END AS why
        FROM p LEFT JOIN c USING (issuer, kind) LEFT JOIN f USING (issuer, kind))
  SELECT * FROM j WHERE why IS NOT NULL""")
def due_list(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    day = F.to_date("o_orderdate")
    checks = o.select(F.col("o_custkey").alias("issuer"), F.when(F.col("o_orderkey") % 2 == 0, "income").otherwise("balance").alias("kind"), day.alias("checked"))
    events = o.select(F.col("o_custkey").alias("issuer"), F.col("o_orderpriority").alias("event_type"), day.alias("seen"))
    kinds = spark.sql("select * from values ('1-URGENT', 'income'), ('1-URGENT', 'balance'), ('2-HIGH', 'income') as k(event_type, kind)")
    issuers = read(spark, d, "customer").select(F.col("c_custkey").alias("issuer"))
    return due.due_list(issuers, checks, events, kinds, F.lit("2001-08-02").cast("date"), {"income": 30, "balance": 90})


@query("""SELECT user_id % 10 AS job, count(*) AS runs, count(*) FILTER (WHERE event_type = 'purchase') AS success, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'view') AS refused, 0::BIGINT AS running FROM events GROUP BY 1""")
def ledger_summary(spark: SparkSession, d: str) -> DataFrame:
    status = F.create_map(*[F.lit(x) for kv in (("purchase", "success"), ("error", "failed"), ("view", "refused")) for x in kv])
    runs = read(spark, d, "events").select((F.col("user_id") % 10).alias("job"), F.coalesce(status[F.col("event_type")], F.lit("other")).alias("status"))
    return due.ledger_summary(runs, ["job"])


@query("""WITH p AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS d FROM orders), g AS (SELECT k, d - lag(d) OVER (PARTITION BY k ORDER BY d) AS gap FROM p), m AS (SELECT k, median(gap)::DOUBLE AS m FROM g GROUP BY k)
  SELECT k, m AS median_gap, CASE WHEN m IS NULL THEN NULL WHEN m <= 4 THEN 'd' WHEN m <= 45 THEN 'm' WHEN m <= 120 THEN 'q' ELSE 'y' END AS freq FROM m""")
def freq_detect(spark: SparkSession, d: str) -> DataFrame:
    return series.frequency(read(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d")), "k", "d")


@query("""WITH p AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, round(max(o_totalprice) / 100000) AS v FROM orders GROUP BY ALL), w AS (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY d) AS b FROM p)
  SELECT k, d, v FROM w WHERE NOT (dayofweek(d) IN (0, 6) AND coalesce(v = b, false))""")
def weekend_carry(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d")).agg(F.round(F.max("o_totalprice") / 100000).alias("v"))
    return series.weekend_carry(p, "k", "d", "v")


@query("""WITH c AS (SELECT count(*) AS collected, count(*) + 3 AS total_count, count(*) FILTER (WHERE value > 5) AS priced, count(*) FILTER (WHERE event_type = 'error') AS unmapped, count(*) FILTER (WHERE value > 300) AS unknown, (count(*) * 1.01)::BIGINT AS base_items FROM events)
  SELECT collected, priced, unmapped, array_to_string(list_filter([CASE WHEN collected = 0 OR priced < collected * 0.2 THEN 'not_a_session' END, CASE WHEN collected <> total_count THEN 'pages' END, CASE WHEN total_count < base_items * 0.98 THEN 'drop' END,
    CASE WHEN unmapped > collected * 0.02 THEN 'unmapped' END, CASE WHEN unknown > collected * 0.02 THEN 'unknown' END], lambda x: x IS NOT NULL), ',') AS reasons, false AS ok FROM c""")
def guard_verdict(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    c = read(spark, d, "events").agg(n.alias("collected"), (n + 3).alias("total_count"), F.count_if(F.col("value") > 5).alias("priced"), F.count_if(F.col("event_type") == "error").alias("unmapped"), F.count_if(F.col("value") > 300).alias("unknown"), (n * F.lit(1.01)).cast("long").alias("base_items"))
    return guards.judge(c, guards.SCREENER).select("collected", "priced", "unmapped", F.array_join("reasons", ",").alias("reasons"), "ok")


_FOLD = "strip_accents(replace(replace(lower({}), 'đ', 'd'), 'Đ', 'd'))"


@query(f"SELECT doc_id, regexp_replace({_FOLD.format('text')}, '[^a-z0-9]', '', 'g') AS norm FROM documents")
def text_norm(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", text.norm_title(F.col("text")).alias("norm"))


@query("""SELECT doc_id, list_contains(t, 'the') AND list_contains(t, 'and') AS all_words, contains('|' || array_to_string(t, '|') || '|', '|and|the|') AS phrase FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS t FROM documents)""")
def phrase_search(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    return t.select("doc_id", text.matches_all(F.col("t"), ["the", "and"]).alias("all_words"), text.matches_phrase(F.col("t"), ["and", "the"]).alias("phrase"))


@query("""WITH l AS (SELECT DISTINCT upper(substr(n, 1, 3)) AS k FROM (SELECT unnest(['THE', 'AND', 'ING', 'TIO', 'ENT', 'HER', 'USD', 'EAN', 'SES']) AS n)),
  t AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(upper(text), '\\b[A-Z][A-Z0-9]{2}\\b'))) AS k FROM documents)
  SELECT doc_id, coalesce(string_agg(k, ',' ORDER BY k) FILTER (WHERE k IN (SELECT k FROM l) AND k <> 'USD'), '') AS tickers FROM (SELECT doc_id, k FROM t UNION ALL SELECT doc_id, NULL FROM documents) GROUP BY doc_id""")
def ticker_tag(spark: SparkSession, d: str) -> DataFrame:
    listed = F.array(*[F.lit(x) for x in ("THE", "AND", "ING", "TIO", "ENT", "HER", "USD", "EAN", "SES")])
    found = text.tickers_in(F.upper("text"), listed)
    return read(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(found), ",").alias("tickers"))


@query("""WITH a AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 4 END AS hint, lang FROM documents)
  SELECT doc_id, hint, row_number() OVER (PARTITION BY hint ORDER BY doc_id) AS turn FROM a QUALIFY row_number() OVER (PARTITION BY hint ORDER BY doc_id) <= 25""")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 4 != 0, F.col("doc_id") % 4).alias("hint"))
    return ordering.per_bucket(a, "hint", ["doc_id"], 25)


@query("SELECT d.doc_id, d.source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def tag_filter(spark: SparkSession, d: str) -> DataFrame:
    """Semi and anti joins on tags."""
    docs, labels = read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels")
    return docs.join(labels.where("quality = 1"), "doc_id", "left_semi").join(labels.where("toxic = 1"), "doc_id", "left_anti")


@query("""SELECT l_suppkey, l_linenumber, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS volume, CASE WHEN count(w) = count(*) THEN sum(w) END::BIGINT AS winners, min(l_tax) AS rate, count(DISTINCT l_tax) > 1 AS clash FROM (SELECT *, CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey % 9 END AS w FROM lineitem) GROUP BY ALL""")
def merge_same(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select("l_suppkey", "l_linenumber", F.col("l_quantity").cast("decimal(18,2)").alias("volume"), F.when(F.col("l_orderkey") % 50 != 0, F.col("l_orderkey") % 9).alias("winners"), F.col("l_tax").alias("rate"))
    return _doubles(reshape.merge_same(rows, ["l_suppkey", "l_linenumber"], ["volume"], ["winners"], "rate"), "volume")


@query("SELECT event_type, list_sort(list(value))[least(floor(count(*) * 0.95)::BIGINT + 1, count(*))] AS value FROM events GROUP BY 1")
def exact_quantile(spark: SparkSession, d: str) -> DataFrame:
    return reshape.exact_quantile(read(spark, d, "events"), ["event_type"], "value", 0.95)


@query("""SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS m, CASE WHEN month(o_orderdate) % 3 = 0 THEN date_trunc('quarter', o_orderdate)::DATE END AS q, date_trunc('year', o_orderdate)::DATE AS y FROM orders""")
def period_anchor(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return read(spark, d, "orders").select("o_orderkey", *[dates.period_anchor(day, F.lit(f)).alias(f) for f in "mqy"])


@query("SELECT 'orders' AS tab, min(o_orderdate) AS low, max(o_orderdate) AS high, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate), count(*) FROM lineitem")
def available_range(spark: SparkSession, d: str) -> DataFrame:
    one = lambda t, c: read(spark, d, t).agg(F.lit(t).alias("tab"), F.min(c).alias("low"), F.max(c).alias("high"), F.count("*").alias("n"))
    return one("orders", "o_orderdate").unionByName(one("lineitem", "l_shipdate"))


_GRAM = """list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(strip_accents(lower(title)), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""


_DAYS = """list_sort(list_distinct(list_transform(regexp_extract_all(title, '\\b[0-9]{1,2}[/-][0-9]{1,2}\\b'), lambda d: replace(d, '-', '/'))))"""


@query(f"""WITH a AS (SELECT doc_id, source, split_part(text, chr(10), 1) AS title FROM documents), g AS (SELECT doc_id, source, {_GRAM} AS t, {_DAYS} AS days FROM a WHERE length(title) >= 30),
  p AS (SELECT x.doc_id, y.doc_id AS other, round(len(list_intersect(x.t, y.t)) / (len(x.t) + len(y.t) - len(list_intersect(x.t, y.t))), 6) AS sim FROM g x JOIN g y ON x.source <> y.source AND y.doc_id < x.doc_id AND x.doc_id - y.doc_id <= 48 AND (x.days = [] OR y.days = [] OR x.days = y.days))
  SELECT doc_id, other, sim FROM p WHERE sim >= 0.6 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, other) = 1""")
def near_dup(spark: SparkSession, d: str) -> DataFrame:
    """Best earlier article of another source within 48 hours (an id is an hour) whose title is similar."""
    a = read(spark, d, "documents").select("doc_id", "source", F.substring_index("text", "\n", 1).alias("title")).where(F.length("title") >= 30)
    return text_joins.near_duplicates(a, "doc_id", "source", "doc_id", 48, 0.6)

