"""Queries that write tables part by part or read paged sources, with their oracle SQL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bars, merge
from tidemark.plans.market import _BARS, _TICKS, query, read, ticks
from tidemark.session import shared_dir
from tidemark.sources import market_series, paged
from tidemark.sources.partitioned import Partitioned
from tidemark.streaming import blocks


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 2 * o_totalprice ELSE o_totalprice END AS price FROM orders")
def partitioned_merge(spark: SparkSession, d: str) -> DataFrame:
    """Orders in parts by customer, after a delivery of new prices for those of one status."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    kind = ", ".join(f"{c} {t}" for c, t in o.drop("o_orderstatus").dtypes)
    table = Partitioned(spark, _folder(spark, "orders"), kind, ["o_custkey"], parts=16)
    upsert = lambda old, new: merge.upsert(old, new, ["o_orderkey", "o_custkey"], ["price"])
    table.merge(o.drop("o_orderstatus"), upsert)
    table.merge(o.where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", (F.col("price") * 2).alias("price")), upsert)
    return table.read()


@query(f"{_TICKS} {_BARS}")
def compacted_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars of all ticks, which came in a batch per day of the week, some of them compacted."""
    parts = blocks.Partials(spark, _folder(spark, "bars"), ("symbol", "slot"), fan=3)
    rows, order = ticks(spark, d), ["ts", "seq"]
    for day in range(7):
        parts.add(day, bars.partials(rows.where(F.dayofweek("ts") == day + 1), ["symbol", "slot"], order))
    parts.compact()
    got = parts.read()
    return got.withColumns({c: F.col(c).cast("double") for c in ("o", "h", "l", "c", "val")})


#: Candles of a page.
_PAGE = 500


@query("""SELECT 'n' || c_nationkey AS code, o_orderdate::DATE AS obs_date, max(o_totalprice)::DOUBLE AS close, min(o_totalprice)::DOUBLE AS low, count(*)::DOUBLE AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def paged_candles(spark: SparkSession, d: str) -> DataFrame:
    """Daily candles of each nation from a paged source over recorded pages.

    The record is of bounded size: 25 nations with a candle per day of seven years."""
    joined = read(spark, d, "orders").join(read(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    daily = joined.groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("code"), F.to_date("o_orderdate").alias("day")).agg(F.max(price).alias("h"), F.min(price).alias("l"), F.count("*").alias("v"))
    record: dict[str, list] = {}
    for r in daily.orderBy("code", "day").select("code", (F.unix_date("day").cast("long") * 86_400_000).alias("ms"), "h", "l", "v").collect():
        record.setdefault(r.code, []).append([r.ms, str(r.l), str(r.h), str(r.l), str(r.h), str(r.v), *["0"] * 6])

    def get(url: str) -> paged.Reply:
        code, since = url.split("?since=")
        return paged.Reply(200, json.dumps([x for x in record[code] if x[0] >= int(since)][:_PAGE]))

    feed = paged.Feed(lambda code, page, after: f"{code}?since={after or 0}", lambda status, body: "ok" if status == 200 else "retry", lambda b: len(json.loads(b)), _PAGE, lambda b: json.loads(b)[-1][0] + 1)
    pages = paged.read(spark, paged.source("recorded_candles", sorted(record), get, feed, lanes=4)).where("error is null")
    got = market_series.candles(pages.select("code", "body"))
    return got.select("code", "obs_date", *[F.col(c).cast("double").alias(c) for c in ("close", "low", "volume")])
