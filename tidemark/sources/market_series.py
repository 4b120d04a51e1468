"""Series documents to points and bars: charts, observations, rates, fixings, candles.

Documents are JSON text in ``body`` with the registry's columns beside it (``code``,
``freq``, ``scale`` and so on), so a job is one projection over all documents.
Points that break a document's shape are null and counted, never guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates

DEC = "decimal(38,10)"


def chart_points(docs: DataFrame) -> DataFrame:
    """Charts ``{chart: {series: [{name, data: [[epoch_ms, value]…]}]}}``: ``code``, ``obs_date``, ``value``.

    ``idx`` picks the series; days are local and anchored to the start of the period;
    of points that fall on one day the last in time stays.
    """
    chart = F.from_json("body", "chart struct<series:array<struct<unit:string,name:string,data:array<array<string>>>>>")
    data = F.get(chart["chart"]["series"], F.col("idx"))["data"]
    points = docs.select("code", "freq", "scale", F.explode(data).alias("p")).select("code", "freq", "scale", F.get("p", F.lit(0)).try_cast("long").alias("ms"), F.get("p", F.lit(1)).try_cast(DEC).alias("v"))
    day = dates.period_anchor(dates.local_date(dates.from_millis(F.col("ms"))), F.col("freq"))
    value = (F.col("v") * F.col("scale").cast("decimal(20,0)")).cast(DEC)
    kept = points.where("ms is not null and v is not null").select("code", day.alias("obs_date"), "ms", value.alias("value"))
    return kept.groupBy("code", "obs_date").agg(F.max_by("value", "ms").alias("value"), (F.count_distinct("value") > 1).alias("clash"))


def observations(docs: DataFrame) -> DataFrame:
    """``{observations: [{date, value}]}`` where ``.`` is missing."""
    obs = F.from_json("body", "observations array<struct<date:string,value:string>>")["observations"]
    rows = docs.select("code", "scale", F.explode(obs).alias("o")).where("o.value <> '.'")
    return rows.select("code", F.col("o.date").try_cast("date").alias("obs_date"), (F.col("o.value").try_cast(DEC) * F.col("scale").cast("decimal(20,0)")).cast(DEC).alias("value"))


def rates(docs: DataFrame) -> DataFrame:
    """``{rates: {day: {currency: rate}}}``: the currency in ``external_key``."""
    table = F.from_json("body", "rates map<string,map<string,string>>")["rates"]
    rows = docs.select("code", "external_key", F.explode(table).alias("day", "r"))
    return rows.where(F.col("r")[F.col("external_key")].isNotNull()).select("code", F.col("day").try_cast("date").alias("obs_date"), F.col("r")[F.col("external_key")].try_cast(DEC).alias("value"))


def fixings(docs: DataFrame) -> DataFrame:
    """``[{d, v: [USD, GBP, EUR]}]``: the currency at ``external_sub``; ``disorder`` marks days that don't ascend."""
    rows = docs.select("code", "external_sub", F.posexplode(F.from_json("body", "array<struct<d:string,v:array<string>>>")).alias("pos", "r"))
    day = F.col("r.d").try_cast("date")
    w = Window.partitionBy("code").orderBy("pos")
    points = rows.select("code", day.alias("obs_date"), F.get("r.v", F.col("external_sub")).try_cast(DEC).alias("value"), F.coalesce(day <= F.lag(day).over(w), F.lit(False)).alias("disorder"))
    return points.where("value is not null")


def chart_bars(docs: DataFrame) -> DataFrame:
    """Parallel arrays of timestamps and quotes to daily bars in the exchange's zone; rows without a close are left out."""
    quote = "struct<open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<double>>"
    doc = F.from_json("body", f"chart struct<result:array<struct<meta:struct<exchangeTimezoneName:string,currency:string,dataGranularity:string>,timestamp:array<bigint>,indicators:struct<quote:array<{quote}>,adjclose:array<struct<adjclose:array<double>>>>>>>")
    r = docs.select("code", F.get(doc["chart"]["result"], F.lit(0)).alias("r"))
    q = F.get("r.indicators.quote", F.lit(0))
    zipped = F.arrays_zip(F.col("r.timestamp").alias("t"), *[q[c].alias(c) for c in ("open", "high", "low", "close", "volume")], F.get("r.indicators.adjclose", F.lit(0))["adjclose"].alias("adj"))
    rows = r.select("code", F.col("r.meta.exchangeTimezoneName").alias("zone"), F.posexplode(zipped).alias("pos", "b")).where("b.close is not null")
    day = F.to_date(F.from_utc_timestamp(dates.from_seconds(F.col("b.t")), F.col("zone")))
    return rows.groupBy("code", day.alias("obs_date")).agg(F.max_by("b", "pos").alias("b")).select("code", "obs_date", "b.open", "b.high", "b.low", "b.close", "b.adj", "b.volume")


def candles(docs: DataFrame) -> DataFrame:
    """Exchange candles (arrays of twelve with numbers as text) to daily bars by the UTC day of opening; the last reading of a day stays."""
    rows = docs.select("code", F.posexplode(F.from_json("body", "array<array<string>>")).alias("pos", "k")).where("size(k) = 12")
    at = lambda i: F.get("k", F.lit(i)).try_cast(DEC)
    day = F.to_date(dates.from_millis(F.get("k", F.lit(0)).try_cast("long")))
    last = rows.groupBy("code", day.alias("obs_date")).agg(F.max_by("k", "pos").alias("k"))
    return last.select("code", "obs_date", *[at(i).alias(n) for i, n in enumerate(("open", "high", "low", "close", "volume"), 1)])


def next_page(candles_ms: Column) -> Column:
    """Where the next page of candles starts."""
    return F.max(candles_ms) + 1
