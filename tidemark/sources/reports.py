"""Issuer documents: screener, events, statements, snapshots, directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import dedup, reshape

# Blocks in the order in which they claim a code, exchanges by group code, fields that are no metrics.
BLOCKS = ("stockScreenerItem", "financial", "priceInfo", "performance", "technical")
EXCHANGE = {"VNINDEX": "HOSE", "HNXIndex": "HNX", "UpcomIndex": "UPCOM"}
NON_METRIC = ("organCode", "ebit", "ebitDa", "operating", "otherAssetBank", "otherAssetNonBank", "otherLiabilties", "rtq29", "yearReport", "quarterReport")
LENGTHS = (1, 2, 3, 4, 5)


def _items(body: Column) -> Column:
    return F.from_json(F.get_json_object(body, "$.items"), "array<map<string,string>>")


def screener_facts(pages: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Kept codes of every ticker: ``ticker``, ``exchange``, ``trading_date``, ``code``, ``block``, ``value``, ``conflicts``.

    A code that several blocks have goes to the first in priority order.
    """
    item = F.explode(_items(F.col("body"))).alias("item")
    rows = pages.select(item)
    info = F.from_json(F.col("item")["priceInfo"], "map<string,string>")
    names = F.create_map(*[F.lit(x) for kv in EXCHANGE.items() for x in kv])
    head = rows.select(info["ticker"].alias("ticker"), names[info["comGroupCode"]].alias("exchange"), F.to_date(F.substring(info["tradingDate"], 1, 10)).alias("trading_date"), "item").where("exchange is not null")
    blocks = F.map_filter("item", lambda k, v: k.isin(*BLOCKS) & v.isNotNull())
    long = head.select("ticker", "exchange", "trading_date", F.explode(blocks).alias("block", "json"))
    codes = long.select("ticker", "exchange", "trading_date", "block", F.explode(F.from_json("json", "map<string,string>")).alias("code", "value")).where(F.col("code").isin(*keep))
    return reshape.first_block(codes, ["ticker", "exchange", "trading_date"], BLOCKS)


def mapped(rows: DataFrame, directory: DataFrame, key: tuple[str, ...] = ("ticker", "exchange")) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``security_id``, and the distinct keys that the directory lacks."""
    known = directory.select(*key, "security_id")
    return rows.join(known, list(key)), rows.select(*key).distinct().join(known, list(key), "left_anti")


def stage_key(event_type: Column, item: Column) -> Column:
    """The part of an event's key that its type adds; null in a part is written as the source does."""
    part = lambda k: F.coalesce(item[k], F.lit("None"))
    text = lambda k: F.coalesce(item[k], F.lit(""))
    return (
        F.when(event_type.isin("CashDividend", "StockDividend"), F.concat_ws("|", part("dividendYear"), text("stageName")))
        .when(event_type == "ShareIssuance", F.concat_ws("|", text("issueMethodName"), part("issueYear"), part("planVolumn")))
        .when(event_type == "AGM", F.substring(text("issueDate"), 1, 10))
    )


EVENT_KEY = ("event_type", "organ_code", "public_date", "exright_date", "year_report", "length_report", "stage_key")


def events(pages: DataFrame) -> DataFrame:
    """Corporate events, one per natural key: of repeats the fullest, then the last, stays.

    ``pages`` has ``event_type``, ``page`` and ``body``.  Missing parts of the key stand
    as 1900-01-01, 0 and empty text.
    """
    rows = pages.select("event_type", "page", F.posexplode(_items(F.col("body"))).alias("pos", "item"))
    day = lambda k: F.to_date(F.substring(F.col("item")[k], 1, 10))
    none = F.lit("1900-01-01").cast("date")
    whole = lambda k: F.coalesce(F.col("item")[k].try_cast("int"), F.lit(0))
    typed = rows.select(
        "event_type", F.col("item")["organCode"].alias("organ_code"), F.coalesce(day("publicDate"), none).alias("public_date"), F.coalesce(day("exrightDate"), none).alias("exright_date"),
        whole("yearReport").alias("year_report"), whole("lengthReport").alias("length_report"), F.coalesce(stage_key(F.col("event_type"), F.col("item")), F.lit("")).alias("stage_key"),
        F.col("item")["ticker"].alias("ticker"), F.coalesce(F.col("item")["organShortName"], F.col("item")["organName"]).alias("organ_name"), day("recordDate").alias("record_date"), day("payoutDate").alias("payout_date"),
        F.col("item")["sourceUrl"].alias("source_url"), F.size(F.map_filter("item", lambda _, v: v.isNotNull())).alias("filled"), "page", "pos", "item",
    )
    rest = [c for c in typed.columns if c not in EVENT_KEY]
    best = typed.groupBy(*EVENT_KEY).agg(F.max_by(F.struct(*rest), F.struct("filled", "page", "pos")).alias("r"), (F.count("*") - 1).alias("n_dups"))
    return best.select(*EVENT_KEY, "r.*", "n_dups").drop("filled", "page", "pos")


def statements(docs: DataFrame) -> DataFrame:
    """Long facts ``organ_code``, ``statement``, ``year``, ``length``, ``metric``, ``value`` of all periods.

    Equal repeats of a period collapse; ``clash`` marks periods that come twice with
    different content, which a job refuses.
    """
    item = F.from_json(F.get_json_object("body", "$.items[0]"), "quarterly array<map<string,string>>, yearly array<map<string,string>>")
    both = F.concat(F.coalesce(item["quarterly"], F.array().cast("array<map<string,string>>")), F.coalesce(item["yearly"], F.array().cast("array<map<string,string>>")))
    rows = docs.select("organ_code", "statement", F.explode(both).alias("rec"))
    rows = rows.select("organ_code", "statement", F.col("rec")["yearReport"].try_cast("int").alias("year"), F.col("rec")["quarterReport"].try_cast("int").alias("length"), "rec").where(F.col("length").isin(*LENGTHS) & F.col("year").isNotNull())
    digest = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("rec"))))
    w = ["organ_code", "statement", "year", "length"]
    one = rows.groupBy(*w).agg(F.min_by("rec", digest).alias("rec"), (F.count_distinct(digest) > 1).alias("clash"))
    metrics = F.map_filter("rec", lambda k, v: ~k.isin(*NON_METRIC) & v.isNotNull())
    long = reshape.long(one, [*w, "clash"], metrics)
    return long.withColumn("value", F.col("value").try_cast("double")).where("value is not null")


def latest_snapshot(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``organ_code``, the newest period's ``fields`` and a ``digest`` of the kept ones."""
    item = F.from_json("body", "quarterly array<map<string,string>>, yearly array<map<string,string>>")
    ranked = lambda xs: F.transform(xs, lambda r: F.struct(r["yearReport"].try_cast("int").alias("year"), F.coalesce(r["quarterReport"].try_cast("int"), F.lit(0)).alias("quarter"), F.array_sort(F.map_entries(r)).alias("entries")))
    newest = reshape.newest_period(ranked(item["quarterly"]), ranked(item["yearly"]))
    rows = docs.select("organ_code", newest.alias("p"))
    fields = F.map_from_entries(F.col("p.entries"))
    return rows.where("p is not null").select("organ_code", "p.year", "p.quarter", fields.alias("fields"), reshape.whitelist_digest(fields, keep).alias("digest"))


def classify(quotes: DataFrame) -> DataFrame:
    """Directory rows with ``kind``: stock, etf, or why they are skipped."""
    t = F.col("StockType")
    kind = F.when((t == "2") & F.col("symbol").rlike("^[A-Z0-9]{3}$"), "stock").when(t == "2", "junk").when(t == "3", "etf").when(t == "4", "warrant").when(t == "12", "bond").otherwise("unknown")
    return quotes.withColumn("kind", kind)


def directory(quotes: DataFrame, indices: DataFrame, orgs: DataFrame) -> DataFrame:
    """Securities from three sources: quoted ones, fixed indices, and organisations without a quote (delisted).

    Of organisations that share a ticker the first by type and code counts.
    """
    names = F.create_map(*[F.lit(x) for kv in EXCHANGE.items() for x in kv])
    best = dedup.keep_first(orgs.select("ticker", "organCode", "organTypeCode", "comGroupCode", "organName"), ["ticker"], ["organTypeCode", "organCode"]).drop("n_dups")
    quoted = classify(quotes).where(F.col("kind").isin("stock", "etf")).join(best.select(F.col("ticker").alias("symbol"), "organCode"), "symbol", "left")
    quoted = quoted.select(F.col("symbol").alias("ticker"), "exchange", "kind", F.lit("listed").alias("status"), F.col("organCode").alias("organ_code"))
    fixed = indices.select(F.col("code").alias("ticker"), "exchange", F.lit("index").alias("kind"), F.lit("listed").alias("status"), F.lit(None).cast("string").alias("organ_code"))
    gone = best.join(quoted.select("ticker").unionByName(fixed.select("ticker")), "ticker", "left_anti").withColumn("exchange", names[F.col("comGroupCode")]).where("exchange is not null")
    return quoted.unionByName(fixed).unionByName(gone.select("ticker", "exchange", F.lit("stock").alias("kind"), F.lit("delisted").alias("status"), F.col("organCode").alias("organ_code")))
