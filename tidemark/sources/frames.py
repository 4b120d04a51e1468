"""Stream frames: capture lines, envelopes, and typed rows per topic.

A capture line is ``{"r": received_ms, "p": packet}``; a packet is
``42["event", payload]`` and a payload an envelope ``{"a": …, "d": [record…]}``, a
list or a bare record.  Records are string maps, so no number type is guessed;
rows that break a rule go to quarantine with a reason and are never dropped silently.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers
from tidemark.operators import dedup, reshape
from tidemark.sources import snapshots

EVENTS = ("t", "o", "i", "idx", "ptm")
# The index codes and floors that are subscribed.
INDEX_CODES = tuple("HOSE 30 100 MID SML XALL X50 SI ALL DIAMOND FINLEAD FINSELECT HNX HNX30 UPCOM".split())
FLOORS = ("HOSE", "HNX", "UPCOM")

# Frame keys and the columns that they fill, by kind of number.
_I_PRICE = {"B1": "b1", "B2": "b2", "B3": "b3", "S1": "s1", "S2": "s2", "S3": "s3", "CP": "close_price", "CH": "change", "CHP": "change_pct", "AP": "avg_price", "HI": "high", "P2": "last_price", "TV": "total_value", "PMP": "pt_price", "PTV": "pt_total_val"}
_I_COUNT = {"V1": "v1", "V2": "v2", "V3": "v3", "U1": "u1", "U2": "u2", "U3": "u3", "TB": "total_bid", "TO": "total_offer", "CV": "last_vol", "P1": "last_vol2", "TT": "total_vol", "FB": "foreign_buy", "FS": "foreign_sell", "FR": "foreign_remain", "PMQ": "pt_qty", "PTQ": "pt_total_qty"}
_IDX_PRICE = {"MI": "index_value", "ICH": "change", "IPC": "change_pct", "TVA": "total_value", "PTV": "pt_value"}
_IDX_COUNT = {"TV": "total_vol", "ADV": "advances", "DE": "declines", "NC": "unchanged", "NOC": "ceiling_cnt", "AV": "adv_vol", "DV": "dec_vol", "NCV": "unch_vol", "PTT": "pt_total"}


def read_capture(spark: SparkSession, path: str, since_ms: int | None = None, until_ms: int | None = None) -> DataFrame:
    """``received_ms``, ``packet`` of capture files (plain or gzip), optionally within a time range."""
    rows = spark.read.schema("r long, p string").json(path).select(F.col("r").alias("received_ms"), F.col("p").alias("packet"))
    if since_ms is not None:
        rows = rows.where(F.col("received_ms") >= since_ms)
    return rows if until_ms is None else rows.where(F.col("received_ms") <= until_ms)


def write_capture(packets: DataFrame, path: str) -> None:
    """Append capture lines as gzipped JSON in a folder per local day and hour."""
    here = F.from_utc_timestamp(dates.from_millis(F.col("received_ms")), dates.ZONE)
    rows = packets.select(F.col("received_ms").alias("r"), F.col("packet").alias("p"), F.date_format(here, "yyyyMMdd").alias("day"), F.date_format(here, "HH").alias("hour"))
    rows.write.mode("append").partitionBy("day", "hour").option("compression", "gzip").json(path)


def prune_capture(spark: SparkSession, path: str, today: date, keep: int = 30) -> list[str]:
    """Delete the days of a capture that are older than ``keep`` days; returns their names."""
    return snapshots.drop_partitions(spark, path, "day", f"{today - timedelta(days=keep):%Y%m%d}")


def records(packets: DataFrame) -> DataFrame:
    """``received_ms``, ``event``, ``pos``, ``fields`` (string map) of the known events' records."""
    body = F.regexp_extract("packet", r"(?s)^42\d*(\[.*\])$", 1)
    plain = F.nullif(F.regexp_extract("body", r'^\["([A-Za-z]*)",', 1), F.lit(""))  # a name that needs no parser
    rows = packets.select("received_ms", body.alias("body")).select("received_ms", "body", F.coalesce(plain, F.get_json_object("body", "$[0]")).alias("event")).where(F.col("event").isin(*EVENTS))
    payload = F.get_json_object("body", "$[1]")
    # the payload itself is looked at only if it has no ``d`` at its top
    inner = F.coalesce(F.get_json_object("body", "$[1].d"), F.get_json_object(payload, "$.d"), payload)
    rows = rows.select("received_ms", "event", inner.alias("inner"))
    maps = F.when(F.col("inner").startswith("["), F.from_json("inner", "array<map<string,string>>")).otherwise(F.array(F.from_json("inner", "map<string,string>")))
    return rows.select("received_ms", "event", F.posexplode(maps).alias("pos", "fields")).where("fields is not null")


def symbol(event: Column, fields: Column) -> Column:
    return F.when(event == "idx", fields["MC"]).otherwise(fields["SB"])


def accept(rows: DataFrame, window_ms: int = 600_000) -> DataFrame:
    """Deduplicate by content within a sliding window, drop records without a symbol, stamp per symbol.

    The same function serves captured files and micro-batches, so an offline count
    equals the live one.  Order is arrival, then place in the packet.
    """
    keyed = rows.withColumn("key", F.sha1(F.concat_ws("\x00", "event", F.to_json(F.map_from_entries(F.sort_array(F.map_entries("fields")))))))
    fresh = dedup.sliding_dedup(keyed, ["key"], "received_ms", ["received_ms", "pos"], window_ms).where("not dup").drop("dup", "key")
    named = fresh.withColumn("symbol", symbol(F.col("event"), F.col("fields"))).where("symbol is not null")
    return dedup.stamp(named, "symbol", "received_ms", ["received_ms", "pos"])


def _has(k: str) -> Column:
    return F.coalesce(F.col("fields")[k] != "", F.lit(False))


def _value(k: str) -> Column:
    return F.when(_has(k), F.col("fields")[k])


def _price(k: str, default: bool) -> Column:
    p = numbers.price(_value(k))
    return F.when(~_has(k), F.lit(0).cast("decimal(18,2)")).otherwise(p) if default else p


def _count(k: str, default: bool) -> Column:
    c = numbers.count(_value(k))
    return F.when(~_has(k), F.lit(0).cast("long")).otherwise(c) if default else c


def _text(k: str) -> Column:
    return F.coalesce(_value(k), F.lit(""))


def _reason(required: tuple[str, ...], prices: tuple[str, ...], counts: tuple[str, ...], ts: Column, more: Column | None = None) -> Column:
    """The first rule that a record breaks, or null."""
    out = F.lit(None).cast("string")
    checks = [(~_has(k), f"missing {k}") for k in required]
    checks += [(_has(k) & F.col("fields")[k].try_cast("decimal(38,10)").isNull(), f"not a number {k}") for k in prices]
    checks += [(_has(k) & numbers.count(F.col("fields")[k]).isNull(), f"not a count {k}") for k in counts]
    checks.append((ts.isNull(), "bad time"))
    if more is not None:
        checks.append((~F.coalesce(more, F.lit(False)), "out of range"))
    for broken, name in reversed(checks):
        out = F.when(broken, name).otherwise(out)
    return out


def _millis(k: str) -> Column:
    return dates.from_millis(numbers.count(_value(k)))


def _typed(event: str) -> tuple[dict[str, Column], Column, tuple[str, ...], tuple[str, ...]]:
    """Columns, reason, keys that have a column and keys that are left out on purpose."""
    stamp = dates.from_millis(F.col("stamp")).alias("received_at")
    if event == "t":
        ts = dates.from_local(F.concat_ws(" ", _value("TD"), _value("FT")))
        cols = {"symbol": F.col("fields")["SB"], "ts": ts, "seq": _count("SM", False), "price": _price("FMP", False), "volume": _count("FV", False), "side": _text("LC"), "change": _price("FCV", True), "cum_volume": _count("AVO", True), "cum_value": _price("AVA", True), "received_at": stamp}
        return cols, _reason(("SB", "TD", "FT", "FMP", "FV", "SM"), ("FMP", "FCV", "AVA"), ("SM", "FV", "AVO"), ts), ("TD", "FT", "SB", "FV", "LC", "FMP", "FCV", "SM", "AVO", "AVA"), ()
    if event == "o":
        ts = _millis("t")
        cols = {"symbol": F.col("fields")["SB"], "ts": ts, "top": _count("TOP", False), "action": _text("ACT"), "bid_price": _price("BP", True), "bid_qty": _count("BQ", True), "ask_price": _price("SP", True), "ask_qty": _count("SQ", True), "cum_bid": _count("CBV", True), "cum_ask": _count("CSV", True), "received_at": stamp}
        return cols, _reason(("SB", "TOP", "t"), ("BP", "SP"), ("TOP", "BQ", "SQ", "CBV", "CSV", "t"), ts, numbers.count(_value("TOP")).between(1, 3)), ("SB", "t", "TOP", "ACT", "BP", "BQ", "SP", "SQ", "CBV", "CSV", "id"), ()
    if event in ("i", "idx"):
        prices, counts = (_I_PRICE, _I_COUNT) if event == "i" else (_IDX_PRICE, _IDX_COUNT)
        ts, key = _millis("t"), "SB" if event == "i" else "MC"
        cols = {"symbol": F.col("fields")[key], **({"exchange": _text("EX")} if event == "i" else {}), "ts": ts}
        cols |= {c: _price(k, False) for k, c in prices.items()} | {c: _count(k, False) for k, c in counts.items()} | {"received_at": stamp}
        return cols, _reason((key, "t"), tuple(prices), (*counts, "t"), ts), (key, "t", *prices, *counts, *(("EX",) if event == "i" else ())), ("IT", "TD") if event == "idx" else ()
    ts = dates.from_seconds(numbers.count(_value("LS")))
    cols = {"symbol": F.col("fields")["SB"], "market": _text("MC"), "ts": ts, "price": _price("PR", False), "volume": _count("MVL", False), "ref_price": _price("RE", False), "ceil_price": _price("CE", False), "floor_price": _price("FL", False), "order_id": _text("CNO"), "received_at": stamp}
    return cols, _reason(("SB", "LS", "PR", "MVL"), ("PR", "RE", "CE", "FL"), ("LS", "MVL"), ts), ("SB", "MC", "LS", "PR", "MVL", "RE", "CE", "FL", "CNO"), ("TD", "TI")


def normalize(accepted: DataFrame, event: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of one event, and its quarantine (``fields``, ``reason``).

    Missing and empty fields are 0 or empty text in trades and quotes, where the
    columns have defaults, and null in snapshots and indices, where 0 would be a
    value.  ``i``, ``idx`` and ``ptm`` rows carry unknown fields as JSON in ``extra``;
    ``rounded`` counts prices with more than two decimals.
    """
    cols, reason, known, left_out = _typed(event)
    rows = accepted.where(F.col("event") == event).withColumn("reason", reason)
    if event in ("i", "idx", "ptm"):
        cols["extra"] = reshape.extra(F.col("fields"), (*known, *left_out))
    keys = {"t": ("FMP", "FCV", "AVA"), "o": ("BP", "SP"), "i": tuple(_I_PRICE), "idx": tuple(_IDX_PRICE), "ptm": ("PR", "RE", "CE", "FL")}[event]
    rounded = sum((numbers.was_rounded(_value(k)).cast("int") for k in keys), F.lit(0))
    good = rows.where("reason is null").select(*[c.alias(n) for n, c in cols.items()], rounded.alias("rounded"))
    return good, rows.where("reason is not null").select("received_ms", "event", "fields", "reason")


def unknown_keys(accepted: DataFrame) -> DataFrame:
    """How often each event carries a key that it isn't known to have."""
    known = F.create_map(*[x for e in EVENTS for x in (F.lit(e), F.array(*[F.lit(k) for part in _typed(e)[2:] for k in part]))])
    keys = accepted.select("event", F.explode(F.map_keys("fields")).alias("key"))
    return keys.where(~F.array_contains(known[F.col("event")], F.col("key"))).groupBy("event", "key").count()


def delta(rows: DataFrame) -> DataFrame:
    """``symbol`` and the map of columns that a typed row carries, for state stores."""
    skip = ("extra", "received_at", "ts", "rounded")
    cols = {c: F.col(c) for c in rows.columns if c not in skip}
    return rows.select("symbol", "received_at", reshape.delta(cols, F.unix_millis("ts")).alias("delta"))


def catalogue(quotes: DataFrame, instruments: DataFrame) -> DataFrame:
    """Symbols to follow with their base prices: stocks and funds, and live derivatives.

    A derivative lives while it has a trading date and a status; a quote without an
    instrument falls back on its own three prices.
    """
    base = F.struct(*[F.col(c).cast("string").alias(c) for c in ("ceiling", "floor", "reference")])
    inst = instruments.select("symbol", base.alias("ib"), "FloorCode", "tradingdate", "Status")
    listed = quotes.where(F.col("StockType").isin("2", "3")).select("symbol", base.alias("qb")).join(inst.select("symbol", "ib"), "symbol", "left").select("symbol", F.coalesce("ib", "qb").alias("base"))
    live = inst.where("FloorCode = '03' and coalesce(tradingdate, '') <> '' and coalesce(Status, '') <> ''").select("symbol", F.col("ib").alias("base"))
    return listed.unionByName(live).dropDuplicates(["symbol"])


def topics(symbols: DataFrame) -> DataFrame:
    """Topics of a catalogue: three per symbol, one per index and floor."""
    own = symbols.select(F.explode(F.transform(F.array(F.lit("i:"), F.lit("o10:"), F.lit("t:")), lambda p: F.concat(p, F.col("symbol")))).alias("topic"))
    fixed = [f"idx:{c}" for c in INDEX_CODES] + [f"ptm:{f}" for f in FLOORS]
    return own.unionByName(symbols.sparkSession.createDataFrame([(x,) for x in fixed], "topic string"))


def subscriptions(topics_: DataFrame, size: int = 100) -> DataFrame:
    """Topics in chunks of ``size``, as a client sends them."""
    n = topics_.withColumn("chunk", F.floor((F.row_number().over(Window.orderBy("topic")) - 1) / size))
    return n.groupBy("chunk").agg(F.sort_array(F.collect_list("topic")).alias("topics"))
