"""Explicit schemas of the warehouse and the rules that its rows must keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMAS = {
    "trade": "symbol string, ts timestamp, seq long, price decimal(18,2), volume long, side string, change decimal(18,2), cum_volume long, cum_value decimal(18,2), received_at timestamp",
    "security": "security_id long, issuer_id long, ticker string, exchange string, security_type string, status string, absent_since date",
    "issuer": "issuer_id long, org_code string, name string, short_name string, com_type string",
    "industry": "industry_id long, parent_id long, code string, name_vi string, level int, sort_order int",
    "issuer_industry": "issuer_id long, industry_id long, source string",
    "price_daily": "security_id long, trading_date date, close_adj decimal(18,4), close_raw decimal(18,4), open_value decimal(18,4), highest_value decimal(18,4), lowest_value decimal(18,4), payload map<string,string>",
    "statement": "issuer_id long, year_report int, length_report int, statement_type string, metric_code string, value decimal(38,10)",
    "event": "event_type string, issuer_id long, public_date date, exright_date date, record_date date, payout_date date, year_report int, length_report int, stage_key string",
    "indicator": "indicator_id long, code string, name_vi string, unit string, role string",
    "observation": "indicator_id long, obs_date date, value double",
    "break": "indicator_id long, break_day date, factor double",
    "asset": "asset_id long, code string, name_vi string, unit string",
    "asset_price": "asset_id long, obs_date date, price_type string, value double",
    "asset_ohlc": "asset_id long, obs_date date, open double, high double, low double, close double, volume double",
    "article": "article_id long, primary_source string, published_at timestamp, fetched_at timestamp, group_no int, sub string",
    "revision": "article_id long, version int, title string, sapo string, content string",
    "article_ticker": "article_id long, security_id long, via string",
    "article_industry": "article_id long, industry_id long",
    "metric": "dictionary string, code string, name string, unit string",
    "run": "run_id long, job string, status string, started_at timestamp, ended_at timestamp, stats map<string,string>",
}
KEYS = {
    "security": ["security_id"], "issuer": ["issuer_id"], "industry": ["industry_id"], "price_daily": ["security_id", "trading_date"], "statement": ["issuer_id", "year_report", "length_report", "statement_type", "metric_code"],
    "observation": ["indicator_id", "obs_date"], "asset_price": ["asset_id", "obs_date", "price_type"], "asset_ohlc": ["asset_id", "obs_date"], "revision": ["article_id", "version"], "article_ticker": ["article_id", "security_id", "via"],
}
CHECKS = {
    "statement": {"length": "length_report between 1 and 5", "type": "statement_type in ('IS', 'BS', 'CF', 'NO')"},
    "event": {"length": "length_report is null or length_report in (1, 2, 3, 4, 5, 6, 9)", "type": "event_type in ('Earning', 'AGM', 'CashDividend', 'ShareIssuance', 'StockDividend', 'IPO')"},
    "observation": {"value": "value is not null"},
    "trade": {"volume": "volume >= 0", "price": "price >= 0"},
}


def violations(rows: DataFrame, table: str) -> DataFrame:
    """Rows of a table that break a check (``rule``), and keys that occur twice (``duplicate``)."""
    rules = CHECKS.get(table, {})
    broken = F.filter(F.array(*[F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in rules.items()]).cast("array<string>"), lambda x: x.isNotNull())
    out = rows.select(F.to_json(F.struct(*rows.columns)).alias("row"), F.explode(broken).alias("rule"))
    if key := KEYS.get(table):
        twice = rows.groupBy(*key).count().where("count > 1").select(F.to_json(F.struct(*key)).alias("row"), F.lit("duplicate").alias("rule"))
        out = out.unionByName(twice)
    return out


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null key no parent has."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")


def price_factor(prices: DataFrame) -> DataFrame:
    """Adjusted over raw close; a raw close of 0 has no factor."""
    return prices.select("security_id", "trading_date", (F.col("close_adj") / F.nullif(F.col("close_raw"), F.lit(0))).alias("factor"))
