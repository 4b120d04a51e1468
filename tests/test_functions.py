from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text


def one(spark, x, kind, f):
    return spark.createDataFrame([(x,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_titles_and_urls(spark):
    assert one(spark, "(ĐTCK) Giá vàng &amp; Đô la: Tăng 5%", "string", text.norm_title) == "giavangdolatang5"
    assert one(spark, None, "string", text.norm_title) == ""
    assert one(spark, "HTTP://CafeF.vn/a/b/?utm_source=x&id=3&fbclid=9#t", "string", text.canonical_url) == "https://cafef.vn/a/b?id=3"
    assert one(spark, "http://x.vn", "string", text.canonical_url) == "https://x.vn/"


def test_similarity_and_search(spark):
    assert one(spark, "word", "string", lambda c: text.similarity(text.trigrams(c), text.trigrams(F.lit("two words")))) == 4 / 11
    doc = text.tokens(F.lit("The bank raised its rate"))
    r = spark.range(1).select(text.matches_phrase(doc, ["raised", "its"]), text.matches_phrase(doc, ["its", "raised"]), text.matches_all(doc, ["rate", "bank"]), text.matches_all(doc, [])).first()
    assert tuple(r) == (True, False, True, False)


def test_tickers(spark):
    listed = F.array(*map(F.lit, ["FPT", "VND", "HPG", "A32"]))
    assert one(spark, "HPG và FPT, USD, VND, A32, FPT lãi", "string", lambda c: text.tickers_in(c, listed)) == ["HPG", "FPT", "A32"]
    assert one(spark, "https://cafef.vn/du-lieu/FPT-123/x.chn", "string", text.ticker_of_url) == "FPT"
    assert one(spark, "https://cafef.vn/du-lieu/HNX-123/x.chn", "string", text.ticker_of_url) is None
    agree = lambda a, b: spark.range(1).select(text.dates_agree(F.lit(a), F.lit(b))).first()[0]
    assert agree("Giá 22/8", "Giá 22-8") and not agree("Giá 22/8", "Giá 24/8") and agree("Giá", "Giá 24/8")


def test_numbers(spark):
    assert float(one(spark, "6.307,47", "string", text.parse_number)) == 6307.47 and one(spark, "6,307.47", "string", text.parse_number) is None
    assert one(spark, 1234567.84, "double", lambda c: text.format_number(c, 1)) == "1.234.567,8"
    assert [str(one(spark, x, "string", numbers.price)) for x in ("100.005", "100.015", "x")] == ["100.00", "100.02", "None"]
    assert one(spark, "100.005", "string", numbers.was_rounded) and not one(spark, "100.01", "string", numbers.was_rounded)
    assert [one(spark, x, "string", numbers.count) for x in ("5", "5.0", "5.5", "-1", "")] == [5, 5, None, None, None]
    assert one(spark, "closePriceAdj", "string", text.snake) == "close_price_adj"


def test_dates(spark):
    utc = lambda *a: dt.datetime(*a)
    assert one(spark, "Mon, 07 Sep 2026 10:00:00 GMT+7", "string", dates.feed_time) == utc(2026, 9, 7, 3)
    assert one(spark, "9/7/2026 3:05:00 PM", "string", dates.feed_time) == utc(2026, 9, 7, 8, 5)
    assert one(spark, "2026-09-07T10:00:00+07:00", "string", dates.feed_time) == utc(2026, 9, 7, 3)
    assert one(spark, "gestern", "string", dates.feed_time) is None
    assert one(spark, "https://baochinhphu.vn/x-102260907101500123.htm", "string", dates.time_in_url) == utc(2026, 9, 7, 3, 15)
    assert one(spark, "https://vietnambiz.vn/x-202697101500123.htm", "string", dates.time_in_url) == utc(2026, 9, 7, 3, 15)
    assert one(spark, utc(2026, 9, 6, 18), "timestamp", dates.local_date) == dt.date(2026, 9, 7)
    q = lambda d: one(spark, d, "date", lambda c: dates.period_anchor(c, F.lit("q")))
    assert q(dt.date(2026, 9, 30)) == dt.date(2026, 7, 1) and q(dt.date(2026, 8, 30)) is None
    now = dt.datetime(2026, 9, 4, 3, tzinfo=dt.UTC)  # Friday 10:00 there
    assert dates.in_session(now) and not dates.in_session(now + dt.timedelta(days=1))
    assert dates.next_session(now).date() == dt.date(2026, 9, 7)
