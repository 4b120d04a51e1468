from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.sources import frames, http, market_series, pages, reports, snapshots
from tidemark.streaming import ticks

T = {"TD": "28/08/2026", "FT": "09:00:05", "SB": "AAA", "FV": "100", "LC": "B", "FMP": "100.005", "SM": "1"}
LINES = [
    (1000, "t", {"a": "u", "d": [T]}),
    (1500, "t", {"a": "u", "d": [T, T | {"SM": "2", "FMP": "101", "FT": "09:00:07"}]}),
    (1600, "t", [T | {"SM": "3", "FV": "x"}]),
    (1700, "i", {"SB": "AAA", "EX": "HOSE", "t": "1756346405000", "B1": "", "CP": "12.3", "ZZ": "9", "AB": "1"}),
    (1800, "o", {"SB": "AAA", "t": "1756346405000", "TOP": "4"}),
    (1900, "idx", {"MC": "VNI", "t": "1756346405000", "MI": "1200.5", "IT": "x"}),
    (2000, "ptm", {"SB": "BBB", "LS": "1756346405", "PR": "5", "MVL": "7", "MKI": "k"}),
    (2100, "t", {"d": [{"FV": "1"}]}),
    (700_000, "t", {"d": [T]}),
]


def write(path, lines=LINES):
    path.mkdir(parents=True, exist_ok=True)
    (path / "frames-0.jsonl").write_text("\n".join(json.dumps({"r": r, "p": "42" + json.dumps([e, d])}) for r, e, d in lines))
    return str(path)


def test_frames(spark, tmp_path):
    rows = frames.accept(frames.records(frames.read_capture(spark, write(tmp_path / "c")))).persist()
    good, bad = frames.normalize(rows, "t")
    got = good.orderBy("seq", "received_at").collect()
    assert [(r.seq, r.price, r.rounded, r.cum_volume) for r in got] == [(1, Decimal("100.00"), 1, 0), (1, Decimal("100.00"), 1, 0), (2, Decimal("101.00"), 0, 0)]
    assert got[0].ts == dt.datetime(2026, 8, 28, 2, 0, 5) and [r.reason for r in bad.collect()] == ["not a count FV"]
    i = frames.normalize(rows, "i")[0].first()
    assert i.b1 is None and i.close_price == Decimal("12.30") and json.loads(i.extra) == {"AB": "1", "ZZ": "9"}
    assert frames.normalize(rows, "o")[1].first().reason == "out of range"
    assert frames.normalize(rows, "idx")[0].first().extra == "" and json.loads(frames.normalize(rows, "ptm")[0].first().extra) == {"MKI": "k"}
    assert {(r.event, r.key) for r in frames.unknown_keys(rows).collect()} == {("i", "ZZ"), ("i", "AB"), ("ptm", "MKI")}
    assert "ts" in frames.delta(frames.normalize(rows, "t")[0]).first().delta
    n = frames.read_capture(spark, str(tmp_path / "c"), since_ms=1500, until_ms=2000).count()
    assert n == 6


def test_stream_equals_batch(spark, tmp_path):
    src, root = write(tmp_path / "c"), str(tmp_path / "out")
    packets = frames.read_capture(spark, src)
    batch = sorted((r.symbol, r.stamp, r.event) for r in frames.accept(frames.records(packets)).collect())
    q = ticks.start(ticks.capture(spark, src), root, str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert q.exception() is None
    bar = ticks.minute_bars(spark, root).collect()
    assert len(bar) == 1 and (bar[0].o, bar[0].c, bar[0].v) == (Decimal("100.00"), Decimal("101.00"), 300)
    live = spark.read.parquet(f"{root}/t").count() + spark.read.parquet(f"{root}/quarantine").count() + sum(spark.read.parquet(f"{root}/{e}").count() for e in ("i", "idx", "ptm"))
    assert live == len(batch)
    write(tmp_path / "late")
    ticks.write_batch(root, spark.createDataFrame([(1, 0, "t", json.dumps(T | {"FMP": "90", "FT": "09:00:01"}), "AAA", 9)], ticks.ACCEPTED), 77)
    late = ticks.minute_bars(spark, root).first()
    assert late.o == Decimal("90.00") and late.v == 400


def test_latest_state(spark, tmp_path):
    table = snapshots.Table(spark, f"file://{tmp_path}/state")
    kind = "symbol string, ms long, delta map<string,string>"
    ticks.latest_state(table, spark.createDataFrame([("A", 1, {"p": "1", "q": "5"}), ("OLD", 1, {"p": "0"})], kind), 10, ttl_ms=100)
    ticks.latest_state(table, spark.createDataFrame([("A", 105, {"p": "2"})], kind), 110, ttl_ms=100)
    assert [(r.symbol, r.state) for r in table.read().collect()] == [("A", {"p": "2", "q": "5"})]
    assert table.versions() == [1, 2]


def test_retention_and_backups(spark, tmp_path):
    spark.createDataFrame([(1, "202601"), (2, "202604")], "x int, m string").write.partitionBy("m").parquet(str(tmp_path / "t"))
    assert snapshots.drop_partitions(spark, str(tmp_path / "t"), "m", "202603") == ["m=202601"]
    assert snapshots.backups_to_keep(["2026-01-01", "2026-01-02", "2026-02-03", "2026-02-04"], recent=1) == ["2026-01-01", "2026-02-03", "2026-02-04"]
    assert snapshots.partitions_to_copy(["01", "02"], ["00", "01", "02"], "02") == (["02"], ["00"])


def test_catalogue_and_topics(spark):
    q = spark.createDataFrame([("AAA", "2", "1", "2", "3"), ("CW1", "4", "1", "2", "3")], "symbol string, StockType string, ceiling string, floor string, reference string")
    inst = spark.createDataFrame([("VN30F1", "1", "2", "3", "03", "x", "ok"), ("OLD", "1", "2", "3", "03", None, None)], "symbol string, ceiling string, floor string, reference string, FloorCode string, tradingdate string, Status string")
    cat = frames.catalogue(q, inst)
    assert sorted(r.symbol for r in cat.collect()) == ["AAA", "VN30F1"]
    assert frames.topics(cat).count() == 2 * 3 + 15 + 3 and frames.subscriptions(frames.topics(cat), 10).count() == 3


def test_series_documents(spark):
    ms = lambda *a: int(dt.datetime(*a, tzinfo=dt.UTC).timestamp() * 1000)
    chart = json.dumps({"chart": {"series": [{"unit": "%", "name": "CPI", "data": [[ms(2026, 1, 31, 17), 2.5], [ms(2026, 3, 30, 17), 3]]}]}})
    got = market_series.chart_points(spark.createDataFrame([("c", "m", 1000, 0, chart)], "code string, freq string, scale long, idx int, body string")).orderBy("obs_date").collect()
    assert [(r.obs_date, r.value) for r in got] == [(dt.date(2026, 2, 1), 2500), (dt.date(2026, 3, 1), 3000)]
    obs = json.dumps({"observations": [{"date": "2026-01-01", "value": "."}, {"date": "2026-01-02", "value": "4.1"}]})
    assert [r.value for r in market_series.observations(spark.createDataFrame([("c", 1, obs)], "code string, scale long, body string")).collect()] == [Decimal("4.1")]
    fx = json.dumps({"base": "USD", "rates": {"2026-01-02": {"EUR": 0.9}, "2026-01-03": {"JPY": 150}}})
    assert market_series.rates(spark.createDataFrame([("c", "EUR", fx)], "code string, external_key string, body string")).count() == 1
    fix = json.dumps([{"d": "2026-01-02", "v": [1, 2, None]}, {"d": "2026-01-02", "v": [3, 4, 5]}])
    assert [(r.value, r.disorder) for r in market_series.fixings(spark.createDataFrame([("c", 0, fix)], "code string, external_sub int, body string")).collect()] == [(1, False), (3, True)]
    t = int(dt.datetime(2026, 1, 2, 23, tzinfo=dt.UTC).timestamp())
    bars = json.dumps({"chart": {"result": [{"meta": {"exchangeTimezoneName": "Asia/Tokyo"}, "timestamp": [t, t + 86400], "indicators": {"quote": [{"open": [1, 2], "high": [1, 2], "low": [1, 2], "close": [1.5, None], "volume": [10, 20]}], "adjclose": [{"adjclose": [1.4, None]}]}}]}})
    r = market_series.chart_bars(spark.createDataFrame([("c", bars)], "code string, body string")).collect()
    assert [(x.obs_date, x.close, x.adj) for x in r] == [(dt.date(2026, 1, 3), 1.5, 1.4)]
    candle = json.dumps([[ms(2026, 1, 2), "1", "2", "0.5", "1.5", "9", 1, "0", 1, "0", "0", "0"]])
    assert market_series.candles(spark.createDataFrame([("c", candle)], "code string, body string")).first().close == Decimal("1.5")


def test_reports(spark):
    page = json.dumps({"totalCount": 2, "items": [{"organCode": "O", "publicDate": "2026-01-02T00:00:00", "issueDate": "2026-02-01", "ticker": None}, {"organCode": "O", "publicDate": "2026-01-02", "issueDate": "2026-02-01T07:00:00", "ticker": "TTT"}]})
    got = reports.events(spark.createDataFrame([("AGM", 1, page)], "event_type string, page int, body string")).collect()
    assert len(got) == 1 and got[0].ticker == "TTT" and got[0].n_dups == 1 and got[0].exright_date == dt.date(1900, 1, 1)
    st = json.dumps({"items": [{"quarterly": [], "yearly": [{"organCode": "O", "yearReport": 2025, "quarterReport": 5, "ISA3": 10.5, "isa9": None, "ebit": 3}]}]})
    facts = reports.statements(spark.createDataFrame([("O", "IS", st)], "organ_code string, statement string, body string")).collect()
    assert [(r.metric, r.value, r.clash) for r in facts] == [("isa3", 10.5, False)]
    scr = json.dumps({"totalCount": 1, "items": [{"priceInfo": {"ticker": "AAA", "comGroupCode": "VNINDEX", "tradingDate": "2026-01-02T00:00:00", "x1": 5}, "stockScreenerItem": {"rtd11": 7}, "financial": {"rtd11": 8}, "performance": None, "technical": None}]})
    rows = {r.code: (r.exchange, r.block, r.value, r.conflicts) for r in reports.screener_facts(spark.createDataFrame([(scr,)], "body string"), ("rtd11", "x1")).collect()}
    assert rows == {"rtd11": ("HOSE", "stockScreenerItem", "7", 1), "x1": ("HOSE", "priceInfo", "5", 0)}
    snap = json.dumps({"quarterly": [{"yearReport": 2025, "quarterReport": 2, "a": 1}, {"yearReport": 2025, "quarterReport": 3, "a": 2}], "yearly": []})
    assert reports.latest_snapshot(spark.createDataFrame([("O", snap)], "organ_code string, body string"), ("a",)).first().quarter == 3


RESULT = """<html><div class="ls01-date">Ngày 3 tháng 2 năm 2026</div><h1>KẾT QUẢ ĐẤU THẦU THỊ TRƯỜNG MỞ</h1><table>
<tr><th>Loại hình giao dịch</th><th>Số thành viên</th><th>Khối lượng</th><th>Lãi suất</th></tr>
<tr class="ls01-group"><td>Mua kỳ hạn</td><td></td><td></td><td></td></tr>
<tr><td>- 7 ngày</td><td>5/3</td><td>6.307,47</td><td>4,5</td></tr><tr><td>- 7 ngày</td><td>2/2</td><td>1.000</td><td>4,5</td></tr>
<tr class="ls01-total"><td>Tổng cộng</td><td></td><td>7.307,47</td><td></td></tr></table></html>"""


def test_auctions(spark, tmp_path):
    docs = spark.createDataFrame([("good", RESULT), ("sum", RESULT.replace("7.307,47", "7.307,48")), ("group", RESULT.replace("Mua kỳ hạn", "Thuê")), ("none", "<html></html>")], "page_id string, body string")
    good, bad = pages.auctions(docs)
    r = good.collect()
    assert len(r) == 1 and (r[0].tenor_days, r[0].participants, r[0].winners, r[0].volume_vnd, r[0].rate_pct) == (7, 7, 5, Decimal("7307470000000.00"), Decimal("4.5"))
    assert sorted(x.page_id for x in bad.collect()) == ["group", "none", "sum"]
    csv = tmp_path / "seed.csv"
    csv.write_text("session_date,tenor_days,participants,winners,volume_bn,rate\n2026-02-03,7,5,,10,0.045\n2026-02-03,7,2,2,5,0.045\n")
    s = pages.auction_seed(spark, str(csv)).first()
    assert (s.volume_vnd, s.participants, s.winners, s.rate_pct) == (Decimal("15000000000.00"), 7, None, Decimal("4.5"))


def test_feeds_and_articles(spark):
    rss = '<?xml version="1.0" encoding="utf-16"?><rss><channel><item><title>A &amp;amp; B</title><link>https://x.vn/a?utm_source=1</link><pubDate>Mon, 07 Sep 2026 10:00:00 +0700</pubDate></item><item><title>t</title></item></channel></rss>'
    site = '<urlset xmlns="http://s"><url><loc>https://y.vn/</loc></url><url><loc>https://y.vn/p-102260907101500123.htm</loc><lastmod></lastmod></url></urlset>'
    links = '<a href="/du-lieu/FPT-1/x.chn">f</a><a href="/other">o</a>'
    docs = spark.createDataFrame([("r", "rss", None, None, rss), ("s", "sitemap", None, r"-102\d+", site), ("l", "links", "https://cafef.vn/", "/du-lieu/", links), ("b", "rss", None, None, "<x")], "feed string, kind string, base string, article string, body string")
    got = {r.feed: r for r in pages.feeds(docs).collect()}
    assert got["r"].canonical == "https://x.vn/a" and got["r"].title == "A & B" and got["r"].published_at == dt.datetime(2026, 9, 7, 3)
    assert got["s"].published_at == dt.datetime(2026, 9, 7, 3, 15) and got["l"].ticker == "FPT" and got["b"].error.startswith("broken XML")
    rule = pages.ArticleRule("div.body", "h1.t", ("figure", "#ad"), "p.s", least=5)
    body = '<h1 class="t">Tiêu đề</h1><p class="s">Sapo</p><div class="x body"><!-- c --><p>Một  hai</p><figure>f</figure><div id="ad">ad</div><script>s</script></div>'
    a = pages.articles(spark.createDataFrame([("u", "k", body), ("v", "k", "<p>")], "url string, rule string, body string"), {"k": rule}).orderBy("url").collect()
    assert (a[0].title, a[0].summary, a[0].content) == ("Tiêu đề", "Sapo", "Một hai") and a[1].error == "no container"
    assert spark.createDataFrame([("é".encode("utf-16-le") + b"a\0" * 60,)], "b binary").select(pages.decoded("b")).first()[0].startswith("éa")


def test_http():
    calls, slept = [], []

    def get(url):
        calls.append(url)
        return "busy" if len(calls) < 3 else "body"

    assert http.fetch(get, "u", lambda b: "retry" if b == "busy" else "ok", sleep=slept.append) == "body" and slept[1:] == [2, 4]
    with pytest.raises(http.GaveUp):
        http.fetch(lambda _: "x", "u", lambda _: "bad", sleep=slept.append)
    assert [len(p) for p in http.pages(lambda n: (list(range(60 if n < 3 else 5)), 125), 60)] == [60, 60, 5]

    def fail(_):
        raise http.GaveUp

    with pytest.raises(http.GaveUp):
        http.all_of(list("abcdefghijkl"), fail)
    assert F is not None
