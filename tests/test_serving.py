from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import orchestration as o
from tidemark import plans, schemas
from tidemark.schemas import SCHEMAS
from tidemark.serving import Warehouse, reference

D = dt.date


@pytest.fixture(scope="module")
def store(spark):
    rows = {
        "security": [(1, 10, "AAA", "HOSE", "stock", "listed", None), (2, 10, "AAA", "HNX", "stock", "delisted", None), (3, 11, "AAB", "HNX", "stock", "listed", None), (4, None, "VNI", "HOSE", "index", "listed", None), (5, 12, "DED", "HOSE", "stock", "delisted", None)],
        "issuer": [(10, "oa", "A Corp", "ACorp", None), (11, "ob", "B", "B", "NH"), (12, "od", "D", "D", None)],
        "industry": [(1, None, "FIN", "Tài chính", 1, 1), (2, 1, "BANK", "Ngân hàng", 2, 2), (3, 1, "INS", "Bảo hiểm", 2, 1)],
        "issuer_industry": [(10, 2, "icb"), (11, 3, "manual")],
        "price_daily": [(1, D(2026, 1, d), Decimal(d), Decimal(d * 2), Decimal(1), Decimal(2), Decimal(1), None) for d in (2, 3, 4)],
        "statement": [(10, 2025, 5, "IS", "isa3", Decimal(100)), (10, 2024, 5, "IS", "isa3", Decimal(90)), (10, 2025, 1, "IS", "isa3", Decimal(20)), (10, 2025, 5, "BS", "bsa1", Decimal(5))],
        "event": [("AGM", 10, D(2026, 1, 5), None, None, None, 2025, 5, ""), ("IPO", 10, None, None, None, None, None, None, "")],
        "indicator": [(1, "cpi", "CPI", "%", "growth_ref"), (2, "gdp", "GDP", "USD", "data")],
        "observation": [(1, D(2020, m, 1), 100.0) for m in (1, 2, 3)],
        "break": [(1, D(2020, 3, 1), 1.6005)],
        "asset": [(1, "gold", "Vàng", "USD"), (2, "btc", "Bitcoin", "USD"), (3, "void", "None", None)],
        "asset_price": [(1, D(2026, 1, 1), "buy", 1.0), (1, D(2026, 1, 1), "sell", 2.0), (1, D(2026, 1, 2), "sell", 3.0)],
        "asset_ohlc": [(2, D(2026, 1, 1), 1.0, 2.0, 1.0, 1.5, 9.0)],
        "article": [(1, "x", dt.datetime(2026, 1, 1, 18), dt.datetime(2026, 1, 2), 1, "1a"), (2, "y", None, dt.datetime(2026, 1, 3), 2, "2a"), (3, "z", None, dt.datetime(2026, 1, 3), 2, "2a")],
        "revision": [(1, 1, "Old title", None, "lãi suất"), (1, 2, "Ngân hàng tăng lãi suất", "sapo", "nội dung"), (2, 1, "Lãi của ngân hàng và suất", None, "x")],
        "article_ticker": [(1, 1, "url"), (1, 1, "lookup")],
        "article_industry": [(1, 2)],
        "metric": [("field_dictionary", "isa3", "Revenue", "VND"), ("field_dictionary", "bsa1", "Assets", "VND")],
    }
    tables = {k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in rows.items()}
    payload = lambda **k: json.dumps({"stockScreenerItem": k})
    tables["screener"] = spark.createDataFrame([(1, D(2026, 1, 2), payload(rtd11="50", rtd21="9.5")), (3, D(2026, 1, 2), payload(rtd11=70)), (1, D(2026, 1, 1), payload(rtd11=1))], "security_id long, trading_date date, p string").select("security_id", "trading_date", F.parse_json("p").alias("payload"))
    return Warehouse(tables)


def test_prices(store):
    a = store.prices("aaa", from_date="2026-01-03")
    assert [r.close for r in a.rows.collect()] == [3, 4] and a.facts["total"] == 2 and not a.facts["truncated"]
    assert store.prices("AAA", adjusted=False, most=1).facts["truncated"] and store.prices("AAA", adjusted=False, most=1).rows.first().close == 8
    assert json.loads(store.prices("AAA", from_date="2030-01-01").to_json())["khoang_co_du_lieu"] == {"tu": "2026-01-02", "den": "2026-01-04"}
    assert store.prices("VNI").facts["has_data"] is False and store.prices("DED").facts["has_data"] is False
    assert store.prices("AAC").facts["suggestions"] == ["AAA", "AAB"] and store.prices("AAA", from_date="2025-13-45").facts["error"]


def test_financials(store):
    a = store.financials("AAA")
    assert [(r.year_report, r.metrics[0].value) for r in a.rows.collect()] == [(2025, 100), (2024, 90)]
    assert store.financials("AAA", from_year=2030).facts["range"] == {"tu": "2024", "den": "2025"}
    assert store.financials("AAA", period="quy").facts["n_rows"] == 1 and store.financials("AAA", statement="XX").facts["error"] and store.financials("AAA", codes=["zz"]).facts["error"]


def test_screen_and_peers(store):
    a = store.screen()
    assert [r.ticker for r in a.rows.collect()] == ["AAB", "AAA"] and a.facts["day"] == "2026-01-02"
    assert [r.ticker for r in store.screen([{"metric_code": "rtd21", "operator": "<", "value": 10}]).rows.collect()] == ["AAA"]
    assert store.screen(limit=1).facts["truncated"] and store.screen(industry="BANK").facts["n_rows"] == 1 and store.screen(exchange="X").facts["error"]
    assert store.screen([{"metric_code": "rtd21", "operator": "<", "value": True}]).facts["error"] and store.screen([{}]).facts["error"]
    p = store.peers(["AAA", "nope", "DED"])
    assert p.facts["unknown"] == ["NOPE"] and p.facts["no_row"] == ["DED"] and p.facts["n_rows"] == 1
    assert store.peers().facts["error"] and store.peers(["nope"]).facts["found"] is False and store.peers(industry="INS").facts["n_rows"] == 1


def test_events_tree_series(store):
    assert [r.event_type for r in store.events("AAA").rows.collect()] == ["AGM", "IPO"] and store.events("AAA", "XX").facts["error"]
    assert store.events("VNI").facts["has_data"] is False
    t = store.industries().rows.first()
    assert [x.code for x in t.industries] == ["INS", "BANK"] and store.industries(ticker="AAA").rows.first().group_code == "FIN"
    assert store.industries("BANKS").facts["suggestions"] == ["BANK"]
    s = store.series("cpi").rows.collect()
    assert [round(r.spliced, 4) for r in s] == [160.05, 160.05, 100.0]
    assert store.series("cpi", role="data").facts["found"] is False
    g = store.series("gold")
    assert g.facts["price_type"] == "sell" and [r.value for r in g.rows.collect()] == [2, 3] and store.series("btc").rows.first().value == 1.5
    assert store.series(keyword="c").facts["total"] == 2 and store.series("void").facts["n_rows"] == 0 and store.series("golds").facts["found"] is False


def test_news(store, tmp_path):
    a = store.news("lãi suất")
    assert a.facts["search"] == "cum" and [r.article_id for r in a.rows.collect()] == [1] and a.rows.first().day == D(2026, 1, 2)
    assert store.news("ngân lãi").facts["search"] == "tu_khoa" and store.news("zzz").facts["n_rows"] == 0
    assert store.news(ticker="AAA").facts["total"] == 1 and store.news(industry="BANK").facts["total"] == 1 and store.news().facts["total"] == 2
    assert store.news(group_no=9).facts["error"] and store.news(industry="XX").facts["error"] and store.news(limit=1).facts["truncated"]
    (tmp_path / "a.md").write_text("x")
    assert reference("a", str(tmp_path)).facts["text"] == "x" and reference("b", str(tmp_path)).facts["chu_de_hop_le"] == ["a"]


def test_planner():
    zone = o.ZoneInfo(o.ZONE)
    at = lambda h, m: dt.datetime(2026, 9, 4, h, m, tzinfo=zone)
    names = lambda now, runs: {j.name: why for j, why in o.due(o.SCHEDULE, now, runs)}
    assert "market.refdata" not in names(at(7, 59), []) and names(at(8, 1), [])["market.refdata"] == "mark"
    assert "market.refdata" not in names(at(9, 0), [o.Run("market.refdata", "success", at(8, 2))])
    refused = o.Run("market.refdata", "failed", at(8, 2), {"guard_refused": True})
    assert "market.refdata" not in names(at(9, 0), [refused])
    failed = o.Run("market.refdata", "failed", at(8, 2))
    assert "market.refdata" not in names(at(8, 11), [failed]) and names(at(8, 12), [failed])["market.refdata"] == "retry"
    assert "market.refdata" not in names(at(9, 0), [failed, o.Run("market.refdata", "failed", at(8, 13))])
    assert names(at(19, 0), [o.Run("market.events", "success", at(18, 15))])["market.snapshot"] == "chain" and "market.snapshot" not in names(at(19, 0), [])
    assert len(o.today([failed, o.Run("x", "success", at(8, 0), {"dry_run": True})], at(9, 0))) == 1
    r = o.Runner(most=1)
    a, b = o.SCHEDULE[0], o.SCHEDULE[1]
    r.started(a)
    assert not r.may_start(a, 0) and not r.may_start(b, 0)
    r.ended(a, 2, 100)
    assert r.may_start(b, 100) and not r.may_start(a, 101) and r.may_start(a, 701)
    assert o.resume(3, [0] * 10, 4, False) == 7 and o.resume(3, [0] * 10, 7, False) == 0 and o.resume(3, [0] * 10, 7, True) == 10


def test_schema_rules(spark):
    bad = spark.createDataFrame([(1, 2025, 9, "IS", "a", Decimal(1)), (1, 2025, 5, "IS", "a", Decimal(1)), (1, 2025, 5, "IS", "a", Decimal(2))], SCHEMAS["statement"])
    assert sorted(r.rule for r in schemas.violations(bad, "statement").collect()) == ["duplicate", "length"]


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_registered_queries_run(spark, name):
    df = plans.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.limit(1).count() == 1 and name in plans.oracle_sql()


def test_a_search_without_a_cap_shows_every_hit(spark, store):
    ids = spark.range(150)
    article = ids.selectExpr("id as article_id", "'x' as primary_source", "cast(null as timestamp) as published_at", "timestamp '2026-01-01 00:00:00' as fetched_at", "1 as group_no", "'1a' as sub")
    revision = ids.selectExpr("id as article_id", "1 as version", "'and the ' || id as title", "cast(null as string) as sapo", "'x' as content")
    w = Warehouse(store.t | {"article": article, "revision": revision})
    a = w.news("and the", most=None)
    assert {r.article_id for r in a.rows.collect()} == set(range(150)) and a.facts["n_rows"] == a.facts["total"] == 150 and not a.facts["truncated"]
    assert w.news(most=None).rows.count() == 150 and w.news("and the", limit=200).rows.count() == 100
