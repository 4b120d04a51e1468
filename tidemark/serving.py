"""Read functions over a warehouse of DataFrames.

Each function validates its arguments, narrows the tables and returns an
:class:`Answer`: a ``rows`` DataFrame where there are data, and the facts that go
with it.  ``Answer.to_json`` gives the wire form with the wire's field names.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import grams, ordering, postings, series
from tidemark.sources import sidecar

# Wire names of the facts.
WIRE = {
    "found": "tim_thay", "has_data": "co_du_lieu", "n_rows": "so_dong", "rows": "du_lieu", "range": "khoang_co_du_lieu", "error": "loi", "reason": "ly_do", "asked": "ma_da_tra",
    "suggestions": "goi_y", "kind": "loai", "ticker": "ma", "truncated": "da_cat", "total": "tong_khop", "unknown": "khong_tim_thay", "no_row": "khong_co_du_lieu_phien", "search": "kieu_tim", "day": "ngay_du_lieu",
    "price_type": "loai_gia", "price_types": "cac_loai_gia_co_san", "inputs_cut": "da_cat_dau_vao", "metrics_cut": "da_cat_chi_tieu", "unit": "don_vi", "name": "ten",
}
STATEMENTS, PERIODS, EXCHANGES = ("IS", "BS", "CF"), {"nam": (5,), "quy": (1, 2, 3, 4)}, ("HOSE", "HNX", "UPCOM")
EVENT_TYPES = ("Earning", "AGM", "CashDividend", "ShareIssuance", "StockDividend", "IPO")
DEFAULT_METRICS = {"IS": "isa3 isa9 isa10 isa16 isa20 isa22 isa23".split(), "BS": "bsa1 bsa2 bsa53 bsa54 bsa78 bsa96".split(), "CF": ["cfa18"]}
RATIOS = "rtd11 rtd14 rtd21 rtd25 rtd7 rtq12 rtq14".split()
METRICS = frozenset([*RATIOS, *(m for ms in DEFAULT_METRICS.values() for m in ms)])
OPERATORS = (">", "<", ">=", "<=", "=")


@dataclass
class Answer:
    facts: dict = field(default_factory=dict)
    rows: DataFrame | None = None

    def to_json(self) -> str:
        out = {WIRE.get(k, k): v for k, v in self.facts.items()}
        if self.rows is not None:
            out[WIRE["rows"]] = [r.asDict(recursive=True) for r in self.rows.collect()]
        return json.dumps(out, ensure_ascii=False, default=str)


def bad(reason: str, **valid) -> Answer:
    return Answer({"error": True, "reason": reason} | valid)


def unknown(asked: str, suggestions: Sequence[str]) -> Answer:
    return Answer({"found": False, "asked": asked, "suggestions": list(suggestions)})


def no_such_data(kind: str, reason: str, **more) -> Answer:
    return Answer({"found": True, "has_data": False, "kind": kind, "reason": reason} | more)


def empty(low=None, high=None, **more) -> Answer:
    known = {"range": {"tu": str(low), "den": str(high)}} if low is not None else {}
    return Answer({"found": True, "has_data": True, "n_rows": 0} | known | more)


def data(rows: DataFrame, n: int, **more) -> Answer:
    return Answer({"found": True, "has_data": True, "n_rows": n} | more, rows)


def check_day(value: str | None, name: str) -> Answer | None:
    """Null or ``YYYY-MM-DD``; anything else is an error of shape."""
    if value is None:
        return None
    try:
        if isinstance(value, str) and len(value) == 10:
            date.fromisoformat(value)
            return None
    except ValueError:
        pass
    return bad(f"{name}: YYYY-MM-DD, not {value!r}", dinh_dang_hop_le="YYYY-MM-DD")


def between(rows: DataFrame, column: str, low: str | None, high: str | None) -> DataFrame:
    if low is not None:
        rows = rows.where(F.col(column) >= F.lit(low).cast("date"))
    return rows if high is None else rows.where(F.col(column) <= F.lit(high).cast("date"))


def _range(rows: DataFrame, column: str) -> tuple:
    return tuple(rows.agg(F.min(column), F.max(column)).first())


class Warehouse:
    """Tables by name: ``security issuer industry issuer_industry price_daily statement screener
    event indicator observation break asset asset_price asset_ohlc article revision article_ticker
    article_industry metric``."""

    def __init__(self, tables: dict[str, DataFrame], index: postings.Index | None = None, names: grams.Grams | None = None):
        """``index`` holds the revisions' texts (title, sapo and content), ``names`` the listed
        securities' tickers and short names; without them, a search scans the tables.  The
        table ``screener_metrics``, if there is one, has the payloads' metrics as columns."""
        self.t, self.index, self.names = tables, index, names

    def resolve(self, ticker: str) -> dict | Answer:
        """The security of a ticker, listed before others; else up to five similar listed tickers."""
        found = self.t["security"].where(F.upper("ticker") == ticker.upper()).orderBy((F.col("status") == "listed").desc(), "security_id").first()
        if found is not None:
            return found.asDict()
        if self.names is not None:
            found = self.names.similar(ticker, 0.3).select(F.col("id").alias("security_id")).distinct()
            near = self.t["security"].join(found, "security_id")
            # a similarity of the ticker at or below the bound ranks as it is, so it is computed for the few that are left
            sim = text.similarity(text.trigrams(F.col("ticker")), text.trigrams(F.lit(ticker)))
            return unknown(ticker, [r[0] for r in near.orderBy(sim.desc(), "ticker").select("ticker").limit(5).collect()])
        asked = text.trigrams(F.lit(ticker))
        rows = self.t["security"].where("status = 'listed'").join(self.t["issuer"].select("issuer_id", "short_name"), "issuer_id", "left")
        sim = text.similarity(text.trigrams(F.col("ticker")), asked)
        near = rows.where((sim > 0.3) | (text.similarity(text.trigrams(F.coalesce("short_name", F.lit(""))), asked) > 0.3))
        return unknown(ticker, [r[0] for r in near.orderBy(sim.desc(), "ticker").select("ticker").limit(5).collect()])

    def _industry_error(self, code: str | None) -> Answer | None:
        if code is None:
            return None
        codes = [r[0] for r in self.t["industry"].where("level = 2").select("code").orderBy("code").collect()]  # a closed list of 24
        return None if code in codes else bad(f"no industry {code!r}", industry_code_hop_le=codes)

    def prices(self, ticker: str, from_date: str | None = None, to_date: str | None = None, adjusted: bool = True, most: int = 2000) -> Answer:
        if error := check_day(from_date, "from_date") or check_day(to_date, "to_date"):
            return error
        s = self.resolve(ticker)
        if isinstance(s, Answer):
            return s
        if s["security_type"] != "stock" or s["status"] == "delisted":
            return no_such_data(s["security_type"], "no daily prices of this security", ticker=s["ticker"])
        own = self.t["price_daily"].where(F.col("security_id") == s["security_id"])
        rows = between(own, "trading_date", from_date, to_date)
        total = rows.count()
        if not total:
            return empty(*_range(own, "trading_date"), ticker=s["ticker"])
        close = F.col("close_adj" if adjusted else "close_raw").alias("close")
        rows = ordering.recent(rows.select("trading_date", close, "open_value", "highest_value", "lowest_value"), ["trading_date"], most)
        return data(rows, min(total, most), ticker=s["ticker"], total=total, truncated=total > most)

    def financials(self, ticker: str, statement: str = "IS", from_year: int | None = None, to_year: int | None = None, period: str = "nam", codes: Sequence[str] | None = None, most: int = 20) -> Answer:
        if statement not in STATEMENTS:
            return bad(f"no statement {statement!r}", statement_type_hop_le=list(STATEMENTS))
        if period not in PERIODS:
            return bad(f"no period {period!r}", period_hop_le=list(PERIODS))
        codes = list(codes or DEFAULT_METRICS[statement])
        if odd := [c for c in codes if c not in METRICS]:
            return bad(f"unknown metrics {odd}", ma_hop_le=sorted(METRICS))
        s = self.resolve(ticker)
        if isinstance(s, Answer):
            return s
        if s["security_type"] != "stock":
            return no_such_data(s["security_type"], "no statements of this security", ticker=s["ticker"])
        own = self.t["statement"].where((F.col("issuer_id") == s["issuer_id"]) & (F.col("statement_type") == statement) & F.col("length_report").isin(*PERIODS[period]) & F.col("metric_code").isin(*codes))
        rows = own
        if from_year is not None:
            rows = rows.where(F.col("year_report") >= from_year)
        if to_year is not None:
            rows = rows.where(F.col("year_report") <= to_year)
        units = self.t["metric"].where("dictionary = 'field_dictionary'").select(F.col("code").alias("metric_code"), "unit")
        rows = rows.join(units, "metric_code", "left").where("value is not null and unit is not null")
        per = rows.groupBy("year_report", "length_report").agg(F.array_sort(F.collect_list(F.struct("metric_code", "value", "unit"))).alias("metrics"))
        newest = per.orderBy(F.col("year_report").desc(), F.col("length_report").desc())
        n = newest.limit(most + 1).count()
        if not n:
            return empty(*_range(own, "year_report"), ticker=s["ticker"])
        return data(newest.limit(most), min(n, most), ticker=s["ticker"], truncated=n > most)

    def _metric(self, code: str) -> Column:
        return F.col(code) if "screener_metrics" in self.t else sidecar.metric(code)

    def _session(self) -> tuple[DataFrame | None, date | None]:
        """The latest session's rows of listed securities, with their industry."""
        screener = self.t.get("screener_metrics", self.t["screener"])
        day = screener.agg(F.max("trading_date")).first()[0]
        if day is None:
            return None, None
        rows = screener.where(F.col("trading_date") == F.lit(day)).join(self.t["security"].where("status = 'listed'"), "security_id")
        industry = self.t["industry"].select("industry_id", F.col("code").alias("industry"), F.col("name_vi").alias("industry_name"))
        return rows.join(self.t["issuer_industry"].select("issuer_id", "industry_id"), "issuer_id", "left").join(industry, "industry_id", "left"), day

    def screen(self, criteria: Sequence[dict] = (), industry: str | None = None, exchange: str | None = None, sort_by: str | None = None, limit: int | None = None) -> Answer:
        if odd := [repr(c) for c in criteria if not isinstance(c, dict) or not {"metric_code", "operator", "value"} <= c.keys()]:
            return bad("a criterion has metric_code, operator and value", tieu_chi_loi=odd)
        asked = [c["metric_code"] for c in criteria] + ([sort_by] if sort_by else [])
        if odd := [c for c in asked if not isinstance(c, str) or c not in METRICS]:
            return bad(f"unknown metrics {odd}", ma_hop_le=sorted(METRICS))
        for c in criteria:
            if c["operator"] not in OPERATORS:
                return bad(f"unknown operator {c['operator']}", toan_tu_hop_le=sorted(OPERATORS))
            if isinstance(c["value"], bool) or not isinstance(c["value"], (int, float)):
                return bad(f"value must be a number, not {c['value']!r}")
        if exchange and exchange not in EXCHANGES:
            return bad(f"no exchange {exchange!r}", exchange_hop_le=list(EXCHANGES))
        if error := self._industry_error(industry):
            return error
        rows, day = self._session()
        if rows is None:
            return empty()
        if industry:
            rows = rows.where(F.col("industry") == industry)
        if exchange:
            rows = rows.where(F.col("exchange") == exchange)
        for c in criteria:
            m, v = self._metric(c["metric_code"]), sidecar.literal(c["value"]) if "screener_metrics" in self.t else F.lit(c["value"])
            rows = rows.where({">": m > v, "<": m < v, ">=": m >= v, "<=": m <= v, "=": m == v}[c["operator"]])
        sort, n = sort_by or "rtd11", ordering.limit_of(limit, 30, 200)
        shown = list(dict.fromkeys([sort, *(c["metric_code"] for c in criteria), *RATIOS]))
        best = ordering.top(rows.select("ticker", "exchange", "industry_name", *[self._metric(c).alias(c) for c in shown]), sort, ["ticker"], n + 1)
        have = best.count()
        return data(best.limit(n), min(have, n), day=str(day), truncated=have > n) if have else empty(day=str(day))

    def peers(self, tickers: Sequence[str] = (), codes: Sequence[str] = (), industry: str | None = None, most: int = 25) -> Answer:
        codes = list(codes) or RATIOS
        if odd := [c for c in codes if c not in METRICS]:
            return bad(f"unknown metrics {odd}", ma_hop_le=sorted(METRICS))
        if not tickers and not industry:
            return bad("tickers or industry_code")
        if error := self._industry_error(industry):
            return error
        asked = list(dict.fromkeys(t.upper() for t in tickers))
        more: dict = {"metrics_cut": True} if len(codes) > 15 else {}
        more |= {"inputs_cut": True} if len(asked) > 100 else {}
        codes, asked = codes[:15], asked[:100]
        known = [r[0] for r in self.t["security"].where(F.upper("ticker").isin(*asked)).select(F.upper("ticker")).distinct().collect()] if asked else []
        lost = [t for t in asked if t not in known]
        more |= {"unknown": lost} if lost else {}
        if asked and not known:
            return Answer({"found": False} | more)
        kept = [t for t in asked if t in known][:most]
        rows, day = self._session()
        if rows is None:
            return empty(**more)
        if kept:
            rows = rows.where(F.upper("ticker").isin(*kept))
        if industry:
            rows = rows.where(F.col("industry") == industry)
        best = rows.select("ticker", "industry_name", *[self._metric(c).alias(c) for c in codes]).orderBy("ticker").limit(most + 1)
        seen = [r[0] for r in best.select("ticker").collect()]
        missing = sorted(set(kept) - {t.upper() for t in seen})
        more |= {"no_row": missing} if missing else {}
        if not seen:
            return empty(day=str(day), **more)
        return data(best.limit(most), min(len(seen), most), day=str(day), truncated=len(seen) > most or len(known) > most, **more)

    def events(self, ticker: str, event_type: str | None = None, from_date: str | None = None, to_date: str | None = None, limit: int | None = None) -> Answer:
        if event_type and event_type not in EVENT_TYPES:
            return bad(f"no event type {event_type!r}", loai_hop_le=list(EVENT_TYPES))
        if error := check_day(from_date, "from_date") or check_day(to_date, "to_date"):
            return error
        s = self.resolve(ticker)
        if isinstance(s, Answer):
            return s
        if s["issuer_id"] is None:
            return no_such_data(s["security_type"], "no issuer is known for this security", ticker=s["ticker"])
        own = self.t["event"].where(F.col("issuer_id") == s["issuer_id"])
        own = own.where(F.col("event_type") == event_type) if event_type else own
        n = ordering.limit_of(limit, 30, 200)
        rows = between(own, "public_date", from_date, to_date).orderBy(F.col("public_date").desc_nulls_last(), "event_type").limit(n + 1)
        have = rows.count()
        return data(rows.limit(n), min(have, n), ticker=s["ticker"], truncated=have > n) if have else empty(*_range(own, "public_date"), ticker=s["ticker"])

    def industries(self, code: str | None = None, ticker: str | None = None) -> Answer:
        ind = self.t["industry"]
        par = ind.select(F.col("industry_id").alias("parent_id"), F.col("code").alias("group_code"), F.col("name_vi").alias("group_name"), F.col("sort_order").alias("group_order"))
        leaves = ind.where("level = 2").join(par, "parent_id")
        if ticker:
            s = self.resolve(ticker)
            if isinstance(s, Answer):
                return s
            own = self.t["issuer_industry"].where(F.col("issuer_id") == s["issuer_id"]).join(leaves, "industry_id").select("code", "name_vi", "group_code", "group_name", "source")
            return data(own, 1, ticker=s["ticker"]) if not own.isEmpty() else no_such_data(s["security_type"], "no industry is assigned", ticker=s["ticker"])
        rows = leaves if code is None else leaves.where((F.col("code") == code) | (F.col("group_code") == code))
        if code is not None and rows.isEmpty():
            sim = text.similarity(text.trigrams(F.col("code")), text.trigrams(F.lit(code)))
            near = ind.where((sim > 0.3) | (text.similarity(text.trigrams(F.col("name_vi")), text.trigrams(F.lit(code))) > 0.3))
            return unknown(code, [r[0] for r in near.orderBy(sim.desc(), "code").select("code").limit(5).collect()])
        tree = rows.groupBy("group_order", "group_code", "group_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("sort_order", "code", "name_vi"))), lambda x: F.struct(x["code"].alias("code"), x["name_vi"].alias("name"))).alias("industries"))
        return data(tree.orderBy("group_order").drop("group_order"), rows.count())

    def catalogue(self, keyword: str | None = None, most: int = 250) -> Answer:
        pick = lambda t, kind: self.t[t].select("code", F.col("name_vi").alias("name"), "unit", F.lit(kind).alias("kind"))
        rows = pick("indicator", "macro").unionByName(pick("asset", "asset"))
        if keyword:
            rows = rows.where(F.col("code").ilike(f"%{keyword}%") | F.col("name").ilike(f"%{keyword}%"))
        total = rows.count()
        return Answer({"total": total, "truncated": total > most}, rows.orderBy("code").limit(most))

    def series(self, code: str | None = None, keyword: str | None = None, from_date: str | None = None, to_date: str | None = None, limit: int | None = None, role: str | None = None) -> Answer:
        """A macro series as spliced, or an asset's one price type (the commonest), else its closes.

        ``role`` narrows indicators; by default all roles are readable.
        """
        if error := check_day(from_date, "from_date") or check_day(to_date, "to_date"):
            return error
        if not code:
            return self.catalogue(keyword)
        n = ordering.limit_of(limit, 120, 2000)

        def newest(rows: DataFrame, columns: Sequence[str], **more) -> Answer | None:
            inside = between(rows, "obs_date", from_date, to_date).select("obs_date", *columns)
            have = inside.limit(n + 1).count()
            return data(ordering.recent(inside, ["obs_date"], n), min(have, n), ticker=code, truncated=have > n, **more) if have else None

        wanted = self.t["indicator"].where(F.col("code") == code)
        ind = (wanted if role is None else wanted.where(F.col("role") == role)).first()
        if ind is not None:
            own = self.t["observation"].where(F.col("indicator_id") == ind["indicator_id"])
            breaks = self.t["break"].where(F.col("indicator_id") == ind["indicator_id"])
            spliced = series.splice(own, breaks, "indicator_id", "obs_date", "value")
            return newest(spliced, ["spliced", "value"], name=ind["name_vi"], unit=ind["unit"]) or empty(*_range(own, "obs_date"), ticker=code)
        asset = self.t["asset"].where(F.col("code") == code).first()
        if asset is None:
            near = self.catalogue(code[:6]).rows.limit(5).collect()
            return unknown(code, [r["code"] for r in near])
        own = self.t["asset_price"].where(F.col("asset_id") == asset["asset_id"])
        types = between(own, "obs_date", from_date, to_date).groupBy("price_type").count().orderBy(F.col("count").desc(), "price_type").collect()  # a few types
        facts = {"name": asset["name_vi"], "unit": asset["unit"]}
        if types:
            return newest(own.where(F.col("price_type") == types[0]["price_type"]), ["value"], price_type=types[0]["price_type"], price_types=[t["price_type"] for t in types], **facts)
        ohlc = self.t["asset_ohlc"].where(F.col("asset_id") == asset["asset_id"])
        found = newest(ohlc.withColumn("value", F.col("close")), ["value"], **facts)
        return found or empty(*_range(own.select("obs_date").unionAll(ohlc.select("obs_date")), "obs_date"), ticker=code)

    def news(self, query: str | None = None, ticker: str | None = None, group_no: int | None = None, sub: str | None = None, industry: str | None = None, from_date: str | None = None, to_date: str | None = None, limit: int | None = None, most: int | None = 100) -> Answer:
        """Latest revisions: by phrase, else by all words; newest first, or by rank where there is a query.

        At most ``most`` are shown, whatever the ``limit``; ``most`` of None shows all, in no order."""
        if group_no is not None and group_no not in (1, 2, 3):
            return bad(f"no group {group_no}", group_no_hop_le=[1, 2, 3])
        if error := check_day(from_date, "from_date") or check_day(to_date, "to_date") or self._industry_error(industry):
            return error
        a = self.t["article"].withColumn("day", dates.local_date(F.coalesce("published_at", "fetched_at")))
        if ticker:
            s = self.resolve(ticker)
            if isinstance(s, Answer):
                return s
            tagged = self.t["article_ticker"].where(F.col("security_id") == s["security_id"])
            a = a.join(tagged.select("article_id"), "article_id", "left_semi")
        if industry:
            tags = self.t["article_industry"].join(self.t["industry"].where(F.col("code") == industry), "industry_id")
            a = a.join(tags.select("article_id"), "article_id", "left_semi")
        a = a.where(F.col("group_no") == group_no) if group_no is not None else a
        a = a.where(F.col("sub") == sub) if sub else a
        newest = self.t["revision"].groupBy("article_id").agg(F.max_by(F.struct("title", "sapo", "content"), "version").alias("r")).select("article_id", "r.*")
        rows = between(a, "day", from_date, to_date).join(newest, "article_id")
        n, order = ordering.limit_of(limit, 15, most) if most is not None else None, [F.col("day").desc(), F.col("article_id").desc()]
        columns = ("article_id", "day", "primary_source", "group_no", "sub", "title", "sapo")
        if query:
            words = [w for w in "".join(c.lower() if c.isalnum() else " " for c in _plain(query)).split() if w]
            for how in ("cum", "tu_khoa"):
                hits = self._hits(rows, words, how == "cum")
                if not hits.rows.isEmpty():
                    break
            else:
                return empty(total=0, search="cum")
            total = hits.rows.count()
            if n is None:
                return data(hits.rows.select(*columns), total, total=total, truncated=False, search=how)
            shown = hits.top(n, *order).select(*columns)
            return data(shown, min(total, n), total=total, truncated=total > n, search=how)
        total = rows.count()
        if not total:
            return empty(*_range(a, "day"))
        if n is None:
            return data(rows.select(*columns), total, total=total, truncated=False)
        shown = rows.orderBy(*order).limit(n).select(*columns)
        return data(shown, min(total, n), total=total, truncated=total > n)

    def _hits(self, rows: DataFrame, words: list[str], phrase: bool) -> postings.Hits:
        """Those of the articles ``rows`` that have all words, by the index or by a scan."""
        if self.index is not None:
            hits = self.index.search(words, phrase)
            return postings.Hits(rows.join(hits.rows.withColumn("article_id", F.col("id")), "article_id"), hits.tokens)
        tokens = text.tokens(text.unaccent(F.concat_ws(" ", "title", "sapo", "content")))
        rows = rows.select("*", F.col("article_id").alias("id"), tokens.alias("words"))
        rows = rows.where((text.matches_phrase if phrase else text.matches_all)(F.col("words"), words))
        own = sorted(set(words))
        return postings.Hits(rows.withColumns({f"p{i}": postings.places_of(F.col("words"), w) for i, w in enumerate(own)}), own)


def _plain(query: str) -> str:
    return query.translate(str.maketrans(text.ACCENTED + text.STRUCK, text.PLAIN + text.UNSTRUCK))


def reference(topic: str, folder: str) -> Answer:
    """A knowledge document of a folder by its name; unknown topics list the known ones."""
    from pathlib import Path

    known = {p.stem: p for p in sorted(Path(folder).glob("*.md"))}
    if topic not in known:
        return bad(f"no topic {topic!r}", chu_de_hop_le=list(known))
    return Answer({"found": True, "topic": topic, "text": known[topic].read_text(encoding="utf-8")})
