"""Market pages: auction results, feeds, link lists, articles.

HTML and XML have no built-in reader with these rules, so they run as Arrow-batched
functions over a column of documents; a page is one row and is read on its own.
"""

from __future__ import annotations

import html
import re
import unicodedata
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, text
from tidemark.operators import reshape
from tidemark.session import cut, small_batches, small_methods

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def decode(raw: bytes) -> str:
    """UTF-8, or UTF-16 where zero bytes give it away, composed to NFC."""
    wide = raw[:100].count(0) > 10
    return unicodedata.normalize("NFC", raw.decode("utf-16-le" if wide else "utf-8", errors="replace"))


@F.pandas_udf(T.StringType())
def decoded(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: None if b is None else decode(bytes(b)))


#: Rows and characters of a frame that a reader gives back, however many its pages hold.
FRAME_ROWS, FRAME_CHARS = 4096, 1 << 20


def in_chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Lists of bounded size of ``rows``, whose fields may be texts or lists of texts, and which are taken one by one."""
    some, chars = [], 0
    for row in rows:
        some.append(row)
        for x in row:
            if isinstance(x, str):
                chars += len(x)
            elif isinstance(x, list):
                chars += sum(map(len, x))
        if len(some) >= FRAME_ROWS or chars >= FRAME_CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


def in_frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of bounded size with ``rows``."""
    return (pd.DataFrame(some, columns=columns, dtype=object) for some in in_chunks(rows))


@lru_cache(maxsize=256)
def _selector(selector: str) -> tuple[str, str | None, frozenset[str], str, str] | None:
    """Tag, id, classes, attribute and its prefix of a compound selector."""
    m = re.fullmatch(r"([a-z0-9]*)((?:[.#][\w-]+)*)(?:\[(\w+)\^=([^\]]*)\])?", selector)
    if not m:
        return None
    named = re.findall(r"[.#][\w-]+", m[2])
    ids = {x[1:] for x in named if x[0] == "#"}
    return (m[1], next(iter(ids), None), frozenset(x[1:] for x in named if x[0] == "."), m[3] or "", m[4] or "") if len(ids) < 2 else None


@dataclass(slots=True)
class Element:
    tag: str
    attrs: dict[str, str]
    kids: list = field(default_factory=list)

    def text(self) -> str:
        if len(self.kids) == 1 and isinstance(self.kids[0], str):
            return " ".join(self.kids[0].split())
        return " ".join(" ".join(self._runs()).split())

    def _runs(self) -> Iterator[str]:
        todo = list(reversed(self.kids))
        while todo:
            k = todo.pop()
            if isinstance(k, str):
                yield k
            elif k.tag not in ("script", "style", "noscript"):
                todo += reversed(k.kids)

    def walk(self) -> Iterator[Element]:
        todo = [k for k in reversed(self.kids) if isinstance(k, Element)]
        while todo:
            k = todo.pop()
            yield k
            todo += [x for x in reversed(k.kids) if isinstance(x, Element)]

    def matches(self, selector: str) -> bool:
        """One compound selector: tag, ``#id``, ``.class``, ``[attr^=prefix]``."""
        asked = _selector(selector)
        if asked is None or (asked[0] and self.tag != asked[0]):
            return False
        _, own, classes, attr, prefix = asked
        if own is not None and self.attrs.get("id") != own:
            return False
        if classes and not (self.attrs and classes <= set(self.attrs.get("class", "").split())):
            return False
        return not attr or self.attrs.get(attr, "").startswith(prefix)

    def select(self, selectors: str) -> list[Element]:
        """Elements of any of the comma-separated selectors, whose parts may be nested by blanks."""
        out: dict[int, Element] = {}
        for s in selectors.split(","):
            scope = [self]
            for part in s.split():
                scope = [e for top in scope for e in top.walk() if e.matches(part)]
            out |= {id(e): e for e in scope}
        return list(out.values())

    def drop(self, selectors: str) -> None:
        gone = {id(e) for e in self.select(selectors)}
        for e in [self, *self.walk()]:
            e.kids = [k for k in e.kids if isinstance(k, str) or id(k) not in gone]


_BARE = re.compile(r"<(/?)([a-z][a-z0-9]*)>")
# elements whose content isn't markup, which the parser has rules for
_RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.stack = [self.root]

    def parse_starttag(self, i: int) -> int:
        bare = _BARE.match(self.rawdata, i)
        if not bare or bare[2] in _RAW:
            return super().parse_starttag(i)
        self.handle_starttag(bare[2], [])
        return bare.end()

    def parse_endtag(self, i: int) -> int:
        bare = _BARE.match(self.rawdata, i) if self.cdata_elem is None else None
        if not bare or bare[2] in _RAW:
            return super().parse_endtag(i)
        self.handle_endtag(bare[2])
        return bare.end()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        e = Element(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].kids.append(e)
        if tag not in VOID:
            self.stack.append(e)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.stack[-1].kids.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].kids.append(data)


def parse_html(page: str) -> Element:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


# --- auction results ---------------------------------------------------------

# Words of the results page.
RESULT_TITLE, KIND_HEADER = "KẾT QUẢ ĐẤU THẦU THỊ TRƯỜNG MỞ", "Loại hình giao dịch"
OPERATIONS = {"Mua kỳ hạn": "reverse_repo", "Bán kỳ hạn": "repo", "Bán hẳn": "outright_sale"}
BILLION = 10**9
_LONG_DATE, _SHORT_DATE = r"Ngày\s*(\d{1,2})\s*tháng\s*(\d{1,2})\s*năm\s*(\d{4})", rf"{RESULT_TITLE}\s*\((\d\d)\.(\d\d)\.(\d\d)\)"


class Refused(ValueError):
    """A page that isn't what its reader knows."""


# Plain rows of a table: their cells hold nothing but text without references and quotes.
_ATTRS, _TEXT = r"""(?: [a-z-]+="[^"'<>&]*+")*+""", r"""[^<>&"']*+"""
_CELLS = rf"(?:(?:<td{_ATTRS}>{_TEXT}</td>|<th{_ATTRS}>{_TEXT}</th>)\s*+)*+"
_ROWS, _ROW = re.compile(rf"(?:<tr{_ATTRS}>\s*+{_CELLS}</tr>\s*+)++"), re.compile(rf"<tr{_ATTRS}>\s*+{_CELLS}</tr>")
_CELL, _CLASS = re.compile(rf"<t[dh]{_ATTRS}>({_TEXT})<"), re.compile(r' class="([^"]*)"')
# What a page's title, dates and table are known by; a row that has any of it isn't folded.
_TELLING = (*RESULT_TITLE.split(), *KIND_HEADER.split(), "(", "ls01-date")
#: The element that stands for folded rows; its class is their number.
_FOLDED = "tidemark-rows"


@lru_cache(maxsize=1 << 14)
def _plain_row(row: str) -> tuple[tuple[str, ...], str]:
    """Cell texts and class of a plain row."""
    classes = _CLASS.findall(row, 0, row.index(">"))
    return tuple(" ".join(c.split()) for c in _CELL.findall(row)), classes[-1] if classes else ""


def _places(page: str, word: str, lo: int, hi: int) -> Iterator[int]:
    while (lo := page.find(word, lo, hi)) >= 0:
        yield lo
        lo += len(word)


def _folded(page: str) -> tuple[str, list[tuple[int, int]]]:
    """A page whose runs of plain rows each became an element, and where they stand in the page."""
    out, spans, at = [], [], 0

    def fold(lo: int, hi: int) -> None:
        nonlocal at
        words = "…" if re.compile(r">\s*+[^<\s]").search(page, lo, hi) else ""  # what is said before and after isn't joined
        out.append(f'{page[at:lo]}<{_FOLDED} class="{len(spans)}">{words}</{_FOLDED}>')
        spans.append((lo, hi))
        at = hi

    for run in _ROWS.finditer(page):
        lo = run.start()
        for told in sorted(x for word in _TELLING for x in _places(page, word, lo, run.end())):
            if told >= lo:
                if (row := page.rindex("<tr", lo, told)) > lo:
                    fold(lo, row)
                lo = page.index("</tr>", told) + 5
        if lo < run.end():
            fold(lo, run.end())
    return "".join([*out, page[at:]]), spans


def _stand_apart(root: Element, n: int) -> bool:
    """Whether the parser met ``n`` folded runs in order, none of them inside a cell or a date."""
    met, todo = [], [root]
    while todo:
        e = todo.pop()
        if e.tag == _FOLDED:
            met.append(e.attrs.get("class"))
        if e.tag not in ("td", "th") and not e.matches(".ls01-date"):
            todo += [k for k in reversed(e.kids) if isinstance(k, Element)]
    return met == [str(i) for i in range(n)]


def result_cells(page: str) -> Iterator[tuple[int, list[str], str]]:
    """A results page as plain rows: at -1 its words and the words of its date elements, then the
    non-empty rows of the first table with the header word, as cell texts with the row's class.

    Runs of plain rows are read by a pattern, the rest of the page by the parser; folded rows
    whose words tell nothing about the page stand as ``…`` among its words.  A page in which
    the parser doesn't meet every run as an element outside cells and dates is parsed as a whole."""
    short, spans = _folded(page)
    root = parse_html(short)
    dated = root.select(".ls01-date")
    if _FOLDED in page or not _stand_apart(root, len(spans)):
        root, spans = parse_html(page), []
        dated = root.select(".ls01-date")
    yield -1, [root.text(), "\n".join(e.text() for e in dated)], ""

    def rows(table: Element) -> Iterator[tuple[list[str], str]]:
        for e in table.walk():
            if e.tag == "tr":
                yield [c.text() for c in e.kids if isinstance(c, Element) and c.tag in ("td", "th")], e.attrs.get("class", "")
            elif spans and e.tag == _FOLDED:
                for m in _ROW.finditer(page, *spans[int(e.attrs["class"])]):
                    cells, mark = _plain_row(m[0])
                    yield list(cells), mark

    table, at = next((t for t in root.select("table") if KIND_HEADER in t.text()), Element("", {})), 0
    for cells, mark in rows(table):
        if any(cells):
            yield at, cells, mark
            at += 1


def in_groups(rows: Iterator[tuple[int, list[str], str]]) -> Iterator[tuple[int, list[str], str, str | None, bool]]:
    """Rows of a results page with the label of the group that they stand under, and whether they open it."""
    under = None
    for at, cells, mark in rows:
        label = cells[0] if cells else ""
        opens = (label in OPERATIONS or "ls01-group" in mark and "ls01-group" in re.split(r"\s+", mark, flags=re.ASCII)) and at >= 0 and not any(KIND_HEADER in c for c in cells)
        under = label if opens else under
        yield at, cells, mark, under, opens


def _session_date(words: Column, dated: Column) -> Column:
    """The day of a date element in long form, else the short form after the title; null if there is none."""
    part = lambda x, pattern, i: F.regexp_extract(x, pattern, i)
    long = F.concat_ws("-", part(dated, _LONG_DATE, 3), F.lpad(part(dated, _LONG_DATE, 2), 2, "0"), F.lpad(part(dated, _LONG_DATE, 1), 2, "0"))
    short = F.concat(F.lit("20"), F.concat_ws("-", *[part(words, _SHORT_DATE, i) for i in (3, 2, 1)]))
    return F.coalesce(F.when(dated.rlike(_LONG_DATE), long), F.when(words.rlike(_SHORT_DATE), short)).try_cast("date")


def auctions(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged auction rows of ``page_id``, ``body`` pages, and refused pages with their ``error``.

    Pages are read into cells, row by row under their groups, by a function; what a row
    is, totals and refusals are columns and aggregations.  Rows are aggregated where they
    are read, so what moves follows groups and tenors, not rows.
    Any unknown row, group or header refuses its page, and so does a group whose rows
    don't add up to its published total.  Rows of one tenor are two rounds of a day
    and are merged: volumes and, where all are known, counts add up; rates that
    differ are refused.
    """
    kinds = {"page_id": pa.string(), "at": pa.int32(), "cells": pa.list_(pa.string()), "mark": pa.string(), "under": pa.string(), "opens": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = ((b.column(0)[i].as_py(), b.column(1)[i].as_py() or "") for b in batches for i in range(b.num_rows))  # a page at a time
        rows = ((page_id, *row) for page_id, body in read for row in in_groups(result_cells(body)))
        for some in in_chunks(rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds.values(), strict=True)], list(kinds))

    small_batches(pages.sparkSession, rows=16)
    cells = pages.select(F.col("page_id").cast("string").alias("page_id"), "body").mapInArrow(run, "page_id string, at int, cells array<string>, mark string, under string, opens boolean")
    cell = lambda i: F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
    label, filled = cell(0), lambda i: F.when(cell(i) != "", cell(i))
    names = F.create_map(*[F.lit(x) for kv in OPERATIONS.items() for x in kv])
    marked = lambda c: F.col("mark").contains(c) & F.array_contains(F.split("mark", r"\s+"), c)
    # the first rule that holds says what a row is
    rules = {
        "page": F.col("at") < 0,
        "header": F.array_join("cells", "\n").contains(KIND_HEADER),
        "group": F.col("opens"),
        "total": marked("ls01-total") | label.rlike("^[- ]*Tổng"),
        "tenor": label.rlike(r"\d\s*ngày"),
    }
    what = F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()], F.lit("odd"))
    named = F.when(F.col("under").isNotNull(), F.coalesce(names[F.col("under")], F.lit("?")))
    rows = cells.select("*", what.alias("what"), named.alias("op_type"), text.parse_number(filled(2)).alias("volume_bn"), text.parse_number(filled(3)).alias("rate"))
    is_ = lambda *kinds: F.col("what").isin(*kinds)
    error = (
        F.when(is_("page") & ~cell(0).contains(RESULT_TITLE), "no title")
        .when(is_("page") & _session_date(cell(0), cell(1)).isNull(), "no session date")
        .when(is_("header") & (F.size("cells") != 4), F.concat(F.size("cells").cast("string"), F.lit(" columns")))
        .when(is_("group") & (F.col("op_type") == "?"), F.concat(F.lit("unknown group "), label))
        .when(is_("total", "tenor", "odd") & F.col("op_type").isNull(), F.concat(F.lit("a row before any group: "), label))
        .when(is_("odd"), F.concat(F.lit("unknown row "), label))
        .when(is_("tenor") & F.col("volume_bn").isNull() | is_("total") & filled(2).isNotNull() & F.col("volume_bn").isNull() | is_("tenor") & filled(3).isNotNull() & F.col("rate").isNull(), F.concat(F.lit("no number: "), F.concat_ws(" ", "cells")))
    )
    took = lambda i: F.when(is_("tenor") & cell(1).contains("/"), F.get(F.split(cell(1), "/"), F.lit(i)).try_cast("int"))
    day = F.when(is_("page"), _session_date(cell(0), cell(1)))
    tenor = F.when(is_("tenor"), F.regexp_extract(label, r"(\d+)\s*ngày", 1)).cast("int")
    total = F.when(is_("total"), F.col("volume_bn"))
    rows = rows.select("page_id", "at", "what", "op_type", error.alias("error"), day.alias("session_date"), tenor.alias("tenor_days"), total.alias("total"), F.when(is_("tenor"), F.col("volume_bn")).alias("summed"), took(0).alias("participants"), took(1).alias("winners"), F.when(is_("tenor"), F.col("rate").cast("decimal(28,10)")).alias("rate"))
    # one aggregation of the rows, with errors and totals as keys, so that it holds numbers alone
    facts = [F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.bool_or(is_("header")).alias("header"), F.bool_or(is_("tenor")).alias("rows"), F.max("session_date").alias("session_date")]
    groups = rows.groupBy("page_id", "op_type", "tenor_days", "error", "total").agg(*facts, *reshape.merging(["summed"], ["participants", "winners"], "rate"))
    with small_methods(pages.sparkSession):
        groups = cut(groups, "auction-groups")
    per = groups.groupBy("page_id").agg(F.min_by("error", F.when(F.col("error").isNotNull(), F.col("first_at"))).alias("first"), F.bool_or("header").alias("header"), F.bool_or("rows").alias("rows"), F.max("session_date").alias("session_date"))
    sums = groups.groupBy("page_id", "op_type").agg(F.sum("summed").alias("summed"), F.max_by("total", F.when(F.col("total").isNotNull(), F.col("last_at"))).alias("total"))
    off = sums.where("summed <> total").groupBy("page_id").agg(F.concat(F.lit("rows don't add up to their total: "), F.min("op_type")).alias("off"))
    merged = groups.where("rows and error is null").select("page_id", "op_type", "tenor_days", F.col("summed").alias("volume_bn"), "participants", "winners", "rate", "clash")
    clash = merged.where("clash").select("page_id", F.lit("rows of one tenor differ in rate").alias("clash")).distinct()
    judged = per.join(off, "page_id", "left").join(clash, "page_id", "left")
    gone = F.when(~F.col("header"), "no header").when(~F.col("rows"), "no rows")
    judged = judged.select("page_id", "session_date", F.coalesce("first", gone, "off", "clash").alias("error"))
    good = merged.join(judged.where("error is null"), "page_id")
    good = good.select("page_id", "session_date", "op_type", "tenor_days", F.col("participants").cast("int").alias("participants"), F.col("winners").cast("int").alias("winners"), (F.col("volume_bn") * BILLION).cast("decimal(38,2)").alias("volume_vnd"), F.col("rate").alias("rate_pct"))
    return good, judged.where("error is not null").select("page_id", "error")


SEED = "session_date date, tenor_days int, participants int, winners int, volume_bn decimal(20,6), rate decimal(12,8)"


def auction_seed(spark, path: str) -> DataFrame:
    """The seed file (its header must match), volumes in units and rates in percent, tenors merged."""
    rows = spark.read.csv(path, schema=SEED, header=True, enforceSchema=False, mode="FAILFAST")
    scaled = rows.select("session_date", "tenor_days", "participants", "winners", (F.col("volume_bn") * BILLION).cast("decimal(38,2)").alias("volume_vnd"), (F.col("rate") * 100).alias("rate_pct"))
    return reshape.merge_same(scaled, ["session_date", "tenor_days"], ["volume_vnd"], ["participants", "winners"], "rate_pct")


# --- feeds -------------------------------------------------------------------


def feed_items(body: str, kind: str, base: str = "", article: str = "") -> Iterator[dict]:
    """Items of a document: ``rss``, ``sitemap`` (addresses that match ``article``) or ``links`` (ditto).

    A refused document gives none: it is parsed as a whole before its first item."""
    if kind == "links":
        urls = dict.fromkeys(urljoin(base, e.attrs["href"].strip()) for e in parse_html(body).select("a") if e.attrs.get("href"))
        out = ({"url": u} for u in urls if re.search(article, u))
    else:
        try:
            root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", body))
        except ET.ParseError as e:
            raise Refused(f"broken XML: {e}") from e
        local = lambda e: e.tag.rpartition("}")[2]
        fields = ({local(k): (k.text or "").strip() for k in e} for e in root.iter() if local(e) == ("item" if kind == "rss" else "url"))
        if kind == "rss":
            out = ({"url": f["link"], "title": html.unescape(f.get("title", "")), "summary": f.get("description") or None, "published": f.get("pubDate")} for f in fields if f.get("link"))
        else:
            out = ({"url": f["loc"], "published": f.get("lastmod")} for f in fields if re.search(article, f.get("loc", "")))
    first = next(out, None)
    if first is None:
        raise Refused("no items")
    yield first
    yield from out


_FEED = "feed string, url string, title string, summary string, published string, error string"


def feeds(docs: DataFrame) -> DataFrame:
    """Items of feeds (``feed``, ``kind``, ``base``, ``article``, ``body``), one per canonical address.

    Adds ``canonical``, ``published_at`` (of the feed, else of the address) and
    ``ticker`` of filings; a refused feed is one row with its ``error``.
    """

    names = [x.split()[0] for x in _FEED.split(", ")]

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for i in range(b.num_rows):
                feed, kind, base, article, body = (c[i].as_py() for c in b.columns)  # a document at a time
                try:
                    for x in feed_items(body, kind, base or "", article or ""):
                        yield tuple(map(({"feed": feed} | x).get, names))
                except Refused as e:
                    yield tuple(map({"feed": feed, "error": str(e)}.get, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in in_chunks(items(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some, strict=True)], names)

    small_batches(docs.sparkSession, rows=64, mb=2)

    rows = docs.select(*[F.col(c).cast("string").alias(c) for c in ("feed", "kind", "base", "article", "body")]).mapInArrow(run, _FEED)
    typed = rows.select("*", text.canonical_url(F.col("url")).alias("canonical"), F.coalesce(dates.feed_time(F.col("published")), dates.time_in_url(F.col("url"))).alias("published_at"), text.ticker_of_url(F.col("url")).alias("ticker"))
    return typed.dropDuplicates(["feed", "canonical", "error"])


# --- articles ----------------------------------------------------------------


@dataclass(frozen=True)
class ArticleRule:
    container: str
    title: str
    drop: tuple[str, ...] = ()
    summary: str | None = None
    least: int = 200


def article(page: str, rule: ArticleRule) -> dict:
    """Title, summary and text of a page by a source's rule."""
    root = parse_html(page)
    found, title = root.select(rule.container), root.select(rule.title)
    if not found:
        raise Refused("no container")
    if not title or not title[0].text():
        raise Refused("no title")
    summary = root.select(rule.summary) if rule.summary else []
    out = {"title": title[0].text(), "summary": summary[0].text() or None if summary else None}
    for s in rule.drop:
        found[0].drop(s)
    out["content"] = unicodedata.normalize("NFC", found[0].text())
    if len(out["content"]) < rule.least:
        raise Refused("too short")
    return out


def articles(pages: DataFrame, rules: dict[str, ArticleRule]) -> DataFrame:
    """``url``, ``title``, ``summary``, ``content`` or ``error`` of ``url``, ``rule``, ``body`` pages."""

    names = ["url", "title", "summary", "content", "error"]

    def items(parts: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for r in (r for part in parts for r in part.itertuples(index=False)):
            try:
                found = {"url": r.url} | article(r.body, rules[r.rule])
            except (Refused, KeyError) as e:
                found = {"url": r.url, "error": str(e)}
            yield tuple(map(found.get, names))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from in_frames(items(parts), names)

    small_batches(pages.sparkSession, rows=256)

    return pages.select("url", "rule", "body").mapInPandas(run, "url string, title string, summary string, content string, error string")
