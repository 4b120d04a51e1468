"""Operators whose cases need files, locks or refusals."""

from __future__ import annotations

import datetime as dt
import gzip
import json
from pathlib import Path

import pytest

from tidemark.functions import text
from tidemark.operators import classified, guards
from tidemark.session import shared_dir
from tidemark.sources import frames, ledger, pages, snapshots


def test_a_job_runs_once_at_a_time(spark, tmp_path):
    book = ledger.Ledger(spark, f"file://{tmp_path}")
    first = book.open_run("omo")
    with pytest.raises(ledger.Busy):
        book.open_run("omo")
    other = book.open_run("price")
    book.close_run(first, "omo", "success", {"rows": "5"})
    book.close_run(first, "omo", "failed", error="after the write")  # stats stay, the later status counts
    again = book.open_run("omo")
    runs = {r.run_id: r for r in book.runs().collect()}
    assert (runs[first].status, runs[first].stats, runs[first].error) == ("failed", {"rows": "5"}, "after the write") and runs[first].ended_at >= runs[first].started_at
    assert (runs[other].status, runs[again].status, runs[again].ended_at) == ("running", "running", None)
    refused = [r for r in runs.values() if r.stats and "lock_busy" in r.stats]
    assert len(refused) == 1 and refused[0].status == "failed" and refused[0].stats["guard_refused"] == "true"


def test_no_version_is_lost(spark, tmp_path):
    table = snapshots.Table(spark, f"file://{tmp_path}/t")
    rows = spark.createDataFrame([(1,)], "x int")
    assert table.replace(rows, base=0) == 1 and table.replace(rows.selectExpr("x + 1 as x"), base=1) == 2
    with pytest.raises(snapshots.Conflict):
        table.replace(rows, base=1)
    Path(tmp_path, "t/claims/3").touch()  # another writer is at work
    with pytest.raises(snapshots.Conflict):
        table.replace(rows, base=2)
    assert table.replace(rows.selectExpr("x + 8 as x")) == 4 and table.read().first().x == 9 and table.versions() == [2, 4]


def test_capture_is_written_gzipped_by_hour_and_pruned(spark, tmp_path):
    ms = lambda *a: int(dt.datetime(*a, tzinfo=dt.UTC).timestamp() * 1000)
    lines = [(ms(2026, 1, 1, 20), "a"), (ms(2026, 2, 20, 3), "b"), (ms(2026, 2, 20, 4), "c")]
    frames.write_capture(spark.createDataFrame(lines, "received_ms long, packet string"), str(tmp_path / "c"))
    assert sorted(str(p.relative_to(tmp_path / "c").parent) for p in (tmp_path / "c").glob("*/*/*.gz")) == ["day=20260102/hour=03", "day=20260220/hour=10", "day=20260220/hour=11"]
    one = next((tmp_path / "c/day=20260102").glob("*/*.gz"))
    assert json.loads(gzip.decompress(one.read_bytes())) == {"r": lines[0][0], "p": "a"}
    assert sorted(frames.read_capture(spark, str(tmp_path / "c")).collect()) == sorted(lines)
    assert frames.prune_capture(spark, str(tmp_path / "c"), dt.date(2026, 2, 21)) == ["day=20260102"]
    assert frames.read_capture(spark, str(tmp_path / "c"), since_ms=lines[2][0]).count() == 1


def test_answers_that_break_the_scheme_change_nothing(spark):
    good = {"group": "3", "sub": "3a", "confidence": 0.5, "summary_ai": "s", "tickers": [" aaa ", "AAA", "ZZZ"], "industries": ["B", "B"]}
    bad = {"no answer": "oops", "group": good | {"group": "4"}, "sub": good | {"group": "1"}, "confidence": good | {"confidence": 1.5}, "summary": {k: v for k, v in good.items() if k != "summary_ai"}, "industry": good | {"industries": ["Q"]}}
    answers = [(0, json.dumps(good)), *[(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bad.values(), 1)], (9, json.dumps({"group": "x", "sub": "x", "confidence": 1, "summary_ai": ""}))]
    articles = spark.createDataFrame([(i, "https://x.vn/du-lieu/BBB-1/y.chn", "AAA BBB USD", None, 3, False) for i in range(10)], "article_id long, url string, title string, sapo string, group_from_feed int, ticker_step_ran boolean")
    listed = spark.createDataFrame([("AAA", 1, 10), ("BBB", 2, 20)], "ticker string, security_id long, issuer_id long")
    codes = spark.createDataFrame([("B", 5)], "industry string, industry_id int")
    got = classified.apply(articles, spark.createDataFrame(answers, "article_id long, body string"), listed, codes, spark.createDataFrame([(20, 6), (10, None)], "issuer_id long, industry_id int"))
    assert {r.article_id: r.error for r in got.refused.collect()} == {i: e for i, e in enumerate(bad, 1)}
    assert {(r.article_id, r.group_no, r.overridden, tuple(r.labels), r.ticker_step_ran) for r in got.articles.collect()} == {(0, 3, False, (), True), (9, None, True, ("x",), False)}
    assert {tuple(r) for r in got.tickers.collect()} == {(0, 2, "url"), (0, 1, "lookup"), (0, 2, "lookup"), (0, 1, "ai")}
    assert {tuple(r)[1:3] for r in got.industries.collect()} == {(5, "ai"), (6, "ticker")} and tuple(got.counts.first()) == (1, 0)


def test_a_share_of_a_sum_is_of_the_whole_sum(spark):
    rule = guards.share("dup", "dups", "kept + dups", 0.5)
    counts = spark.createDataFrame([(100, 60), (10, 60)], "kept int, dups int")
    assert [r.ok for r in guards.judge(counts, [rule]).orderBy("kept").collect()] == [False, True]


def test_every_accented_letter_folds(spark):
    rows = spark.createDataFrame([("ğřŁťĐộ Ünïcødé Ǻ",)], "t string")
    assert rows.select(text.fold(rows.t)).first()[0] == "grltdo unicode a"


PAGE = """<div class="ls01-date">{date}</div><h1>KẾT QUẢ ĐẤU THẦU THỊ TRƯỜNG MỞ{short}</h1><table><tr><th>Loại hình giao dịch</th><th>b</th><th>c</th>{last}</tr>{rows}</table>"""
GROUP = '<tr class="ls01-group"><td>Mua kỳ hạn</td></tr>'
ROW = "<tr><td>7 ngày</td><td>1/1</td><td>{}</td><td>{}</td></tr>"


def test_auction_refusals(spark):
    page = lambda rows, date="Ngày 3 tháng 2 năm 2026", short="", last="<th>d</th>": PAGE.format(date=date, short=short, last=last, rows=rows)
    cases = {
        "short date": (page(GROUP + ROW.format("5", "1,5"), date="", short=" (03.02.26)"), None),
        "no session date": (page(GROUP + ROW.format("5", "1,5"), date="soon"), "no session date"),
        "columns": (page(GROUP + ROW.format("5", "1,5"), last=""), "3 columns"),
        "no group": (page(ROW.format("5", "1,5")), "a row before any group: 7 ngày"),
        "odd": (page(GROUP + "<tr><td>Huh</td></tr>"), "unknown row Huh"),
        "number": (page(GROUP + ROW.format("5x", "1,5")), "no number: 7 ngày 1/1 5x 1,5"),
        "rates": (page(GROUP + ROW.format("5", "1,5") + ROW.format("5", "1,6")), "rows of one tenor differ in rate"),
        "empty": (page(GROUP), "no rows"),
        "nothing": (None, "no title"),
    }
    good, bad = pages.auctions(spark.createDataFrame([(k, p) for k, (p, _) in cases.items()], "page_id string, body string"))
    assert {r.page_id: r.error for r in bad.collect()} == {k: e for k, (_, e) in cases.items() if e}
    assert [(r.page_id, str(r.session_date), r.tenor_days) for r in good.collect()] == [("short date", "2026-02-03", 7)]


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def __init__(self, master):
            self.set_, self.values = {}, {"spark.master": master}

        def get(self, k, default=None):
            return self.set_.get(k, self.values.get(k, default))

        def set(self, k, v):
            self.set_[k] = v

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    assert shared_dir(Session("local[4]")).startswith("file:///")
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(Session(master))


def test_a_reader_gives_its_rows_in_frames_of_bounded_size(spark):
    body = PAGE.format(date="Ngày 3 tháng 2 năm 2026", short="", last="<th>d</th>", rows=GROUP + ROW.format("5", "1,5") * 9000)
    sizes = [len(f) for f in pages.in_frames(((i, "x" * 100_000) for i in range(90)), ["i", "x"])]
    assert sum(sizes) == 90 and max(sizes) <= pages.FRAME_CHARS // 100_000 + 1
    assert max(len(f) for f in pages.in_frames(((i, *row) for i in range(3) for row in pages.result_cells(body)), ["page_id", "at", "cells", "mark"])) == pages.FRAME_ROWS
    good, _ = pages.auctions(spark.createDataFrame([(str(i), body) for i in range(3)], "page_id string, body string"))
    assert [(r.participants, float(r.volume_vnd)) for r in good.collect()] == [(9000, 45_000 * 1e9)] * 3
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "16m"


def test_packets_of_every_form_are_read(spark):
    packets = ['42["t",{"a":"u","d":[{"SB":"A"}]}]', '42["t",[{"SB":"B"}]]', '421["t",{"SB":"C"}]', '42[ "t" , {"d":{"SB":"D"}}]', json.dumps(["t", '{"d":[{"SB":"E"}]}']).join(["42", ""]), '42["zz",{"SB":"F"}]', '42["",{"SB":"G"}]', '42["t"]', "3probe"]
    rows = frames.records(spark.createDataFrame([(i, p) for i, p in enumerate(packets)], "received_ms long, packet string"))
    assert sorted((r.received_ms, r.event, r.fields["SB"]) for r in rows.collect()) == [(0, "t", "A"), (1, "t", "B"), (2, "t", "C"), (3, "t", "D"), (4, "t", "E")]
