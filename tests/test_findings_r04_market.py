"""Findings of round 4 on the market queries."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import postings
from tidemark.sources import pages

HEAD = f'<div class="ls01-date">Ngày 3 tháng 2 năm 2026</div><h1>{pages.RESULT_TITLE}</h1><table><tr><th>{pages.KIND_HEADER}</th><th>b</th><th>c</th><th>d</th></tr>'
GROUP = '<tr class="ls01-group"><td>Mua kỳ hạn</td><td></td></tr>'
BITS = [*"<table> </table> <tr> </tr> <td> </td> <th> </th> <script>x </script> <!-- --> > &amp; 5,5 (01.02.24) … <tidemark-rows>".split(), '<div class="ls01-date">', "</div>", GROUP, pages.RESULT_TITLE, "Loại hình", "giao dịch", "<p title='", '<p title="', "'", '"', "<tr><td>7 ngày</td><td>x</td></tr>", "<tr><td> </td></tr>\n", '<tr class="ls01-date a"><td>Ngày 3 tháng 2 năm 2024</td></tr>', "<tr><td>1</td></tr>" * 3]


def parsed(page, monkeypatch):
    """What the parser alone makes of a page."""
    with monkeypatch.context() as m:
        m.setattr(pages, "_folded", lambda p: (p, []))
        return list(pages.result_cells(page))


def test_plain_rows_read_by_a_pattern_are_those_of_the_parser(monkeypatch):
    rng = random.Random(4)
    for _ in range(1500):
        page = rng.choice(["", HEAD]) + "".join(rng.choice(BITS) for _ in range(rng.randint(0, 20)))
        got, want = list(pages.result_cells(page)), parsed(page, monkeypatch)
        assert got[1:] == want[1:] and got[0][1][1] == want[0][1][1]
        assert (pages.RESULT_TITLE in got[0][1][0]) == (pages.RESULT_TITLE in want[0][1][0])


def test_rows_of_a_large_page_do_not_reach_the_parser(monkeypatch):
    seen = []
    monkeypatch.setattr(pages, "parse_html", lambda page, f=pages.parse_html: (seen.append(len(page)), f(page))[1])
    cells = list(pages.result_cells(HEAD + GROUP + "<tr><td>- 7 ngày</td><td>2/1</td><td>5</td><td>1,5</td></tr>" * 20_000 + "</table>"))
    assert len(cells) == 20_003 and cells[-1] == (20_001, ["- 7 ngày", "2/1", "5", "1,5"], "")
    assert sum(seen) < 1000


def test_rows_are_aggregated_where_they_are_read(spark, monkeypatch):
    written = []
    monkeypatch.setattr(pages, "cut", lambda df, name, f=pages.cut: (written.append(f(df, name)), written[-1])[1])
    row = "<tr><td>- {} ngày</td><td>2/1</td><td>{}</td><td>1,5</td></tr>"
    total = '<tr class="ls01-total"><td>Tổng cộng</td><td></td><td>{}</td></tr>'
    body = HEAD + GROUP + "".join(row.format(7 * (1 + i % 2), 5) for i in range(5000)) + total
    docs = spark.createDataFrame([("a", body.format(25_000)), ("b", body.format(25_001)), ("c", body.format("x"))], "page_id string, body string")
    good, bad = pages.auctions(docs)
    assert sorted((r.page_id, r.tenor_days, r.participants, float(r.volume_vnd), float(r.rate_pct)) for r in good.collect()) == [("a", t, 5000, 12_500e9, 1.5) for t in (7, 14)]
    assert {r.page_id: r.error for r in bad.collect()} == {"b": "rows don't add up to their total: reverse_repo", "c": "no number: Tổng cộng  x"}
    assert sum(w.count() for w in written) < 30  # not a row per row of the pages


@pytest.mark.parametrize("mark", ["ls01-group", "a ls01-group", "ls01-groups"])
def test_a_group_is_named_by_its_class(mark):
    rows = [(-1, ["Mua kỳ hạn"], ""), (0, ["Thuê"], mark), (1, ["7 ngày"], ""), (2, ["Bán hẳn"], ""), (3, ["x"], "")]
    own = "Thuê" if mark.split()[-1] == "ls01-group" else None
    assert [(u, o) for *_, u, o in pages.in_groups(iter(rows))] == [(None, False), (own, own is not None), (own, False), ("Bán hẳn", True), ("Bán hẳn", False)]


def revisions(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, v, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in [*range(-3, 300), 1 << 40] for v in ([1, 2] if i % 5 == 0 else [1])]
    return spark.createDataFrame([*rows, (7, 70_000, "w1 " * 300 + "w2"), (None, 1, "w1"), (5, None, "w1")], "id long, version int, text string")


def kept(index):
    return {(r.token, r.id, r.version, r.length, *r.positions) for s in index.segments() for r in index._read("postings", postings.POSTINGS, [s]).collect()}


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_a_merge_leaves_postings_of_single_revisions_in_place(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(postings, "MOST_SENT", most)
    plans, write = [], postings.Index._write
    monkeypatch.setattr(postings.Index, "_write", lambda self, packed, heads: (plans.append(packed._jdf.queryExecution().optimizedPlan().toString()), write(self, packed, heads))[1])
    index, rows = postings.Index(spark, f"file://{tmp_path}/i", parts=8), revisions(spark)
    index.add(rows.where("version is null or version < 2"), "first")
    index.add(rows.where("version >= 2"), "second")
    index.merge()
    assert ("strategy=broadcast" in plans[-1]) == bool(most)
    best = rows.where("id is not null and version is not null").groupBy("id").agg(F.max_by(F.struct("version", "text"), "version").alias("r")).select("id", "r.*")
    want = set()
    for r in best.collect():
        tokens = r.text.split()
        want |= {(t, r.id, r.version, len(tokens), *[i for i, x in enumerate(tokens) if x == t]) for t in set(tokens)}
    assert kept(index) == want


def test_what_moves_is_packed(spark, tmp_path, monkeypatch):
    seen, write = [], postings.Index._write
    monkeypatch.setattr(postings.Index, "_write", lambda self, packed, heads: (seen.append(packed), write(self, packed, heads))[1])
    rows = spark.range(2000, numPartitions=2).select("id", F.lit(1).alias("version"), F.concat_ws(" ", *[F.concat(F.lit("w"), ((F.col("id") * 31 + i * i) % 500).cast("string")) for i in range(40)]).alias("text"))
    index = postings.Index(spark, f"file://{tmp_path}/i", parts=8)
    index.add(rows)
    index.add(rows.withColumn("version", F.lit(2)).where("id < 1000"))
    index.merge()
    for packed in seen:
        n, moved = packed.mapInArrow(postings._unpacked, postings.POSTINGS).count(), packed.agg(F.sum(F.length("packed") + F.length("places"))).first()[0]
        assert n > 25_000 and moved < 10 * n  # bytes a posting; a row of them has 80 and more


def test_small_batches_are_packed_together():
    rows = pa.table({"id": [1, 2, 3], "version": pa.array([1, 1, 1], pa.int32()), "t": [["a", "b"], [], ["a"]], "p": pa.array([[0, 1], [], [0]], pa.list_(pa.int32()))})
    packed = list(postings._inverted(iter(rows.to_batches(max_chunksize=1))))
    assert [b.num_rows for b in packed] == [2]
    got = [tuple(r.values()) for b in postings._unpacked(iter(packed)) for r in b.to_pylist()]
    assert got == [("a", 1, 1, 2, [0], 0), ("a", 3, 1, 1, [0], 0), ("b", 1, 1, 2, [1], 1)]
    assert list(postings._inverted(iter([]))) == []
