"""The index against scans: increments, versions, phrases, ranks, merges."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import postings
from tidemark.serving import Warehouse
from tidemark.sources import snapshots

WORDS = "lãi suất ngân hàng tăng giảm the of cổ phiếu".split()


def plain(w):
    return w.translate(str.maketrans("ãấâàăảổế", "aaaaaaoe"))


def revisions():
    rng = random.Random(7)
    rows = [(i, v, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 25)))) for i in range(60) for v in range(1, 1 + rng.choice([1, 1, 2, 3]))]
    return [*rows, (100, 1, None), (101, 1, "suất " * 400 + "hàng " * 300), (102, 1, " ,. ")]


def brute_rank(tokens, asked):
    own = sorted(set(asked))
    at = {w: [min(i, 16383) for i, t in enumerate(tokens, 1) if t == w][:255] for w in own}
    if len(own) == 1:
        return sum(0.1 / j**2 for j in range(1, len(at[own[0]]) + 1)) / 1.64493406685
    left = 1.0
    for i, a in enumerate(own):
        for b in own[:i]:
            for p in at[a]:
                for q in at[b]:
                    if (d := abs(p - q)) > 0:
                        left *= 1 - 0.1 * math.sqrt(1 / (1.005 + 0.05 * math.exp(d / 1.5 - 2)) if d <= 100 else 1e-30)
    return 1 - left


def brute(rows, asked, phrase):
    newest = {}
    for i, v, t in rows:
        newest[i] = max(newest.get(i, (0, "")), (v, plain(t or "")))
    out = {}
    for i, (_, t) in newest.items():
        tokens = t.replace(",", " ").replace(".", " ").split()
        if asked and (any(tokens[k : k + len(asked)] == asked for k in range(len(tokens))) if phrase else set(asked) <= set(tokens)):
            out[i] = brute_rank(tokens, asked)
    return out


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    index = postings.Index(spark, f"file://{tmp_path_factory.mktemp('index')}", parts=8)
    rows = spark.createDataFrame(revisions(), "id long, version int, text string")
    for v in (1, 2, 3):
        index.add(rows.where(F.col("version") == v), name=f"b{v}")
    return index


ASKED = [(["lai", "suat"], True), (["suat", "lai"], True), (["the", "the"], True), (["ngan", "hang", "tang"], False), (["of"], False), (["suat", "hang"], False), (["nothing"], False), ([], False), ([], True)]


def same(got, want):
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize(("asked", "phrase"), ASKED)
def test_search_is_a_scan(index, asked, phrase):
    hits = index.search(asked, phrase)
    if not asked:
        assert hits.rows.isEmpty()
        return
    want = brute(revisions(), asked, phrase)
    same({r.id: r.score for r in hits.scored().collect()}, want)
    top = hits.top(5).collect()
    assert [r.id for r in top] == [i for i, _ in sorted(want.items(), key=lambda x: (-round(x[1], 12), x[0]))[:5]]


def test_bounds_hold(index):
    for asked, phrase in ASKED[:6]:
        hits = index.search(asked, phrase)
        assert hits.rows.where(postings.at_most(hits.places) < postings.rank(hits.places) - 1e-12).isEmpty()


def test_a_search_opens_the_asked_parts_alone(index):
    plan = index.postings(["lai"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "part#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "PushedFilters" in plan and "lai" in plan.split("PushedFilters")[1].split("\n")[0]


def test_batches_count_once_and_merges_change_nothing(spark, index, tmp_path):
    own = postings.Index(spark, f"file://{tmp_path}/i", parts=4)
    rows = spark.createDataFrame(revisions(), "id long, version int, text string")
    own.add(rows.where("version < 3"), name="first")
    first = own.segments()
    assert own.add(rows.where("version < 3"), name="first") == first[0] and own.segments() == first
    own.add(rows.where("version = 3"), name="second")
    asked = ["ngan", "hang"]
    before = {r.id: r.score for r in own.search(asked).scored().collect()}
    same(before, brute(revisions(), asked, False))
    running = own.search(asked).scored()  # planned before the merge
    merged = own.merge()
    assert own.segments() == [merged] and own.merge() is None
    same({r.id: r.score for r in running.collect()}, before)
    same({r.id: r.score for r in own.search(asked).scored().collect()}, before)
    assert own.postings(["ngan"]).groupBy("id").count().where("count > 1").isEmpty()  # older versions are gone
    own.add(rows.where("version = 3"), name="second")  # still known
    assert own.segments() == [merged]
    gone = own.vacuum()
    assert first[0] in gone and merged not in gone and len(gone) == 2
    same({r.id: r.score for r in own.search(asked).scored().collect()}, before)


def test_two_writers_conflict(spark, tmp_path):
    own = postings.Index(spark, f"file://{tmp_path}/i")
    rows = spark.createDataFrame([(1, 1, "a")], "id long, version int, text string")
    own.add(rows)
    with pytest.raises(snapshots.Conflict):
        own._swap([("x", None)], base=0)


def test_news_by_index_is_news_by_scan(spark, index, tmp_path):
    rows = revisions()
    t = {
        "article": spark.createDataFrame([(i, "src", None, i % 3 + 1, "1a") for i in sorted({r[0] for r in rows})], "article_id long, primary_source string, published_at timestamp, group_no int, sub string").withColumn("fetched_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("article_id") * 86_400)),
        "revision": spark.createDataFrame([(i, v, "", None, t or "") for i, v, t in rows], "article_id long, version int, title string, sapo string, content string"),
    }
    scan, fast = Warehouse(t), Warehouse(t, index)
    for query in ("lãi suất", "suất hàng", "of", "zzz"):
        a, b = scan.news(query, group_no=2, limit=7), fast.news(query, group_no=2, limit=7)
        assert a.facts == b.facts
        if a.rows is not None:
            assert a.rows.collect() == b.rows.collect()
