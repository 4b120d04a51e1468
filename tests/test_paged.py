"""Paged sources and part-wise merges."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources import paged, snapshots
from tidemark.sources.http import GaveUp
from tidemark.sources.partitioned import Partitioned

NO_WAIT = paged.Policy(waits=(0, 0, 0), weight_header="x-used-weight", pause_s=60, most_failures=3)


def feed(full=3, pages=lambda _: None):
    def classify(status, body):
        if status != 200:
            return "retry"
        return "ok" if body.startswith("[") else "bad"

    return paged.Feed(lambda code, page, after: f"{code}?start={after or 0}", classify, lambda b: len(json.loads(b)), full, lambda b: json.loads(b)[-1] + 1, pages)


class Site:
    """Numbers from 0 on by pages; some replies go wrong first."""

    def __init__(self, sizes, wrong=None, weight=None, full=3):
        self.sizes, self.wrong, self.weight, self.full, self.asked = sizes, {k: list(v) for k, v in (wrong or {}).items()}, weight, full, []

    def __call__(self, url):
        self.asked.append(url)
        code, start = url.split("?start=")
        if self.wrong.get(code):
            bad = self.wrong[code].pop(0)
            if bad == "down":
                raise OSError("reset")
            return paged.Reply(*bad)
        return paged.Reply(200, json.dumps(list(range(int(start), self.sizes[code]))[: self.full]), {"X-Used-Weight": str(self.weight or 0)})


def got(site, code, policy=NO_WAIT, sleeps=None, f=None):
    return list(paged.pages_of(code, site, f or feed(), policy, (sleeps if sleeps is not None else []).append))


def test_pages_follow_positions_until_a_short_one():
    site = Site({"A": 7, "B": 6, "C": 0})
    assert [json.loads(r[2]) for r in got(site, "A")] == [[0, 1, 2], [3, 4, 5], [6]]
    assert site.asked == ["A?start=0", "A?start=3", "A?start=6"]
    assert [json.loads(r[2]) for r in got(site, "B")] == [[0, 1, 2], [3, 4, 5], []]
    assert [json.loads(r[2]) for r in got(site, "C")] == [[]]
    assert len(got(Site({"A": 9}), "A", f=feed(pages=lambda _: 2))) == 2  # the source names two pages


def test_retries_bad_shapes_and_bans():
    sleeps = []
    assert [r[3] for r in got(Site({"A": 4}, {"A": ["down", (429, "slow")]}), "A", sleeps=sleeps)] == [3, 1] and sleeps == [0, 0]
    rows = got(Site({"A": 4}, {"A": [(200, "{}")]}), "A")
    assert rows[0][:3] == ("A", 1, None) and "bad shape after 1" in rows[0][4] and len(rows) == 1
    assert "no answer after 4" in got(Site({"A": 4}, {"A": ["down"] * 4}), "A")[0][4]
    with pytest.raises(paged.Banned):
        got(Site({"A": 4}, {"A": [(418, "out")]}), "A")


def test_a_heavy_share_pauses():
    sleeps = []
    got(Site({"A": 4}, weight=2999), "A", sleeps=sleeps)
    assert sleeps == []
    got(Site({"A": 4}, weight=3000), "A", sleeps=sleeps)
    assert sleeps == [60, 60]


def test_a_source_is_read_by_spark(spark):
    sizes = {f"K{i}": i for i in range(12)}

    def get(url):
        code, start = url.split("?start=")
        if code == "K5":
            raise OSError("down")
        return paged.Reply(200, json.dumps(list(range(int(start), sizes[code]))[:3]))

    made = feed()
    rows = paged.read(spark, paged.source("numbers", sorted(sizes), get, made, paged.Policy(waits=(0,)), lanes=3)).collect()
    assert {r.code for r in rows if r.error} == {"K5"}
    seen = {}
    for r in sorted((r for r in rows if not r.error), key=lambda r: (r.code, r.page)):
        seen.setdefault(r.code, []).extend(json.loads(r.body))
    assert seen == {k: list(range(n)) for k, n in sizes.items() if k != "K5"}


def test_the_breaker_opens_and_a_ban_ends_the_read(spark):
    def down(url):
        raise OSError("down")

    def banned(url):
        return paged.Reply(418, "out")

    made, policy = feed(), paged.Policy(waits=(), most_failures=3)
    with pytest.raises(Exception, match="3 keys in a row failed"):
        paged.read(spark, paged.source("down", list("abcde"), down, made, policy)).collect()
    assert paged.read(spark, paged.source("half", list("ab"), down, made, policy)).where("error is not null").count() == 2
    with pytest.raises(Exception, match="418"):
        paged.read(spark, paged.source("banned", list("ab"), banned, made, policy)).collect()
    assert GaveUp


# --- merges by part -----------------------------------------------------------

KIND = "issuer long, period int, value double"


def upsert(old, new):
    return merge.upsert(old, new, ["issuer", "period"], ["value"])


def test_a_merge_touches_its_parts_alone(spark, tmp_path):
    rng = random.Random(1)
    table = Partitioned(spark, f"file://{tmp_path}/t", KIND, ["issuer"], parts=16)
    rows = {(i, p): rng.random() for i in range(200) for p in range(5)}
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], KIND)
    first = table.merge(frame(rows), upsert)
    assert first.counts == {"inserted": 1000} and len(first.parts) == 16
    before = table.folders()
    delta = {(3, 0): 9.0, (3, 9): 8.0, (3, 1): rows[3, 1], (71, 2): 7.0}
    done = table.merge(frame(delta), upsert)
    assert 1 <= len(done.parts) <= 2 and done.counts["inserted"] == 1 and done.counts["changed"] == 2
    now = table.folders()
    assert {p for p in now if now[p] != before[p]} == set(done.parts)
    assert {(r.issuer, r.period): r.value for r in table.read().collect()} == rows | delta
    read = table.read(done.parts).inputFiles()
    assert read and all(any(f"__part={p}/" in f for p in done.parts) for f in read)  # in proportion to the delta
    assert table.vacuum() >= len(done.parts) and table.read().count() == 1001 and table.vacuum() == 0


def test_groups_are_replaced_and_parts_emptied(spark, tmp_path):
    table = Partitioned(spark, f"file://{tmp_path}/t", KIND, ["issuer"], parts=4)
    assert table.read().count() == 0
    frame = lambda rows: spark.createDataFrame(rows, KIND)
    table.merge(frame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 5.0)]), upsert)
    replace = lambda old, new: old.join(new.select("issuer").distinct(), "issuer", "left_anti").select(*new.columns).unionByName(new)
    assert table.merge(frame([(1, 3, 9.0)]), replace).counts == {}
    assert sorted(map(tuple, table.read().collect())) == [(1, 3, 9.0), (2, 1, 5.0)]
    table.merge(frame([(2, 0, 0.0)]), lambda old, new: old.join(new.select("issuer"), "issuer", "left_anti").select(*new.columns))
    assert sorted(map(tuple, table.read().collect())) == [(1, 3, 9.0)]
    assert table.merge(frame([]), upsert).parts == []
    with pytest.raises(ValueError, match="doesn't touch"):
        table.merge(frame([(1, 1, 1.0)]), lambda old, new: new.withColumn("issuer", F.explode(F.array([F.lit(i) for i in range(1, 40)]))))
    assert sorted(map(tuple, table.read().collect())) == [(1, 3, 9.0)]


def test_merges_that_meet_conflict(spark, tmp_path):
    table = Partitioned(spark, f"file://{tmp_path}/t", KIND, ["issuer"], parts=2)
    rows = spark.createDataFrame([(1, 1, 1.0)], KIND)

    def slow(old, new):
        table.merge(rows, upsert)
        return upsert(old, new)

    with pytest.raises(snapshots.Conflict):
        table.merge(rows, slow)
    assert table.read().count() == 1
