from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, dedup, due, guards, hierarchy, merge, ordering, reshape, series

D = dt.date


def ticks(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ts timestamp, seq long, received_at long, price double, volume long, side string").withColumn("slot", F.date_trunc("minute", "ts"))


T0 = dt.datetime(2026, 8, 28, 9, 0, 5)


@pytest.mark.parametrize("two_steps", [False, True])
def test_bar_of_three_ticks(spark, two_steps):
    rows = [("AAA", T0, 1, 1, 100.0, 100, "B"), ("AAA", T0 + dt.timedelta(seconds=1), 2, 2, 101.0, 200, "S"), ("AAA", T0 + dt.timedelta(seconds=2), 3, 3, 99.0, 50, "B")]
    t, order = ticks(spark, rows), ["ts", "seq", "received_at"]
    made = bars.merge(bars.partials(t.withColumn("b", F.col("seq") % 2), ["symbol", "slot", "b"], order), ["symbol", "slot"]) if two_steps else bars.bars(t, ["symbol", "slot"], order)
    r = made.first()
    assert (r.o, r.h, r.l, r.c, r.v, r.val, r.v_bu, r.v_sd) == (100, 101, 99, 99, 350, 35150, 150, 200)


def test_bar_unknown_side_and_order(spark):
    rows = [("A", T0, 9, 1, 300.0, 30, "X"), ("A", T0, 3, 2, 100.0, 1, "")]
    r = bars.bars(ticks(spark, rows), ["symbol", "slot"], ["ts", "seq", "received_at"]).first()
    assert (r.o, r.c, r.v, r.v_bu, r.v_sd) == (100, 300, 31, 0, 0)


def test_index_bar_keeps_null_and_skips_zero(spark):
    rows = [("I", T0, 1, 1200.5, None, None), ("I", T0, 2, 0.0, 5, 5.0), ("J", T0, 1, None, 7, 7.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, seq long, index_value double, total_vol long, total_value double").withColumn("slot", F.date_trunc("minute", "ts"))
    got = bars.index_bars(df, ["symbol", "slot"], ["ts", "seq"]).collect()
    assert len(got) == 1 and got[0].cum_vol is None and got[0].o == 1200.5


@pytest.mark.parametrize(("bar", "total", "want"), [(150, 100, "p1"), (100, 200, "p2"), (999, 1000, "minor"), (100, 100, "ok"), (None, 5, "p2"), (5, None, "p1"), (None, 0, "ok")])
def test_reconcile_verdicts(spark, bar, total, want):
    df = spark.createDataFrame([(bar, total)], "b long, t long")
    assert df.select(bars.verdict(F.col("b"), F.col("t"))).first()[0] == want


def test_sliding_dedup_and_stamp_equal_the_loops(spark):
    rng = random.Random(7)
    rows, now = [], 0
    for i in range(400):
        now += rng.choice([0, 1, 200_000, 500_000])
        rows.append((i, rng.choice("abc"), now))
    df = spark.createDataFrame(rows, "i long, k string, ms long")
    got = {r.i: (r.dup, r.stamp) for r in dedup.stamp(dedup.sliding_dedup(df, ["k"], "ms", ["ms", "i"]), "k", "ms", ["i"]).collect()}
    seen, last = {}, {}
    for i, k, ms in rows:
        dup = k in seen and ms - seen[k] < 600_000
        seen[k] = ms
        last[k] = max(ms, last.get(k, -1) + 1)
        assert got[i] == (dup, last[k])


def test_keep_best_and_first(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, "a", "b"), ("k", 3, "x", "y"), (None, 4, None, None)], "k string, pos int, a string, b string")
    best = {r.k: (r.pos, r.n_rows) for r in dedup.keep_best(df, ["k"], ["a", "b"], ["pos"]).collect()}
    assert best == {"k": (3, 3), None: (4, 1)}
    assert {r.k: (r.pos, r.n_dups) for r in dedup.keep_first(df, ["k"], ["pos"]).collect()} == {"k": (1, 2), None: (4, 0)}


def test_latest_version_keeps_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "k int, v int, x string")
    assert {r.x for r in dedup.latest_version(df, ["k"], ["v"]).collect()} == {"b", "c", "d"}


def test_splice(spark):
    points = spark.createDataFrame([("x", D(2020, 1, 1), 100.0), ("x", D(2020, 2, 1), 100.0), ("x", D(2020, 3, 1), 170.0), ("y", D(2020, 1, 1), 42.0)], "k string, d date, v double")
    breaks = spark.createDataFrame([("x", D(2020, 3, 1), 1.6005)], "k string, break_day date, factor double")
    got = {(r.k, r.d): round(r.spliced, 6) for r in series.splice(points, breaks, "k", "d", "v").collect()}
    assert list(got.values()).count(160.05) == 2 and got["x", D(2020, 3, 1)] == 170 and got["y", D(2020, 1, 1)] == 42


def test_flow_nets_and_mirrors_sales(spark):
    a = spark.createDataFrame([(D(2026, 1, 1), 7, Decimal("6307.47"), False), (D(2026, 1, 8), 7, Decimal(5000), False)], "d date, tenor int, x decimal(18,2), sale boolean")
    assert {r.flow_date: r.net for r in series.flow(a, "d", "tenor", "x", F.col("sale")).collect()}[D(2026, 1, 8)] == Decimal("-1307.47")
    b = spark.createDataFrame([(D(2026, 1, 1), 7, Decimal(10000), False), (D(2026, 1, 1), 14, Decimal(4000), True)], "d date, tenor int, x decimal(18,2), sale boolean")
    r = series.flow(b, "d", "tenor", "x", F.col("sale")).orderBy("flow_date").first()
    assert (r.injected, r.matured, r.net) == (10000, 4000, 6000)


def test_coverage_frequency_weekends(spark):
    cal = spark.createDataFrame([(D(2026, 1, d),) for d in range(1, 11)], "d date")
    have = cal.where("d <> date '2026-01-04'")
    got = {r.d: r.complete for r in series.covered(cal, "d", cal, have, span=2).collect()}
    assert [got[D(2026, 1, d)] for d in (2, 3, 4, 6, 7, 10)] == [False, True, False, False, True, True]
    pts = spark.createDataFrame([("m", D(2026, m, 1), 1.0) for m in range(1, 6)] + [("one", D(2026, 1, 1), 1.0)], "k string, d date, v double")
    assert {r.k: r.freq for r in series.frequency(pts, "k", "d").collect()} == {"m": "m", "one": None}
    week = spark.createDataFrame([("k", D(2026, 1, 2), 5.0), ("k", D(2026, 1, 3), 5.0), ("k", D(2026, 1, 4), 6.0), ("k", D(2026, 1, 5), 6.0)], "k string, d date, v double")
    assert [r.d.day for r in series.weekend_carry(week, "k", "d", "v").orderBy("d").collect()] == [2, 4, 5]


def test_nearest_ancestor_and_override(spark):
    nodes = spark.createDataFrame([(1, "8000/8300/8350", "8355"), (2, "8000/8300", "8399"), (3, "1", "2")], "id int, path string, code string")
    mapping = spark.createDataFrame([("8000", "fin"), ("8350", "bank"), ("8399", "own")], "map_code string, map_target string")
    assert {r.id: r.target for r in hierarchy.nearest_ancestor(nodes, mapping, "path", "code", "id").collect()} == {1: "bank", 2: "own", 3: None}
    base = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, value string")
    manual = spark.createDataFrame([(1, "z")], "id int, value string")
    assert {r.id: (r.value, r.origin) for r in hierarchy.override(base, manual, "id").collect()} == {1: ("z", "manual"), 2: (None, "none"), 3: ("c", "derived")}


def test_upsert(spark):
    kind = "k int, v string, raw string, m map<string,string>"
    old = spark.createDataFrame([(1, "a", "r", {"x": "1"}), (2, "b", None, None), (3, "c", "r", {"x": "1"}), (None, "n", "r", None)], kind)
    new = spark.createDataFrame([(1, "a", "other", {"x": "1"}), (2, "b", "set", None), (4, "d", "r", {"y": "2"}), (None, "n2", "r", None), (3, "c", None, {"y": "2"})], kind)
    got = {r.k: r for r in merge.upsert(old, new, ["k"], ["v"], once=["raw"], maps=["m"], sentinels={"k": 0}).collect()}
    assert {k: r.status for k, r in got.items()} == {1: "same", 2: "changed", 3: "changed", 4: "inserted", None: "changed"}
    assert got[1].raw == "r" and got[3].m == {"x": "1", "y": "2"}
    assert tuple(merge.counters(merge.upsert(old, new, ["k"], ["v"], once=["raw"], maps=["m"], sentinels={"k": 0})).first()) == (1, 3, 1, 0)


def test_group_replacement_never_deletes_on_empty(spark):
    kind = "g int, h string, x int"
    old = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "b", 3), (3, "c", 4)], kind)
    new = spark.createDataFrame([(1, "z", 9), (2, "b", 3)], kind)
    assert sorted((r.g, r.x) for r in merge.replace_groups(old, new, ["g"], "h").collect()) == [(1, 9), (2, 3), (3, 4)]


def test_registry_directory_revisions_issuers(spark):
    old = spark.createDataFrame([("a", "s1"), ("b", "s1"), ("c", "s2")], "code string, source string")
    assert sorted(r.code for r in merge.sync_registry(old, spark.createDataFrame([("a",), ("d",)], "code string"), ["code"], "s1").collect()) == ["a", "c", "d"]
    revs = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "id int, version int, content string").withColumn("digest", F.sha2("content", 256))
    inc = spark.createDataFrame([(1, "y"), (2, "new")], "id int, content string")
    assert [(r.id, r.version) for r in merge.new_revisions(revs, inc, "id").collect()] == [(2, 1)]
    ev = spark.createDataFrame([("o1", "T1", None), ("o1", None, "Real"), ("o2", None, None), ("o3", "T3", "")], "org_code string, ticker string, org_name string")
    got = merge.minimal_issuers(spark.createDataFrame([("o9",)], "org_code string"), ev).collect()
    assert {r.org_code: r.name for r in got} == {"o1": "Real", "o2": "o2", "o3": "T3"}


def judged(spark, rules, **counts):
    return guards.judge(spark.range(1).select(*[F.lit(v).alias(k) for k, v in counts.items()]), rules).first()


def test_guards(spark):
    ok = dict(collected=1000, priced=900, total_count=1000, base_items=1000, unmapped=10, unknown=0)
    assert judged(spark, guards.SCREENER, **ok).ok
    r = judged(spark, guards.SCREENER, **ok | {"priced": 100, "total_count": 970})
    assert list(r.reasons) == ["not_a_session", "pages", "drop"]
    few = dict(floor_compared=19, changed_floor=19, attempted=19, failed=19, bad_shape=0, empty=0)
    assert judged(spark, guards.FUNDAMENTALS, **few).ok
    assert list(judged(spark, guards.FUNDAMENTALS, **few | {"attempted": 100, "failed": 21, "empty": 6}).reasons) == ["failed", "empty"]
    price = dict(codes=100, with_data=98, invalid=1, failed=1, empty=0, base_with_data=100, latest=D(2026, 1, 2), today=D(2026, 1, 2), base_latest=D(2026, 1, 1))
    assert judged(spark, guards.PRICE, **price).ok
    assert list(judged(spark, guards.PRICE, **price | {"empty": 1, "latest": D(2026, 1, 3)}).reasons) == ["missing", "future"]
    assert not judged(spark, guards.EVENTS, collected=5, bad_families=0, dropped_families=0, issuers_new=21, accept_new=False, dup_conflicts=0, rows_kept=5).ok
    assert judged(spark, guards.EVENTS, collected=5, bad_families=0, dropped_families=0, issuers_new=21, accept_new=True, dup_conflicts=0, rows_kept=5).ok


def test_ordering(spark):
    assert [ordering.limit_of(x, 30, 200) for x in (None, 0, 5, 999)] == [30, 1, 5, 200]
    df = spark.createDataFrame([(i, i % 3 if i % 4 else None) for i in range(12)], "i int, b int")
    assert not ordering.truncated(df, 12) and ordering.truncated(df, 11)
    per = ordering.per_bucket(df, "b", ["i"], 2).groupBy("b").count().collect()
    assert {r.b: r["count"] for r in per} == {None: 2, 0: 2, 1: 2, 2: 2}
    days = spark.createDataFrame([(k, D(2026, 1, k)) for k in range(1, 6)], "k int, d date")
    got = ordering.overflow(days, "k", "d", 3).collect()
    assert len(got) == 3 and {r.cut for r in got} == {D(2026, 1, 4)}
    assert {r.cut for r in ordering.overflow(days, "k", "d", 5).collect()} == {None}


def test_reshape(spark):
    rows = spark.createDataFrame([("t", "financial", "c", "1"), ("t", "stockScreenerItem", "c", "2"), ("t", "technical", "e", "9")], "t string, block string, code string, value string")
    got = {r.code: (r.block, r.value, r.conflicts) for r in reshape.first_block(rows, ["t"], ["stockScreenerItem", "financial", "technical"]).collect()}
    assert got == {"c": ("stockScreenerItem", "2", 1), "e": ("technical", "9", 0)}
    m = spark.createDataFrame([(1, 5, 1, 4.5), (1, 6, None, 4.5), (2, 1, 1, 4.0), (2, 1, 1, 4.1)], "t int, v int, w int, rate double")
    assert {r.t: (r.v, r.w, r.clash) for r in reshape.merge_same(m, ["t"], ["v"], ["w"], "rate").collect()} == {1: (11, None, False), 2: (2, 2, True)}
    q = spark.createDataFrame([("a", x) for x in (5, 1, 2, 2, 9)], "k string, v int")
    assert reshape.exact_quantile(q, ["k"], "v", 0.5).first().v == sorted([5, 1, 2, 2, 9])[int(0.5 * 5)]
    a = spark.createDataFrame([("g", 1), ("g", 2)], "g string, x int")
    b = spark.createDataFrame([("g", 2), ("g", 1)], "g string, x int")
    assert reshape.ordered_digest(a, ["g"], ["x"]).first().digest == reshape.ordered_digest(b, ["g"], ["x"]).first().digest


def test_due_list(spark):
    issuers = spark.createDataFrame([(1,), (2,), (3,)], "issuer int")
    checks = spark.createDataFrame([(1, "k", D(2026, 1, 1)), (2, "k", D(2026, 1, 30))], "issuer int, kind string, checked date")
    events = spark.createDataFrame([(2, "e", D(2026, 1, 31))], "issuer int, event_type string, seen date")
    kinds = spark.createDataFrame([("e", "k")], "event_type string, kind string")
    day = F.lit("2026-02-01").cast("date")
    assert {r.issuer: r.why for r in due.due_list(issuers, checks, events, kinds, day, {"k": 30}).collect()} == {1: "floor", 2: "event", 3: "first"}
    assert {r.issuer: r.why for r in due.due_list(issuers, checks, events, kinds, day, {"k": 30}, cold=True).collect()} == {1: "floor", 3: "first"}
