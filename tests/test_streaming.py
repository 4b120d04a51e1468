"""The live path: restarts, replays, expiry, blocks, refusals and compaction."""

from __future__ import annotations

import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars
from tidemark.sources import frames, snapshots
from tidemark.streaming import blocks, states, ticks

T = {"TD": "28/08/2026", "FT": "09:00:05", "SB": "AAA", "FV": "100", "FMP": "100", "SM": "1"}


def packets(path, name, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps({"r": r, "p": "42" + json.dumps(["t", {"d": [d]}])}) for r, d in rows))


def made(seed, n=240):
    rng, now, out = random.Random(seed), 1_000, []
    for _ in range(n):
        now += rng.choice([0, 1, 50, 100_000, 350_000])
        out.append((now, T | {"SB": rng.choice(["AAA", "BBB", "CCC"]), "SM": str(rng.randrange(6)), "FV": str(100 + rng.randrange(2))}))
    return out


def run(query):
    assert query.awaitTermination(90) and query.exception() is None


def test_restarted_streams_accept_what_a_batch_accepts(spark, tmp_path):
    rows = made(3)
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for i in range(3):
        packets(tmp_path / "c", f"frames-{i}.jsonl", rows[i * 80 : i * 80 + 80])
        q = ticks.accepted(ticks.capture(spark, str(tmp_path / "c"))).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        run(states.begin(spark, q, True))
    want = frames.accept(frames.records(frames.read_capture(spark, str(tmp_path / "c"))))
    key = lambda df: sorted((r.symbol, r.stamp, r.received_ms, r.event) for r in df.collect())
    got = key(spark.read.parquet(sink))
    assert 20 < len(got) < 200 and got == key(want)
    seen = states.entries(spark, checkpoint, "seen")
    assert seen.count() == len({(d["SB"], d["SM"], d["FV"]) for _, d in rows})


def test_sighted_contents_expire(spark, tmp_path):
    start = lambda: run(states.begin(spark, ticks.accepted(ticks.capture(spark, str(tmp_path / "c")), window_ms=1, idle_ms=1_500).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ckpt")), True))
    packets(tmp_path / "c", "a.jsonl", [(1_000 + i, T | {"SM": str(i)}) for i in range(40)])
    start()
    time.sleep(2)
    packets(tmp_path / "c", "b.jsonl", [(9_000, T | {"SB": "BBB"})])
    start()
    assert states.entries(spark, str(tmp_path / "ckpt"), "seen").count() == 1


def test_latest_state_survives_replays_and_expires_as_a_whole(spark, tmp_path):
    kind = "symbol string, ms long, delta map<string,string>"
    boot = spark.createDataFrame([("A", {"p": "0", "r": "7"}), ("Z", {"p": "5"})], "symbol string, state map<string,string>")

    def step(name, rows, ttl=states.DAY_MS, checkpoint="ckpt"):
        (tmp_path / checkpoint / "in").mkdir(parents=True, exist_ok=True)
        (tmp_path / checkpoint / "in" / name).write_text("\n".join(json.dumps({"symbol": s, "ms": ms, "delta": d}) for s, ms, d in rows))
        stream = spark.readStream.schema(kind).json(str(tmp_path / checkpoint / "in"))
        out = states.changes(stream, boot, ttl).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / checkpoint / "own")).option("path", str(tmp_path / checkpoint / "out"))
        got = []
        run(states.begin(spark, out.foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.collect())), True))
        return sorted(got)

    now = lambda checkpoint="ckpt": {r.symbol: r.state for r in states.current(spark, str(tmp_path / checkpoint / "own")).collect()}
    first = [("A", 10, {"p": "1", "q": "2"}), ("A", 11, {"p": "3"}), ("B", 5, {"p": "9"})]
    assert step("1.json", first) == [("A", "p", "3", 11), ("A", "q", "2", 10), ("B", "p", "9", 5)]
    assert now() == {"A": {"p": "3", "q": "2", "r": "7"}, "B": {"p": "9"}, "Z": {"p": "5"}}
    assert step("2.json", first) == []  # sent again
    assert step("3.json", [("A", 10, {"q": "1"}), ("A", 12, {"p": "2"})]) == [("A", "p", "2", 12)]
    assert now()["A"] == {"p": "2", "q": "2", "r": "7"}
    step("1.json", first, 1_000, "short")
    time.sleep(1.5)
    step("2.json", [("B", 99, {"q": "4"})], 60_000, "short")
    assert now("short").keys() <= {"B"}


def test_writers_of_the_state_table_lose_nothing(spark, tmp_path):
    table = snapshots.Table(spark, f"file://{tmp_path}/state")
    kind = "symbol string, ms long, delta map<string,string>"
    failed = []

    def write(i):
        try:
            ticks.latest_state(table, spark.createDataFrame([(f"S{i}", 50, {"p": str(i)}), ("A", 50 + i, {f"k{i}": "1"})], kind), 60, tries=30)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    some = [threading.Thread(target=write, args=(i,)) for i in range(3)]
    for t in some:
        t.start()
    for t in some:
        t.join()
    got = {r.symbol: r.state for r in table.read().collect()}
    assert not failed and got == {"A": {"k0": "1", "k1": "1", "k2": "1"}, "S0": {"p": "0"}, "S1": {"p": "1"}, "S2": {"p": "2"}}


def accepted_rows(spark, rows):
    return spark.createDataFrame([(ms, 0, "t", json.dumps(T | {"SB": s, "SM": str(n), "FV": str(v)}), s, ms) for ms, s, n, v in rows], ticks.ACCEPTED)


def test_a_block_is_written_once(spark, tmp_path):
    root = f"file://{tmp_path}/o"
    rows = accepted_rows(spark, [(10, "AAA", 1, 100), (11, "AAA", 2, 200)])
    ticks.write_batch(root, rows, 0)
    ticks.write_batch(root, rows, 1)  # the same block under another batch
    ticks.write_batch(root, rows, 0)  # a batch that is written again is written
    assert spark.read.parquet(f"{root}/t").count() == 2
    assert ticks.minute_bars(spark, root).first().v == 300
    ticks.write_batch(root, accepted_rows(spark, [(10, "AAA", 1, 100), (11, "AAA", 2, 999)]), 2)  # same keys, other content
    assert spark.read.parquet(f"{root}/t").count() == 4


def test_the_ledger_remembers_so_many(spark, tmp_path):
    ledger = blocks.Ledger(spark, f"file://{tmp_path}/l", remembered=3)
    rows = lambda i: blocks.numbered(spark.createDataFrame([("A", i), ("B", i)], "symbol string, x int"), "symbol", ["x"], parts=1)
    for i in range(4):
        fresh, found = ledger.fresh({"t": rows(i), "u": rows(i)}, i)
        assert fresh["t"].count() == 2 and len(found) == 2
        ledger.note(found, i)
    assert ledger.fresh({"t": rows(1)}, 9)[0]["t"].count() == 0 and ledger.fresh({"t": rows(0)}, 9)[0]["t"].count() == 2


def test_blocks_are_cut_alike_however_rows_come(spark):
    rows = spark.createDataFrame([(f"S{i % 7}", i) for i in range(400)], "symbol string, x int")
    cut = lambda df: sorted(r.digest for r in blocks.digests(blocks.numbered(df, "symbol", ["x"], size=30)).collect())
    assert cut(rows) == cut(rows.repartition(7, "x")) and len(cut(rows)) >= 400 // 30


def sink(path, bad=(), down=0):
    """Refuses some rows, and everything for a while."""
    path, away = str(path), [down]

    def send(block):
        if away[0]:
            away[0] -= 1
            raise ConnectionError("away")
        assert len(block) <= 16
        if wrong := [r["x"] for r in block if r["x"] in bad]:
            raise ValueError(f"can't store {wrong[0]}")
        with open(path, "a") as f:
            f.writelines(f"{r['x']}\n" for r in block)

    return send


@pytest.mark.parametrize("bad", [(), (3,), (0, 15, 16, 39), tuple(range(40))])
def test_refused_rows_are_set_apart(spark, tmp_path, bad):
    rows = spark.range(40).select(F.col("id").alias("x")).coalesce(1)
    got = blocks.deliver(rows, sink(tmp_path / "s", bad), size=16).collect()
    assert sorted(json.loads(r.row)["x"] for r in got if r.row) == sorted(bad)
    assert all(r.error == f"ValueError: can't store {json.loads(r.row)['x']}" for r in got if r.row)
    assert sum(r.sent for r in got if r.row is None) == 40 - len(bad)
    written = [int(x) for x in (tmp_path / "s").read_text().split()] if (tmp_path / "s").exists() else []
    assert written == [x for x in range(40) if x not in bad]  # in order, once


def test_a_sink_that_is_away_gets_the_block_again(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").alias("x")).coalesce(1)
    got = blocks.deliver(rows, sink(tmp_path / "s", down=2), size=16, waits=(0, 0)).collect()
    assert [(r.sent, r.tries) for r in got] == [(10, 3)] and len((tmp_path / "s").read_text().split()) == 10
    with pytest.raises(Exception, match="away"):
        blocks.deliver(rows, sink(tmp_path / "t", down=9), size=16, waits=(0, 0)).collect()
    assert not (tmp_path / "t").exists()


def test_bars_are_the_same_before_during_and_after_a_compaction(spark, tmp_path):
    parts = blocks.Partials(spark, f"file://{tmp_path}/b", fan=2)
    rng = random.Random(2)
    rows = [(rng.choice("AB"), rng.randrange(600), i, i, float(rng.randrange(90, 110)), rng.randrange(1, 50), rng.choice("BSX")) for i in range(260)]
    t = spark.createDataFrame(rows, "symbol string, sec int, seq long, received_at long, price double, volume long, side string").withColumn("ts", F.timestamp_seconds(F.col("sec"))).withColumn("slot", F.date_trunc("minute", "ts"))
    order, key = ["ts", "seq", "received_at"], ["symbol", "slot"]
    want = sorted(map(tuple, bars.bars(t, key, order).collect()))
    for i in range(13):
        parts.add(i, bars.partials(t.where((F.col("seq") >= i * 20) & (F.col("seq") < i * 20 + 20)), key, order))
        if i == 8:
            assert parts.compact() > 0
    now = lambda: sorted(map(tuple, parts.read().collect()))
    assert now() == want
    reader = parts.read()  # planned before the folders it reads are compacted
    while parts.compact():
        pass
    assert now() == want and sorted(map(tuple, reader.collect())) == want
    assert parts.vacuum() > 0 and now() == want and parts.vacuum() == 0
    assert len(parts.folders()) <= 5 and parts.folders()[-1].endswith("batch=12")
    parts.add(12, bars.partials(t.where("seq >= 240"), key, order))  # the last batch may be written again
    assert now() == want
