"""Name postings, typed sidecars, backups, and what dead writers leave."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import grams
from tidemark.serving import METRICS, Warehouse
from tidemark.sources import backups, files, ledger, sidecar, snapshots


def directory(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ABCX1") for _ in range(3)), rng.choice(["Công ty Thép", "Ngân hàng Á", "Thép Á", None]), i % 5 > 0) for i in range(120)]
    security = spark.createDataFrame([(i, i, t, "HOSE", "stock", "listed" if on else "delisted") for i, t, _, on in rows], "security_id long, issuer_id long, ticker string, exchange string, security_type string, status string")
    issuer = spark.createDataFrame([(i, n) for i, _, n, _ in rows], "issuer_id long, short_name string")
    return security, issuer


def test_suggestions_from_postings_are_those_of_a_scan(spark, tmp_path):
    security, issuer = directory(spark)
    index = grams.Grams(spark, f"file://{tmp_path}/g", parts=4)
    listed = security.where("status = 'listed'")
    names = listed.select(F.col("security_id").alias("id"), F.lit("ticker").alias("field"), F.col("ticker").alias("name")).unionByName(listed.join(issuer, "issuer_id").select(F.col("security_id").alias("id"), F.lit("name").alias("field"), F.col("short_name").alias("name")))
    index.build(names)
    scan, fast = Warehouse({"security": security, "issuer": issuer}), Warehouse({"security": security, "issuer": issuer}, names=index)
    for asked in ("ABZ", "XX", "thép", "Á", "zzzz", "1A", " "):
        assert fast.resolve(asked).facts == scan.resolve(asked).facts
    plan = index.table.read().where(F.col("part").isin(1, 2) & F.col("gram").isin("abc"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "part#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_screens_over_typed_columns_are_those_over_payloads(spark, tmp_path):
    rng = random.Random(6)
    security, issuer = directory(spark)
    body = lambda: "{" + ", ".join(f'"{m}": {rng.choice([str(round(rng.uniform(-5, 50), 3)), "null", chr(34) + "n/a" + chr(34)])}' for m in ("rtd11", "rtd14", "rtq12")) + "}"
    rows = [(i, day, '{"stockScreenerItem": ' + body() + "}") for i in range(120) for day in ("2026-01-05", "2026-01-06")]
    screener = spark.createDataFrame(rows, "security_id long, trading_date string, payload string").select("security_id", F.to_date("trading_date").alias("trading_date"), F.parse_json("payload").alias("payload"))
    t = {
        "security": security, "issuer": issuer, "screener": screener,
        "industry": spark.createDataFrame([(1, "N1", "one", 2)], "industry_id int, code string, name_vi string, level int"), "issuer_industry": spark.createDataFrame([(3, 1)], "issuer_id long, industry_id int"),
    }
    metrics = sorted(METRICS)
    sidecar.write(screener, f"file://{tmp_path}/m", metrics, "rtd11")
    wide = sidecar.read(spark, f"file://{tmp_path}/m", metrics)
    scan, fast = Warehouse(t), Warehouse(t | {"screener_metrics": wide})
    for criteria in ([], [{"metric_code": "rtd11", "operator": ">", "value": 10}], [{"metric_code": "rtd14", "operator": "<=", "value": 20.5}, {"metric_code": "rtq12", "operator": "=", "value": 0.12345678901234}]):
        a, b = scan.screen(criteria, limit=50), fast.screen(criteria, limit=50)
        assert a.facts == b.facts
        if a.rows is not None:
            assert a.rows.collect() == b.rows.collect()
    day = wide.where((F.col("trading_date") == F.lit("2026-01-06").cast("date")) & (F.col("rtd11") > sidecar.literal(10)))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(rtd11,10" in plan and "trading_date" in plan.split("PartitionFilters")[1].split("]")[0]


# --- backups --------------------------------------------------------------------


def put(root, **some):
    for name, body in some.items():
        path = root / name.replace("__", "/")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)


def tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def test_a_backup_is_copied_verified_and_restored(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    put(src, a__x=b"1" * 10, a__y=b"2" * 5_000_000, b__x=b"1" * 10, c__empty=b"")
    store = backups.Backups(spark, f"file://{tmp_path}/store")
    assert store.labels() == [] and store.make(f"file://{src}", "2026-01-30") == {"files": 4, "read": 4}
    put(src, d__z=b"new")
    os.unlink(src / "b" / "x")
    assert store.make(f"file://{src}", "2026-02-02") == {"files": 4, "read": 1}  # only what is new is read
    assert store.labels() == ["2026-01-30", "2026-02-02"] and store.verify("2026-02-02").count() == 0
    assert store.restore("2026-01-30", f"file://{out}/one").count() == 0
    assert tree(out / "one") == {"a/x": b"1" * 10, "a/y": b"2" * 5_000_000, "b/x": b"1" * 10, "c/empty": b""}
    assert store.restore("2026-02-02", f"file://{out}/two").count() == 0 and tree(out / "two") == tree(src)
    blobs = [p for p in (tmp_path / "store" / "blobs").rglob("*") if p.is_file() and "." not in p.name]
    assert len(blobs) == 4  # equal files share one
    big = max(blobs, key=lambda p: p.stat().st_size)
    big.chmod(0o644)
    big.write_bytes(b"3" * 5_000_000)  # of the same length, so only the digest tells
    assert [tuple(r) for r in store.verify("2026-02-02").collect()] == [("a/y", "broken")]
    assert [tuple(r) for r in store.restore("2026-02-02", f"file://{out}/three").collect()] == [("a/y", "broken")]
    assert tree(out / "three") == {k: v for k, v in tree(src).items() if k != "a/y"}
    os.unlink(big)
    assert [tuple(r) for r in store.verify("2026-01-30").collect()] == [("a/y", "missing")]
    with pytest.raises(KeyError):
        store.verify("2026-03-03")


def test_old_backups_go_and_shared_blobs_stay(spark, tmp_path):
    src = tmp_path / "src"
    store = backups.Backups(spark, f"file://{tmp_path}/store")
    put(src, keep=b"k", old=b"o")
    store.make(f"file://{src}", "2026-01-05")
    os.unlink(src / "old")
    put(src, mid=b"m")
    store.make(f"file://{src}", "2026-01-06")
    os.unlink(src / "mid")
    put(src, late=b"l")
    store.make(f"file://{src}", "2026-01-07")
    assert store.prune(recent=1) == ["2026-01-06"]  # the first of the month and the newest stay
    assert store.labels() == ["2026-01-05", "2026-01-07"]
    assert store.verify("2026-01-05").count() == 0 and store.verify("2026-01-07").count() == 0
    blobs = [p.read_bytes() for p in (tmp_path / "store" / "blobs").rglob("*") if p.is_file() and "." not in p.name]
    assert sorted(blobs) == [b"k", b"l", b"o"]


# --- leases ---------------------------------------------------------------------


def test_one_of_many_creates_a_file(spark, tmp_path):
    path = f"file://{tmp_path}/x/lock"
    assert files.create_once(spark, path, "a") and not files.create_once(spark, path, "b")
    assert files.text_of(spark, path) == "a" and files.text_of(spark, f"{path}2") is None
    assert not files.take_away(spark, path, "b") and files.text_of(spark, path) == "a"
    assert files.take_away(spark, path, "a") and files.text_of(spark, path) is None and not files.take_away(spark, path, "a")


def test_a_dead_drivers_lock_changes_hands(spark, tmp_path):
    book = ledger.Ledger(spark, f"file://{tmp_path}", lease_s=1)
    dead = book.open_run("omo")
    with pytest.raises(ledger.Busy):
        book.open_run("omo")
    time.sleep(1.2)
    live = book.open_run("omo")
    with pytest.raises(ledger.Busy):
        book.renew(dead, "omo")
    book.close_run(dead, "omo", "success")  # too late: the lock isn't its own any more
    book.renew(live, "omo")
    book.close_run(live, "omo", "success")
    assert book.open_run("omo")
    noted = {r.run_id: (r.status, r.error) for r in book.runs().collect()}
    assert noted[live][0] == "success"


def test_a_failing_note_gives_the_lock_back(spark, tmp_path, monkeypatch):
    book = ledger.Ledger(spark, f"file://{tmp_path}")
    with monkeypatch.context() as m:
        m.setattr(ledger.Ledger, "_append", lambda *a: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError, match="full"):
            book.open_run("omo")
    assert book.open_run("omo")


def test_a_dead_writers_claim_is_passed_over(spark, tmp_path, monkeypatch):
    table = snapshots.Table(spark, f"file://{tmp_path}/t")
    rows = spark.createDataFrame([(1,)], "x int")
    assert table.replace(rows, base=0) == 1
    files.create_once(spark, f"file://{tmp_path}/t/claims/2", f"{time.time() - 100:.0f}")
    with pytest.raises(snapshots.Conflict):
        table.replace(rows, base=1)
    monkeypatch.setattr(snapshots, "LEASE_S", 50)
    assert table.replace(rows.selectExpr("x + 1 as x"), base=1) == 3 and table.read().first().x == 2
