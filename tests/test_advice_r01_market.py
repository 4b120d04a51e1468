"""Registered queries that left out part of their tables, against brute force."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd

from tidemark import plans

DIR = "/root/testdata/sf0.001"


def test_event_dedupe_best_covers_every_customer(spark):
    best, size = {}, {}
    for o in pd.read_parquet(f"{DIR}/orders.parquet").itertuples():
        key = (o.o_custkey, 1900 if pd.isna(o.o_orderdate) else o.o_orderdate.year)
        a, b = (o.o_orderstatus if o.o_orderkey % 3 else None), (o.o_orderpriority if o.o_orderkey % 4 else None)
        rank = ((a is not None) + (b is not None), o.o_orderkey)
        size[key] = size.get(key, 0) + 1
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (*key, o.o_orderkey, a, b))
    got = plans.queries()["event_dedupe_best"](spark, DIR).select("o_custkey", "year", "o_orderkey", "a", "b", "n_rows").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((*row, size[k]) for k, (_, row) in best.items()), key=str)


def test_calendar_coverage_asks_for_every_day(spark):
    calendar = {x.date() for x in pd.read_parquet(f"{DIR}/orders.parquet").o_orderdate.dropna()}
    lines = pd.read_parquet(f"{DIR}/lineitem.parquet").l_shipdate.value_counts()
    have = {day.date() for day, n in lines.items() if n * len(lines) * 4 >= lines.sum() * 3}  # days with under three quarters of the mean are gaps
    assert 0 < len(have) < len(lines)
    first = min(have)

    def complete(day):
        span = {day - timedelta(days=k) for k in range(6)}
        return not (span & calendar) - have and first <= day - timedelta(days=5)

    got = plans.queries()["calendar_coverage"](spark, DIR).collect()
    assert {r.day: r.complete for r in got} == {d: complete(d) for d in calendar} and len(got) == len(calendar)
