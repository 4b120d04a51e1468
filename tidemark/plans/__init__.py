"""Registered queries over the test tables and the SQL they must agree with."""

from __future__ import annotations

from tidemark.plans import gates, market, reads, search, stores, writes


def queries() -> dict:
    assert gates and reads and search and stores and writes  # they register their queries on import
    return dict(market.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(market.ORACLES)
