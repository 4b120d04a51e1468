"""Polite fetching behind an injected ``get``: gaps, retries, page loops, a breaker.

Network access stays on the driver and outside this package; tests and replays
inject a function that reads files.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator


class GaveUp(RuntimeError):
    """A source failed after all retries, or too often in a row."""


def fetch(get: Callable[[str], str], url: str, classify: Callable[[str], str] = lambda _: "ok", waits: tuple[float, ...] = (2, 4, 8), gap: tuple[float, float] = (1, 5), sleep: Callable[[float], None] = time.sleep) -> str:
    """Body of ``url``; ``classify`` calls a body ``ok``, ``retry`` or ``bad``."""
    sleep(random.uniform(*gap))
    for wait in (*waits, None):
        try:
            body = get(url)
            verdict = classify(body)
        except OSError:
            body, verdict = "", "retry"
        if verdict == "ok":
            return body
        if verdict == "bad" or wait is None:
            break
        sleep(wait)
    raise GaveUp(url)


def pages(load: Callable[[int], tuple[list, int | None]], size: int, most: int | None = None) -> Iterator[list]:
    """Pages from 1 on, until a short page, ``most`` pages, or the count that the source names."""
    page = 1
    while True:
        items, total = load(page)
        yield items
        if len(items) < size or page == most or (total is not None and page >= -(-total // size)):
            return
        page += 1


def all_of(names: list[str], load: Callable[[str], object], most_failures: int = 10) -> tuple[dict[str, object], list[str]]:
    """Results by name and the failed names; so many failures in a row open the breaker."""
    done, failed, row = {}, [], 0
    for name in names:
        try:
            done[name], row = load(name), 0
        except GaveUp:
            failed.append(name)
            row += 1
            if row >= most_failures:
                raise
    return done, failed
