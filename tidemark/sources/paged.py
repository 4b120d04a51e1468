"""Paged sources as data sources: a partition per key, or per range of pages of a key.

The transport is injected: ``get(url)`` returns a :class:`Reply` or raises ``OSError``.
Tasks fetch, retry, pause and stop by a :class:`Policy`; what a key gave comes back as
rows of documents, and a key that failed as a row with its error.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.http import GaveUp

#: Of a page: its key and number, the text, how often it was asked for, and the key's error.
PAGES = "code string, page int, body string, tries int, error string"


class Banned(RuntimeError):
    """The source has shut us out: everything stops, nothing is tried again."""


@dataclass(frozen=True)
class Reply:
    status: int
    body: str
    headers: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Policy:
    """Waits before each new try; a share header and the value from which a task pauses; statuses
    after which nothing is asked any more; failed keys in a row that open the breaker."""

    waits: tuple[float, ...] = (2, 4, 8)
    weight_header: str | None = None
    weight_most: int = 3000
    pause_s: float = 60
    stop_on: tuple[int, ...] = (418,)
    most_failures: int = 10


@dataclass(frozen=True)
class Feed:
    """Where pages are and how they end.

    ``url(code, page, after)`` addresses a page; ``after`` is what ``position`` said of the
    page before (None at first).  ``classify(status, body)`` is ``ok``, ``retry`` or
    ``bad``.  ``size(body)`` counts items: a page with fewer than ``full`` is the last.
    ``pages(body)``, if known from the first page, bounds their number.
    """

    url: Callable[[str, int, object], str]
    classify: Callable[[int, str], str]
    size: Callable[[str], int]
    full: int
    position: Callable[[str], object] = lambda _: None
    pages: Callable[[str], int | None] = lambda _: None
    most: int | None = None


def fetch(get: Callable[[str], Reply], url: str, feed: Feed, policy: Policy, sleep: Callable[[float], None]) -> tuple[Reply, int]:
    """A good reply and the number of tries; :class:`GaveUp` after the last one, or at once if the reply has a bad shape."""
    for tries, wait in enumerate((*policy.waits, None), 1):
        try:
            reply = get(url)
        except OSError:
            reply = None
        if reply is not None and reply.status in policy.stop_on:
            raise Banned(f"{reply.status} of {url}")
        verdict = "retry" if reply is None else feed.classify(reply.status, reply.body)
        if verdict == "ok":
            return reply, tries
        if verdict == "bad" or wait is None:
            raise GaveUp(f"{'bad shape' if verdict == 'bad' else 'no answer'} after {tries}: {url}")
        sleep(wait)
    raise AssertionError


def pages_of(code: str, get: Callable[[str], Reply], feed: Feed, policy: Policy, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """``PAGES`` rows of a key, until a short page, the number that the source names, or ``most``."""
    page, after, known = 1, None, feed.most
    while True:
        try:
            reply, tries = fetch(get, feed.url(code, page, after), feed, policy, sleep)
        except GaveUp as e:
            yield code, page, None, None, str(e)
            return
        yield code, page, reply.body, tries, None
        weight = next((v for k, v in reply.headers.items() if policy.weight_header and k.lower() == policy.weight_header.lower()), None)
        if weight and int(weight) >= policy.weight_most:
            sleep(policy.pause_s)
        if page == 1 and (named := feed.pages(reply.body)) is not None:
            known = named if known is None else min(named, known)
        if feed.size(reply.body) < feed.full or (known is not None and page >= known):
            return
        page, after = page + 1, feed.position(reply.body)


@dataclass
class _Keys(InputPartition):
    codes: list[str]


def source(name: str, codes: Sequence[str], get: Callable[[str], Reply], feed: Feed, policy: Policy = Policy(), lanes: int = 1, sleep: Callable[[float], None] = time.sleep) -> type[DataSource]:  # noqa: B008 - frozen
    """A data source ``name`` of the pages of ``codes``.

    ``lanes`` is how many keys may be asked for at a time: a source's limits hold for the
    lane, so one lane is the polite form.  A lane's breaker opens after so many keys in
    a row that failed, and a ban stops it: the task fails, Spark's retries ask again.
    """
    own = [list(codes[i::lanes]) for i in range(lanes)]

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [_Keys(x) for x in own if x]

        def read(self, partition: _Keys) -> Iterator[tuple]:
            row = 0
            for code in partition.codes:
                failed = False
                for page in pages_of(code, get, feed, policy, sleep):
                    failed = page[4] is not None
                    yield page
                row = row + 1 if failed else 0
                if row >= policy.most_failures:
                    raise GaveUp(f"{row} keys in a row failed, {code} last")

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGES

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Paged


def read(spark: SparkSession, source_: type[DataSource]) -> DataFrame:
    """Pages of a source, as ``spark.read`` gives them."""
    spark.dataSource.register(source_)
    return spark.read.format(source_.name()).load()
