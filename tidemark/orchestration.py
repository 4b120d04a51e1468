"""Driver-side rules: schedule, due jobs, ledgers, cursors, runners and their child processes."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime, time, timedelta
from time import monotonic, sleep
from zoneinfo import ZoneInfo

from tidemark.functions.dates import ZONE

RETRY = timedelta(minutes=10)
WEEK, WORKDAYS = frozenset(range(7)), frozenset(range(5))


@dataclass(frozen=True)
class Job:
    """``kind`` is daily, intraday or daemon; ``after`` names a job whose success today starts this one."""

    name: str
    args: tuple[str, ...] = ()
    kind: str = "daily"
    days: frozenset[int] = WORKDAYS
    times: tuple[time, ...] = ()
    after: str | None = None
    every: int | None = None
    once: str | None = None


def _daily(name: str, arg: str, *times: str, days: frozenset[int] = WORKDAYS, after: str | None = None) -> Job:
    return Job(name, (arg,), days=days, times=tuple(time.fromisoformat(t) for t in times), after=after)


# The daily schedule in local time, intraday loops and daemons.
SCHEDULE = (
    _daily("market.refdata", "refdata", "08:00"), _daily("market.screener", "screener", "15:20"), _daily("market.price_daily", "price", "15:40"), _daily("market.events", "events", "18:10"),
    _daily("market.snapshot", "snapshot", after="market.events"), _daily("market.fundamentals", "fundamentals", after="market.snapshot"),
    _daily("macro.omo_crawl", "omo", "11:30", "15:30", "18:00", "21:30", days=WEEK), _daily("macro.wichart", "wichart", "08:15", days=WEEK), _daily("global.yahoo", "yahoo", "11:00", days=WEEK),
    _daily("global.binance", "binance", "07:15", days=WEEK), _daily("global.fred", "fred", "05:00", "20:00", days=WEEK), _daily("global.ecb", "fx", "22:30", days=WEEK), _daily("global.lbma", "lbma", "22:30", days=WEEK),
    Job("global.yahoo", ("yahoo", "--intraday"), "intraday", WEEK, every=600), Job("global.binance", ("binance", "--intraday"), "intraday", WEEK, every=300), Job("macro.wichart", ("wichart", "--intraday"), "intraday", WEEK, every=300),
    Job("news.classify", ("classify", "--limit", "1000"), "intraday", WEEK, every=900), Job("news.collect", ("news", "--loop"), "daemon"), Job("market.price_backfill", ("price", "--backfill"), "daemon", once="pass_complete"),
)


@dataclass(frozen=True)
class Run:
    job: str
    status: str
    started: datetime
    stats: dict = field(default_factory=dict)


def today(runs: Iterable[Run], now: datetime) -> list[Run]:
    """Runs of the local day that count: no intraday, subset or dry runs."""
    zone = ZoneInfo(ZONE)
    day = now.astimezone(zone).date()
    return [r for r in runs if r.started.astimezone(zone).date() == day and not any(r.stats.get(k) for k in ("intraday", "subset", "dry_run"))]


def mark(job: Job, now: datetime, runs: Iterable[Run]) -> datetime | None:
    """The time since which a job should have run: its last passed mark, or its parent's last success."""
    if job.after:
        return max((r.started for r in runs if r.job == job.after and r.status == "success"), default=None)
    if now.weekday() not in job.days:
        return None
    return max((datetime.combine(now.date(), t, now.tzinfo) for t in job.times if t <= now.time()), default=None)


def due(schedule: Iterable[Job], now: datetime, runs: Iterable[Run]) -> list[tuple[Job, str]]:
    """Daily jobs that should start now, and why.

    A success or a refusal since the mark settles it, a failure is tried once more
    after ten minutes, and a running job doesn't count (a runner never starts twice).
    """
    here, runs = now.astimezone(ZoneInfo(ZONE)), list(runs)
    out = []
    for job in schedule:
        if job.kind != "daily" or (since := mark(job, here, runs)) is None:
            continue
        own = [r for r in runs if r.job == job.name and r.started >= since]
        if any(r.status == "success" or r.stats.get("guard_refused") for r in own):
            continue
        failed = [r for r in own if r.status == "failed"]
        if not failed:
            out.append((job, "chain" if job.after else "mark"))
        elif len(failed) == 1 and here >= failed[0].started + RETRY:
            out.append((job, "retry"))
    return out


@dataclass
class Runner:
    """One live child per name, ``most`` besides daemons, a pause after failures."""

    most: int = 6
    cool: float = 600.0
    live: dict[str, bool] = field(default_factory=dict)
    resting: dict[str, float] = field(default_factory=dict)
    backoff: dict[str, float] = field(default_factory=dict)

    def may_start(self, job: Job, now: float) -> bool:
        if job.name in self.live or now < self.resting.get(job.name, 0):
            return False
        return job.kind == "daemon" or sum(not d for d in self.live.values()) < self.most

    def started(self, job: Job) -> None:
        self.live[job.name] = job.kind == "daemon"

    def ended(self, job: Job, code: int, now: float) -> None:
        self.live.pop(job.name, None)
        if job.kind == "daemon":
            wait = min(300.0, max(30.0, 2 * self.backoff.get(job.name, 15.0)))
            self.backoff[job.name], self.resting[job.name] = wait, now + wait
        elif code not in (0, 1):
            self.resting[job.name] = now + self.cool
        else:
            self.resting.pop(job.name, None)


def resume(position: int | None, items: list, done: int, failed: bool) -> int:
    """Where a backfill goes on: after what is done, frozen at the first failure, from the start at the end."""
    at = (position or 0) + done
    return at if failed or at < len(items) else 0


def drive(runner: Runner, jobs: Iterable[Job], command: Callable[[Job], list[str]], poll: float = 0.2, clock: Callable[[], float] = monotonic, patience: float | None = None) -> list[tuple[str, int]]:
    """Run jobs as child processes by the runner's rules; returns names and exit codes as they end.

    A job waits until the runner lets it start.  After ``patience`` seconds, or if this
    process is interrupted, children are told to end, and killed if they don't."""
    waiting, live, done, began = list(jobs), {}, [], clock()
    try:
        while waiting or live:
            now = clock()
            for job, child in list(live.items()):
                if (code := child.poll()) is not None:
                    del live[job]
                    runner.ended(job, code, now)
                    done.append((job.name, code))
            for job in [j for j in waiting if runner.may_start(j, now)]:
                if runner.may_start(job, now):  # one that has just started may keep it back
                    waiting.remove(job)
                    live[job] = subprocess.Popen(command(job))
                    runner.started(job)
            if patience is not None and now - began > patience:
                break
            sleep(poll)
    finally:
        for child in live.values():
            child.terminate()
        for job, child in live.items():
            try:
                code = child.wait(5)
            except subprocess.TimeoutExpired:
                child.kill()
                code = child.wait()
            runner.ended(job, code, clock())
            done.append((job.name, code))
    return done
