"""Dates and times: exchange-local days, epochs, period anchors, feed dates."""

from __future__ import annotations

from datetime import UTC, date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Ho_Chi_Minh"


def local_date(ts: Column, zone: Column | str = ZONE) -> Column:
    """Day of an instant in a zone, whatever the session's zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.from_utc_timestamp(ts, zone)) / 86400).cast("int"))


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def from_millis(x: Column) -> Column:
    return F.timestamp_millis(x.cast("long"))


def from_seconds(x: Column) -> Column:
    return F.timestamp_seconds(x.cast("long"))


def from_local(text: Column, pattern: str = "dd/MM/yyyy HH:mm:ss", zone: str = ZONE) -> Column:
    """Exchange-local text to an instant; null if it doesn't parse."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(pattern)), zone)


def day_bounds(day: Column, zone: str = ZONE) -> tuple[Column, Column]:
    """First instant of a local day and of the next."""
    start = lambda d: F.to_utc_timestamp(d.cast("timestamp"), zone)
    return start(day), start(F.date_add(day, 1))


def period_anchor(day: Column, freq: Column) -> Column:
    """Start of the period: d the day, m the month, q the quarter that ends in the month, y the year.

    A quarter must be dated in March, June, September or December; others give null.
    """
    quarter = F.when(F.month(day) % 3 == 0, F.trunc(day, "quarter"))
    return F.when(freq == "d", day).when(freq == "m", F.trunc(day, "month")).when(freq == "q", quarter).when(freq == "y", F.trunc(day, "year"))


def feed_time(text: Column) -> Column:
    """Instants of the date forms that feeds use, local time where they name no zone; else null."""
    t = F.regexp_replace(F.trim(text), r"GMT\+7$", "+0700")
    zoned = [F.try_to_timestamp(F.regexp_replace(t, r"^[A-Za-z]{3},\s*", ""), F.lit(p)) for p in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss zzz")]
    iso = F.when(t.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d)?([+-]\d\d:?\d\d|Z)$"), t.try_cast("timestamp"))
    local = [F.to_utc_timestamp(F.try_to_timestamp(t, F.lit(p)), ZONE) for p in ("M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")]
    return F.coalesce(*zoned, iso, *local)


def time_in_url(url: Column) -> Column:
    """Local times that article addresses carry: ``-102yyMMddHHmmss…`` or year, unpadded month
    and day, ``HHmmss`` and a serial; the widest reading that is a date wins."""
    short = from_local(F.regexp_extract(url, r"-102(\d{12})\d+\.htm", 1), "yyMMddHHmmss")
    s = F.regexp_extract(url, r"-(\d{15,16})\.htm", 1)
    read = []
    for m in (2, 1):
        for d in (2, 1):
            text = F.concat_ws(" ", F.substring(s, 1, 4), F.substring(s, 5, m), F.substring(s, 5 + m, d), F.substring(s, 5 + m + d, 6))
            read.append(F.when(F.length(s) >= 10 + m + d, from_local(text, "yyyy M d HHmmss")))
    return F.coalesce(short, *read)


def in_session(now: datetime, opens: time = time(8, 30), closes: time = time(15, 15)) -> bool:
    """Whether a weekday's trading window holds ``now`` (an aware time)."""
    here = now.astimezone(ZoneInfo(ZONE))
    return here.weekday() < 5 and opens <= here.time() < closes


def next_session(now: datetime, opens: time = time(8, 30)) -> datetime:
    here = now.astimezone(ZoneInfo(ZONE))
    day = here.date() if here.time() < opens else here.date() + timedelta(days=1)
    while day.weekday() >= 5:
        day += timedelta(days=1)
    return datetime.combine(day, opens, ZoneInfo(ZONE))


def today(now: datetime | None = None) -> date:
    return (now or datetime.now(UTC)).astimezone(ZoneInfo(ZONE)).date()
