"""Period bounds from an explicit ``as_of``; nothing in this package reads the clock.

Every period is half-open: ``start`` belongs to it, ``end`` does not. Naive datetimes are UTC
unless ``tz`` says otherwise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo


@dataclass(frozen=True)
class Period:
    """Half-open span of instants with its epoch seconds and calendar dates.

    ``start`` is None for everything before ``end``.
    """

    start: datetime | None
    end: datetime

    @property
    def epochs(self) -> tuple[int | None, int]:
        """Whole epoch seconds ``(a, b)``: ``a <= dt < b`` selects the period."""
        return None if self.start is None else epoch(self.start), epoch(self.end)

    @property
    def dates(self) -> tuple[date | None, date]:
        """First date and the date after the last one."""
        last = self.end - timedelta(microseconds=1)
        return None if self.start is None else self.start.date(), last.date() + timedelta(days=1)


def aware(moment: datetime, tz: str = "UTC") -> datetime:
    zone = timezone.utc if tz == "UTC" else ZoneInfo(tz)
    return moment.replace(tzinfo=zone) if moment.tzinfo is None else moment.astimezone(zone)


def epoch(moment: datetime) -> int:
    """The smallest whole epoch second not before ``moment``."""
    return math.ceil(aware(moment).timestamp())


def _midnight(day: date, tz: str) -> datetime:
    return aware(datetime.combine(day, time.min), tz)


def day_period(day: date, tz: str = "UTC") -> Period:
    return Period(_midnight(day, tz), _midnight(day + timedelta(days=1), tz))


def date_period(first: date, last: date, tz: str = "UTC") -> Period:
    """Both dates included, as on a ``--start-date/--end-date`` command line."""
    if last < first:
        raise ValueError(f"end date {last} is before start date {first}")
    return Period(_midnight(first, tz), _midnight(last + timedelta(days=1), tz))


def month_period(year: int, month: int, tz: str = "UTC") -> Period:
    following = date(year + month // 12, month % 12 + 1, 1)
    return Period(_midnight(date(year, month, 1), tz), _midnight(following, tz))


def week_period(year: int, week: int, tz: str = "UTC") -> Period:
    """The ISO week ``week`` of ISO year ``year``."""
    monday = date.fromisocalendar(year, week, 1)
    return date_period(monday, monday + timedelta(days=6), tz)


def period(kind: str, as_of: datetime, tz: str = "UTC") -> Period:
    """The period a scheduled run at ``as_of`` covers.

    ``hour``: the 60 minutes before ``as_of``. ``day``: yesterday. ``month``/``week``: the
    month or ISO week of yesterday. ``history``: everything before today's midnight.
    """
    now = aware(as_of, tz)
    yesterday = now.date() - timedelta(days=1)
    if kind == "hour":
        return Period(now - timedelta(hours=1), now)
    if kind == "day":
        return day_period(yesterday, tz)
    if kind == "month":
        return month_period(yesterday.year, yesterday.month, tz)
    if kind == "week":
        iso = yesterday.isocalendar()
        return week_period(iso.year, iso.week, tz)
    if kind == "history":
        return Period(None, _midnight(now.date(), tz))
    raise ValueError(f"unknown period kind {kind!r}")
