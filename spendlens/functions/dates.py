"""Driver-side arithmetic on ``as_of``.

Operators never read the clock. They turn ``as_of`` into literal calendar days here, so the
bound reaches the scan as a constant (partition pruning, row-group pruning).
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, time, timedelta


def as_datetime(moment: date | datetime) -> datetime:
    return moment if isinstance(moment, datetime) else datetime.combine(moment, time.min)


def months_before(moment: date | datetime, months: int) -> datetime:
    """``moment`` minus calendar months; the day is clamped to the target month's length."""
    moment = as_datetime(moment)
    index = moment.year * 12 + moment.month - 1 - months
    year, month = index // 12, index % 12 + 1
    return moment.replace(year=year, month=month, day=min(moment.day, calendar.monthrange(year, month)[1]))


def days_before(moment: date | datetime, days: int) -> datetime:
    return as_datetime(moment) - timedelta(days=days)


def first_day_from(moment: date | datetime) -> date:
    """First calendar day whose midnight is not before ``moment``."""
    moment = as_datetime(moment)
    return moment.date() if moment.time() == time.min else moment.date() + timedelta(days=1)


def last_day_until(moment: date | datetime) -> date:
    """Last calendar day whose midnight is not after ``moment``."""
    return as_datetime(moment).date()


def date_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def last_day_of_month(moment: date | datetime) -> int:
    return calendar.monthrange(moment.year, moment.month)[1]
