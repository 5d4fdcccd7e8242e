"""Business days, retention dates and review dates.

Weekdays are counted in closed form from a Monday, so no date array is built.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY = dt.date(1970, 1, 5)


def _weekdays_until(day: Column) -> Column:
    """Weekdays from the reference Monday up to and including `day`."""
    n = F.datediff(day, F.lit(MONDAY))
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))


def business_days(start: Column, end: Column, holidays: list[dt.date] | None = None) -> Column:
    """Business days after `start` up to and including `end`; the opening day does not count."""
    total = _weekdays_until(end) - _weekdays_until(start)
    days_off = sorted({h for h in holidays or [] if h.weekday() < 5})
    if days_off:
        within = F.filter(
            F.array(*[F.lit(h) for h in days_off]), lambda h: (h > start) & (h <= end)
        )
        total = total - F.size(within)
    return total.cast("int")


def add_business_days(start: Column, days: int, holidays: list[dt.date] | None = None) -> Column:
    """The date on which `days` business days after `start` have passed."""
    days_off = sorted({h for h in holidays or [] if h.weekday() < 5})
    if not days_off:
        return _add_weekdays(start, F.lit(days))
    if days == 0:  # the last open day up to `start`, as without holidays
        late_first = F.array(*[F.lit(h) for h in reversed(days_off)])
        return F.aggregate(
            late_first, _add_weekdays(start, F.lit(0)),
            lambda day, h: F.when(h == day, _add_weekdays(F.date_sub(h, 1), F.lit(0))).otherwise(day),
        )
    # In ascending order each holiday up to the day reached so far moves it by one.
    moved = F.aggregate(
        F.array(*[F.lit(h) for h in days_off]), F.lit(0),
        lambda n, h: n + F.when(
            (h > start) & (h <= _add_weekdays(start, F.lit(days) + n)), 1).otherwise(0),
    )
    return _add_weekdays(start, F.lit(days) + moved)


def _add_weekdays(start: Column, days: Column) -> Column:
    ordinal = _weekdays_until(start) + days - 1
    offset = F.floor(ordinal / 5) * 7 + F.pmod(ordinal, F.lit(5))
    return F.date_add(F.lit(MONDAY), offset.cast("int"))


def retention_due_date(ts: Column, days: Column) -> Column:
    return F.date_add(ts.cast("date"), days)


def next_review_date(day: Column) -> Column:
    """First Monday of January, April, July or October on or after `day`."""

    def first_monday(quarter_start: Column) -> Column:
        return F.next_day(F.date_sub(quarter_start, 1), "MON")

    start = F.trunc(day, "quarter")
    this_quarter = first_monday(start)
    return F.when(day <= this_quarter, this_quarter).otherwise(
        first_monday(F.add_months(start, 3))
    )
