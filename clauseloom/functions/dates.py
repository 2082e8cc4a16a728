"""Day arithmetic. Everything is DateType: timestamps would slip days at daylight-saving changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DAYS = "cast(array() as array<date>)"


def iso_weekday(day: Column) -> Column:
    """Monday 1 to Sunday 7, the numbering rules are written in (Spark's weekday is 0 to 6)."""
    return F.weekday(day) + 1


def window_sql(lo: str, hi: str) -> str:
    """Every day from `lo` to `hi`, both included. An inverted window is empty, not counted
    downwards; a missing end leaves it null."""
    return (
        f"case when {lo} <= {hi} then sequence({lo}, {hi}, interval 1 day)"
        f" when {lo} > {hi} then {NO_DAYS} end"
    )


def weekday_sql(lo: str, hi: str, iso_day: int) -> str:
    """The days of a window that fall on one weekday, stepping by weeks."""
    name = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")[iso_day - 1]
    first = f"next_day(date_sub({lo}, 1), '{name}')"
    return f"if({first} <= {hi}, sequence({first}, {hi}, interval 7 day), {NO_DAYS})"


def open_days_sql(lo: str, hi: str, closed_weekday: int | None, excluded: str | None) -> str:
    """The days of a window without one weekday and without a list of days, in order.

    One hashed set difference per row, no interpreted lambda. A null in the list cannot turn the
    test of a day into null; without any list no day can be shown to count, and the set is empty.
    """
    days = f"sequence({lo}, {hi}, interval 1 day)"
    closed = [weekday_sql(lo, hi, closed_weekday)] if closed_weekday else []
    closed += [excluded] if excluded else []
    if closed:
        days = f"array_except({days}, concat({', '.join(closed)}))"
    if excluded:
        days = f"if({excluded} is null, {NO_DAYS}, {days})"
    return f"case when {lo} <= {hi} then {days} when {lo} > {hi} then {NO_DAYS} end"


def nth_day_after(days: Column, after: Column, n: int) -> Column:
    """The n-th (from 1) of `days` strictly after `after`; null when there are fewer."""
    return F.get(F.filter(days, lambda d: d > after), F.lit(n - 1))


def count_days_between(days: Column, start: Column, end: Column) -> Column:
    """How many of `days` lie in `[start, end)`. A missing bound leaves none."""
    return F.size(F.filter(days, lambda d: (d >= start) & (d < end)))


def receipt_date(method: Column, received: Column, mailed: Column, days: Column) -> Column:
    """In person: the recorded date. Any other method, also a missing one: the third business
    day after mailing."""
    return F.when(method == "in_person", received).otherwise(nth_day_after(days, mailed, 3))
