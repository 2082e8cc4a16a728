"""Business days by arithmetic: every day has a number, and no day becomes a row or an array entry.

Days are counted from a Monday. The days before a day that are no Sunday are that count less one in
seven. The business days before it are those less the closed days before it, where closed days are the
listed holidays that are no Sunday, once each and in order. So "business days from a to b" is a
difference of two ordinals, and "the n-th business day" is an ordinal turned back into a day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY = 4  # 1970-01-05, days since 1970-01-01


def _whole(number: Column, by: int) -> Column:
    """Division that rounds down, also below zero."""
    return ((number - F.pmod(number, F.lit(by))) / by).cast("int")


def weekdays_before(day: Column) -> Column:
    """How many days from the first Monday up to, not including, `day` are no Sunday."""
    number = F.unix_date(day) - MONDAY
    return number - _whole(number, 7)


def day_at(weekdays: Column) -> Column:
    """The day that is no Sunday and has so many such days before it."""
    return F.date_from_unix_date(_whole(weekdays, 6) * 7 + F.pmod(weekdays, F.lit(6)) + MONDAY)


def list_id(holidays: Column) -> Column:
    """A 64-bit id of a holiday list, the same for any order, for repeats and for nulls in it."""
    return F.xxhash64(F.sort_array(F.array_distinct(F.array_compact(holidays))))


def closed_days(holidays: Column, lo: Column, hi: Column) -> Column:
    """The listed days of a window that are no Sunday, each once, in order. A window has few, so all
    that follows works on a short array, however long the list."""
    inside = F.filter(holidays, lambda h: (h >= lo) & (h <= hi) & (F.weekday(h) != 6))
    return F.sort_array(F.array_distinct(inside))


def ordinal(closed: Column, day: Column) -> Column:
    """The number of business days before `day`. Only differences mean anything: closed days before
    the window are not counted."""
    return weekdays_before(day) - F.size(F.filter(closed, lambda h: h < day))


def open_day(closed: Column, number: Column) -> Column:
    """The business day with the ordinal `number`. A closed day lies before it if no more than
    `number` business days lie before the closed day."""
    passed = F.filter(closed, lambda h, i: weekdays_before(h) - i <= number)
    return day_at(number + F.size(passed))
