"""The calendar form: business days by ordinals, in place of a list of days per loan.

The array form works out the days of a window and looks into them. Here a day has an ordinal by
arithmetic (`functions.ordinals`), so the window is never written out: "the third business day after"
is an ordinal turned back into a day, "business days between" is a difference. The list of a loan is
read once, for the few closed days of its window. There is no join, no shuffle and no limit to the
number of lists, the length of a list or of a window; each loan takes the same steps.

`calendar_dim` is the same arithmetic as a table, for other tables to join: each day of each list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.functions import ordinals
from clauseloom.model import PAD_DAYS, Pack
from clauseloom.operators.rules import fired


def holiday_lists(loans: DataFrame) -> DataFrame:
    """(holidays, lo, hi, list_id): every holiday list with the days its loans span.

    Partial aggregation leaves one row per list and task, however many loans share the list.
    """
    used = (
        loans.where(F.col("calendar.holidays").isNotNull())
        .groupBy(F.col("calendar.holidays").alias("holidays"))
        .agg(
            F.min(F.date_sub(F.least("cd.issue_date", "closing_date"), PAD_DAYS)).alias("lo"),
            F.max(F.date_add(F.greatest("cd.issue_date", "closing_date"), PAD_DAYS)).alias("hi"),
        )
    )
    return used.where(F.col("lo") <= F.col("hi")).withColumn("list_id", ordinals.list_id(F.col("holidays")))


def calendar_dim(lists: DataFrame) -> DataFrame:
    """(list_id, holidays, day, is_business, n_before): every day of each list's range with the number
    of business days before it. Each row is worked out by itself: nothing is sorted or shuffled."""
    closed = ordinals.closed_days(F.col("holidays"), F.col("lo"), F.col("hi"))
    based = lists.select("list_id", "holidays", "lo", "hi", closed.alias("closed"))
    days = based.select(
        "list_id", "holidays", "lo", "closed",
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"),
    )
    day, closed = F.col("day"), F.col("closed")
    return days.select(
        "list_id", "holidays", "day",
        ((F.weekday(day) != 6) & ~F.array_contains(closed, day)).alias("is_business"),
        (ordinals.ordinal(closed, day) - ordinals.ordinal(closed, F.col("lo"))).alias("n_before"),
    )


def with_calendar(loans: DataFrame, pad: int = PAD_DAYS) -> DataFrame:
    """The loans with `cd_receipt_date` and `n_days` (business days from receipt to closing).

    As in the array form, a missing end of the window leaves the count null, an inverted window or a
    missing list has no days, a mailing before the window counts from its start, and a third day beyond
    the window is none.
    """
    columns = loans.columns
    lo, hi, closed = F.col("window_lo"), F.col("window_hi"), F.col("closed")
    bounded = loans.select(
        *columns, F.date_sub("cd.issue_date", pad).alias("window_lo"),
        F.date_add("closing_date", pad).alias("window_hi"),
    )
    listed = bounded.select(
        *columns, "window_lo", "window_hi",
        F.when(lo <= hi, ordinals.closed_days(F.col("calendar.holidays"), lo, hi)).alias("closed"),
    )
    start = F.greatest(F.date_add("cd.mailed_date", 1), lo)
    mailed = listed.select(
        *columns, "window_lo", "window_hi", "closed",
        F.when(F.col("cd.mailed_date").isNotNull() & closed.isNotNull(),
               ordinals.ordinal(closed, start) + 2).alias("third"),
    )
    found = mailed.select(
        *columns, "window_lo", "window_hi", "closed",
        ordinals.open_day(closed, F.col("third")).alias("third_day"),
    )
    received = found.select(
        *columns, "window_lo", "window_hi", "closed",
        F.when(F.col("cd.delivery_method") == "in_person", F.col("cd.received_date"))
        .when(F.col("third_day") <= hi, F.col("third_day")).alias("cd_receipt_date"),
    )
    begin = F.greatest("cd_receipt_date", lo)
    end = F.least("closing_date", F.date_add(hi, 1))
    held = closed.isNotNull() & F.col("cd_receipt_date").isNotNull() & (begin < end)
    n_days = F.when(lo.isNull() | hi.isNull(), F.lit(None).cast("int")).when(
        held, ordinals.ordinal(closed, end) - ordinals.ordinal(closed, begin)
    ).otherwise(0)
    return received.select(*columns, "cd_receipt_date", n_days.alias("n_days"))


def evaluate_by_calendar(loans: DataFrame, pack: Pack, key: str = "loan_id") -> DataFrame:
    """The verdicts of the timing pack by ordinals: (key, rule_id, result)."""
    ready = with_calendar(loans)
    timeshare = F.col("transaction.timeshare")
    general, shared = range(2)
    cells = ready.select(
        key,
        (~timeshare).alias(f"applies_{general}"),
        (F.col("n_days") >= 3).alias(f"met_{general}"),
        timeshare.alias(f"applies_{shared}"),
        (F.col("cd_receipt_date") <= F.col("closing_date")).alias(f"met_{shared}"),
    )
    return fired(cells, pack, (key,))
