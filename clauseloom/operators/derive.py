"""Per-loan derivations as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.functions import dates
from clauseloom.model import PAD_DAYS


LO, HI = "date_sub(cd.issue_date, {pad})", "date_add(closing_date, {pad})"


def day_windows(loans: DataFrame, key: str = "loan_id", pad: int = PAD_DAYS) -> DataFrame:
    """(key, window): the padded days from issue to closing."""
    window = F.expr(dates.window_sql(LO.format(pad=pad), HI.format(pad=pad)))
    return loans.select(key, window.alias("window"))


def business_days(pad: int = PAD_DAYS):
    """The window days that are neither a Sunday nor a listed holiday."""
    lo, hi = LO.format(pad=pad), HI.format(pad=pad)
    return F.expr(dates.open_days_sql(lo, hi, 7, "calendar.holidays"))


def business_day_sets(loans: DataFrame, key: str = "loan_id", pad: int = PAD_DAYS) -> DataFrame:
    """(key, days): the window days that count."""
    return loans.select(key, business_days(pad).alias("days"))


def receipt_dates(loans: DataFrame, key: str = "loan_id", pad: int = PAD_DAYS) -> DataFrame:
    """(key, cd_receipt_date, closing_date, days) with the business days kept for later steps."""
    based = loans.withColumn("days", business_days(pad))
    received = dates.receipt_date(
        F.col("cd.delivery_method"), F.col("cd.received_date"), F.col("cd.mailed_date"), F.col("days")
    )
    return based.select(key, received.alias("cd_receipt_date"), "closing_date", "days")


def days_before_closing(loans: DataFrame, key: str = "loan_id", pad: int = PAD_DAYS) -> DataFrame:
    """(key, cd_receipt_date, n_days): business days from receipt up to, not including, closing."""
    return receipt_dates(loans, key, pad).select(
        key,
        "cd_receipt_date",
        dates.count_days_between(
            F.col("days"), F.col("cd_receipt_date"), F.col("closing_date")
        ).alias("n_days"),
    )
