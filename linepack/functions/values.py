"""Quantities, dates and differences, each from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def quantity(text: Column) -> Column:
    """Posted quantity to double: commas out, two decimals, null where unreadable."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("decimal(38,2)").cast("double")


def number(text: Column) -> Column:
    """Plain number to double; null for anything that is not plain digits."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def oa_day(text: Column) -> Column:
    return F.try_to_date(text, fixed.OA_DAY_FORMAT)


def nn_day(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(fixed.NN_TIME_FORMAT)).cast("date")


def gas_month(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("long")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def nn_posting_day(day: Column, as_of: Column) -> Column:
    """No-notice figures lag: ask for the earlier of the day and four days ago."""
    return F.least(day, F.date_sub(as_of, fixed.NN_LAG_DAYS))


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds as decimal, 0 while the end is open; no time zone involved."""
    gap = end - start
    seconds = (
        F.extract(F.lit("DAY"), gap) * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
        + F.extract(F.lit("SECOND"), gap)
    )
    return F.coalesce(seconds.cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))
