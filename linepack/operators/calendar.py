"""Days to work on, as columns."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import nn_posting_day


def expand_days(df: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    """One row per day of [start, end], no future days, with the no-notice day.

    ``as_of`` is the run's own day; rows whose range is empty give no day.
    """
    days = F.sequence(F.col(start), F.least(F.col(end), as_of), F.expr("interval 1 day"))
    return (
        df.where(F.col(start) <= F.least(F.col(end), as_of))
        .withColumn("day", F.explode(days))
        .withColumn("nn_day", nn_posting_day(F.col("day"), as_of))
    )


def daily_range(as_of: date) -> tuple[date, date]:
    """Yesterday and the day itself: yesterday's postings may still have changed."""
    return as_of - timedelta(days=1), as_of


def historic_range(as_of: date) -> tuple[date, date]:
    """The year that ended when postings became final."""
    end = as_of - timedelta(days=fixed.HISTORIC_LAG_DAYS)
    return end - timedelta(days=fixed.HISTORIC_SPAN_DAYS), end
