"""Assigning rows to closed periods of fixed length."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_of_millis(millis: Column, period_millis: int) -> Column:
    """Start of the period in epoch millis; integer division, so it truncates toward the epoch."""
    return F.call_function("div", millis, F.lit(period_millis)) * F.lit(period_millis)


def period_of(time: Column, period_millis: int) -> Column:
    return period_of_millis(F.unix_millis(time.cast("timestamp")), period_millis)
