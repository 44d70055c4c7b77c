"""Timestamp expressions. All assume the session zone is UTC (``plans.use_utc``)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_utc(text) -> Column:
    """ISO-8601 text to a timestamp.

    Any number of fraction digits is accepted and cut to microseconds. Under
    ANSI mode, the default, text that is no timestamp fails the job.
    """
    return F.to_timestamp(text)


def as_utc(column) -> Column:
    """Zone-less timestamps (as parquet stores them) read as UTC instants."""
    return F.col(column).cast("timestamp") if isinstance(column, str) else column.cast("timestamp")


def micros(column) -> Column:
    return F.unix_micros(column)


def from_micros(column) -> Column:
    return F.timestamp_micros(column)


def start_of_hour(column) -> Column:
    return F.date_trunc("hour", column)
