"""Decoding the time encodings of change messages, and time slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_date(days: Column) -> Column:
    """Days since the epoch to a date."""
    return F.date_from_unix_date(days.cast("int"))


def decode_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def decode_micros(us: Column) -> Column:
    return F.timestamp_micros(us.cast("bigint"))


def decode_iso(text: Column) -> Column:
    """ISO text to a timestamp; NULL when it is not one."""
    return F.try_to_timestamp(text)


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a timestamp with or without zone (session zone UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def since(ts: Column, as_of: Column, seconds: int) -> Column:
    """True for the slice of the last ``seconds`` up to ``as_of``."""
    return ts >= as_of - F.make_dt_interval(secs=F.lit(seconds))
