"""Time helpers.  All timestamps are TIMESTAMP_NTZ."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def one_hour() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def ntz_literal(value: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal.  Goes through a string cast, which does not
    depend on the Python or session time zone."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def lookback_start(as_of: dt.datetime, days: int) -> dt.datetime:
    """``as_of - INTERVAL days DAYS``; ``as_of`` replaces ``current_timestamp()``
    so that results are reproducible."""
    return as_of - dt.timedelta(days=days)


def first_date_on_or_after(instant: dt.datetime) -> dt.date:
    """Smallest DATE d with ``CAST(d AS TIMESTAMP) >= instant`` (a date
    compared with a timestamp is promoted to midnight)."""
    d = instant.date()
    if instant.time() != dt.time(0, 0):
        d = d + dt.timedelta(days=1)
    return d


def hour_floor(ts: Column) -> Column:
    """``date_trunc('HOUR', ts)`` kept as TIMESTAMP_NTZ."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds, as ``unix_timestamp`` gives them."""
    return F.unix_timestamp(ts)
