"""Day numbers, epoch milliseconds and hour stamps; ``now`` can be injected for repeatable runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def now_column(now: Column | None = None) -> Column:
    return F.current_timestamp() if now is None else now


def day_number(ts: Column) -> Column:
    """Day as a ``yyyyMMdd`` int."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def today_number(now: Column | None = None) -> Column:
    return day_number(now_column(now))


def epoch_millis_text(now: Column | None = None) -> Column:
    return F.unix_millis(now_column(now)).cast("string")


def hour_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH")


def day_start(day: int) -> Column:
    """First instant of a ``yyyyMMdd`` day; 0 means today."""
    if day == 0:
        return F.current_date()
    return F.lit(dt.datetime.strptime(str(day), "%Y%m%d").date())


def on_day(ts: str, day: int) -> Column:
    """Half-open range test on the raw column, which reaches the scan as a pushed filter."""
    start = day_start(day)
    return (F.col(ts) >= start) & (F.col(ts) < F.date_add(start, 1))
