"""Dates held as text (rows F10-F12, X10, X11)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the rendering of a date-time as text in the retail tables.
DATETIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def as_text(ts: Column) -> Column:
    return F.date_format(ts, DATETIME_TEXT)


def text_to_date(text: Column) -> Column:
    """The calendar day of ``yyyy-MM-dd[ HH:mm:ss]`` text; bad text gives NULL."""
    return F.substring(text, 1, 10).try_cast("date")


def day_epoch_seconds(text: Column) -> Column:
    """Seconds since the epoch of the text's calendar day at midnight UTC (the
    time of day is ignored, as a ``yyyy-MM-dd`` pattern ignores it). Built on
    ``unix_date``, so it does not depend on the session time zone."""
    return F.unix_date(text_to_date(text)).cast("bigint") * F.lit(86400)


def on_or_before_lexical(text: Column, day: str) -> Column:
    """text compared as text (misses times on ``day`` itself)."""
    return text <= F.lit(day)


def on_or_before(text: Column, day: str) -> Column:
    """the parsed day is on or before ``day``."""
    return text_to_date(text) <= F.lit(day).cast("date")


def until_epoch(text: Column, seconds: int) -> Column:
    """The parsed day, in epoch seconds, is not after ``seconds``."""
    return day_epoch_seconds(text) <= F.lit(seconds)


def on_day(text: Column, day: str) -> Column:
    """the parsed day is ``day``."""
    return text_to_date(text) == F.lit(day).cast("date")


def stamped_until(stamp: Column, day: str) -> Column:
    """The stored time is on ``day`` or before, as a bound on the column itself, which
    reaches the scan (no day is computed from it)."""
    return stamp < next_midnight(day)


def stamped_on(stamp: Column, day: str) -> Column:
    """the stored time is on ``day``, as two bounds on the column itself."""
    return (stamp >= F.lit(day).cast("timestamp_ntz")) & (stamp < next_midnight(day))


def next_midnight(day: str) -> Column:
    return F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")


def day_of_epoch(seconds: int) -> str:
    """The calendar day (UTC) that ``seconds`` since the epoch lie in."""
    return (datetime.date(1970, 1, 1) + datetime.timedelta(days=seconds // 86400)).isoformat()


def partitions_until(dated: Column, day: str, unit: str = "day") -> Column:
    """The partitions of a dated table that can hold times until ``day``."""
    return dated <= F.date_trunc(unit, F.lit(day).cast("date")).cast("date")


def partition_of(dated: Column, day: str, unit: str = "day") -> Column:
    """The partition of a dated table that holds ``day``."""
    return dated == F.date_trunc(unit, F.lit(day).cast("date")).cast("date")
