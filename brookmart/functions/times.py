"""Time conversions between text, epoch milliseconds and timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from brookmart.schemas import DATETIME

_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000,
            "hour": 3_600_000, "day": 86_400_000}


def duration_ms(text: str) -> int:
    """'45 minutes' -> 2700000."""
    number, unit = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower()).groups()
    return int(number) * _UNIT_MS[unit]


def text_to_time(c: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> timestamp, null where it is none.

    A cast is far cheaper than a pattern.
    """
    return (F.col(c) if isinstance(c, str) else c).try_cast("timestamp")


def text_to_millis(c: Column | str, fmt: str | None = None) -> Column:
    return F.unix_millis(F.to_timestamp(c, fmt) if fmt else text_to_time(c))


def millis_to_text(c: Column | str, fmt: str = DATETIME) -> Column:
    return F.date_format(F.timestamp_millis(c), fmt)


def event_time(c: Column | str) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(c)


def utc_to_zone(c: Column | str, zone: str = "Asia/Shanghai") -> Column:
    """Text of a UTC time -> text of the same instant in `zone`."""
    return F.date_format(F.from_utc_timestamp(text_to_time(c), zone), DATETIME)


def yyyymmdd(c: Column | str) -> Column:
    """Text of a time -> day as the integer yyyyMMdd."""
    return F.date_format(text_to_time(c), "yyyyMMdd").cast("int")


def age_in_years(birthday: Column | str, as_of: Column) -> Column:
    """Whole days lived over 365, cut to a whole number."""
    return F.floor(F.datediff(as_of, F.to_date(birthday)) / 365).cast("int")


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def day_of(at: Column, zone: str | None = None) -> Column:
    """Day of an instant as `yyyy-MM-dd`, in `zone` or the session's time zone."""
    local = F.convert_timezone(None, F.lit(zone), at.cast("timestamp_ntz")) if zone else at
    return F.date_format(local, "yyyy-MM-dd")
