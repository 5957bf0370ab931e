"""Date math, calendar rounding and time-zone shifts on zone-less UTC timestamps.

The moment "now" is always an argument: a query gives the same answer on every run and a
retried task agrees with the first attempt.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Unit letters of date math and the calendar units they stand for.
UNITS = {
    "y": "YEAR", "M": "MONTH", "w": "WEEK", "d": "DAY",
    "h": "HOUR", "H": "HOUR", "m": "MINUTE", "s": "SECOND",
}
# Names accepted for calendar intervals.
CALENDAR = {
    "second": "SECOND", "1s": "SECOND", "minute": "MINUTE", "1m": "MINUTE",
    "hour": "HOUR", "1h": "HOUR", "day": "DAY", "1d": "DAY", "week": "WEEK", "1w": "WEEK",
    "month": "MONTH", "1M": "MONTH", "quarter": "QUARTER", "1q": "QUARTER",
    "year": "YEAR", "1y": "YEAR",
}
# Microseconds in each fixed unit.
MICROS = {
    "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000,
}


def ntz(value: str | datetime | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def trunc(unit: str, ts: Column) -> Column:
    """Floor to a calendar unit; weeks start on Monday."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def shift(ts: Column, amount: int, unit: str) -> Column:
    return F.timestamp_add(unit, F.lit(amount), ts)


def date_math(expression: str, now: str | datetime | Column) -> Column:
    """``now-3630s``, ``now+1M/d`` or ``2024-01-05||-1w``, as a constant Column.

    The result folds to a literal, so a range over it still reaches the file scan.
    """
    if expression.startswith("now"):
        base, rest = ntz(now), expression[3:]
    else:
        anchor, _, rest = expression.partition("||")
        base = ntz(anchor)
    if not re.fullmatch(r"([+-]\d+[yMwdhHms]|/[yMwdhHms])*", rest):
        raise ValueError(f"not a date expression: {expression!r}")
    for sign, amount, unit, floor in re.findall(r"([+-])(\d+)([yMwdhHms])|/([yMwdhHms])", rest):
        if floor:
            base = trunc(UNITS[floor], base)
        else:
            base = shift(base, int(sign + amount), UNITS[unit])
    return base


def duration_micros(text: str) -> int:
    """``30s``, ``3h``, ``+6h`` or ``-1d`` as microseconds."""
    m = re.fullmatch(r"([+-]?)(\d+)(ms|s|m|h|d)", text)
    if not m:
        raise ValueError(f"not a fixed duration: {text!r}")
    return int(m[1] + "1") * int(m[2]) * MICROS[m[3]]


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", ntz("1970-01-01 00:00:00"), ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, ntz("1970-01-01 00:00:00"))


def to_zone(ts: Column, zone: str) -> Column:
    """Local wall time of a UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def from_zone(local: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


HOUR = 3_600_000_000


def is_short(calendar: str | None, fixed: str | None) -> bool:
    """Whether buckets are an hour long at most. Such buckets are counted in elapsed time, so an hour
    that the clocks repeat is two buckets; longer ones are counted in local time."""
    if calendar:
        return CALENDAR[calendar] in ("SECOND", "MINUTE", "HOUR")
    return duration_micros(fixed) <= HOUR


def _micros_bucket(us: Column, width: int, move: int) -> Column:
    return us - F.pmod(us - F.lit(move), F.lit(width))


def calendar_bucket(ts, unit: str, zone: str | None = None, offset: str | None = None) -> Column:
    """Start of the calendar bucket, in UTC."""
    t = col(ts)
    local = to_zone(t, zone) if zone else t
    us = duration_micros(offset) if offset else 0
    start = local if not us else F.timestamp_add("MICROSECOND", F.lit(-us), local)
    start = trunc(CALENDAR[unit], start)
    if us:
        start = F.timestamp_add("MICROSECOND", F.lit(us), start)
    if not zone:
        return start
    if is_short(unit, None):
        return from_micros(epoch_micros(t) - (epoch_micros(local) - epoch_micros(start)))
    return from_zone(start, zone)


def fixed_bucket(ts, interval: str, zone: str | None = None, offset: str | None = None) -> Column:
    """Start of the fixed-width bucket, in UTC; widths are counted from the epoch, in local time
    when a zone is given."""
    t = col(ts)
    width, move = duration_micros(interval), duration_micros(offset) if offset else 0
    if not zone:
        return from_micros(_micros_bucket(epoch_micros(t), width, move))
    local = epoch_micros(to_zone(t, zone))
    start = _micros_bucket(local, width, move)
    if is_short(None, interval):
        return from_micros(epoch_micros(t) - (local - start))
    return from_zone(from_micros(start), zone)


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
