"""Epoch numbers in several units to microseconds, nanoseconds and timestamps."""

from __future__ import annotations

import time
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units accepted for columnar times and their length in microseconds.
MICROS_PER_UNIT = {"s": 1_000_000, "ms": 1_000, "us": 1}
# Units accepted for line-protocol times and their length in nanoseconds.
NANOS_PER_UNIT = {"s": 1_000_000_000, "ms": 1_000_000, "us": 1_000, "ns": 1}


def _scaled(value: Column, factor: int) -> Column:
    # The bigint factor keeps int columns from overflowing; the cast truncates fractions toward zero.
    return (value * F.lit(factor).cast("bigint")).cast("bigint")


def _factor(unit: str, known: dict[str, int]) -> int:
    if unit not in known:
        raise ValueError(f"invalid time unit {unit!r}, expected one of {', '.join(known)}")
    return known[unit]


def to_micros(value: Column, unit: str = "us") -> Column:
    """Epoch microseconds of a number in ``unit``; fractional seconds are kept."""
    return _scaled(value, _factor(unit, MICROS_PER_UNIT))


def to_time(value: Column, unit: str = "us") -> Column:
    """Timestamp of a number in ``unit``."""
    return F.timestamp_micros(to_micros(value, unit))


def to_nanos(value: Column, unit: str = "us") -> Column:
    """Epoch nanoseconds of a number in ``unit``."""
    return _scaled(value, _factor(unit, NANOS_PER_UNIT))


def nanos_to_time(value: Column) -> Column:
    """Timestamp of epoch nanoseconds, floored to the microsecond Spark keeps."""
    thousand = F.lit(1000).cast("bigint")
    floored = value - F.pmod(value, thousand)
    return F.timestamp_micros(F.call_function("div", floored, thousand))


def now_micros() -> int:
    """Current time; jobs take it as an argument so that a run can be repeated."""
    return int(time.time() * 1_000_000)


def moment_of(df: DataFrame, now_us: int | None) -> Column:
    """Microseconds of ``now_us``, else of now: when the job was planned or, in a stream, when the micro-batch was."""
    if now_us is None and df.isStreaming:
        return F.unix_micros(F.current_timestamp())
    return F.lit(now_micros() if now_us is None else now_us).cast("bigint")


def generated_time(base: int | Column, position: Column | None = None) -> Column:
    """Time for rows that came without one: the microsecond ``base``, plus the row's place in its batch."""
    base = F.lit(base).cast("bigint")
    return F.timestamp_micros(base if position is None else base + position)


def as_utc(moment: datetime | date | str) -> datetime:
    """Naive UTC datetime of a datetime, a date or ISO text; naive input counts as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if not isinstance(moment, datetime):
        moment = datetime.combine(moment, datetime.min.time())
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def instant(moment: datetime | date | str) -> Column:
    """Timestamp literal; folded by Catalyst, so it is pushed into scans."""
    return F.lit(as_utc(moment).isoformat(sep=" ")).cast("timestamp")
