"""Clock arithmetic on whole nanoseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import UNIX_RANGES

NS_PER_UNIT = {"s": 1_000_000_000, "ms": 1_000_000, "us": 1_000, "ns": 1}


def floor_div(value: Column, divisor: int) -> Column:
    """Exact floor division of a BIGINT; SQL ``div`` truncates toward zero instead."""
    return F.call_function("div", value - F.pmod(value, F.lit(divisor)), F.lit(divisor).cast("bigint"))


def ceil_div(value: Column, divisor: int | Column) -> Column:
    """Ceiling division of a non-negative BIGINT."""
    by = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.call_function("div", (value + by - 1).cast("bigint"), by.cast("bigint"))


def to_unix_ns(value: Column, unit: str, *, whole: bool) -> Column:
    """Clock reading to nanoseconds.

    ``whole`` readings are scaled as integers.  Fractional ones are scaled in two parts: near 1e18
    a DOUBLE only resolves 256 ns, so whole and fractional units must not be multiplied together.
    """
    if unit == "session_relative":
        raise ValueError("session-relative timestamps need an epoch offset first")
    factor = NS_PER_UNIT[unit]
    if whole:
        return value.cast("bigint") * F.lit(factor).cast("bigint")
    units = F.floor(value)
    return units.cast("bigint") * F.lit(factor).cast("bigint") + F.rint(
        (value - units) * F.lit(float(factor))).cast("bigint")


def text_to_unix_ns(text: Column, unit: str) -> Column:
    """Clock text to nanoseconds: whole numbers stay integers, readings with a fraction are scaled in two parts.

    Text that is no number fails the job, NULL stays NULL.
    """
    return F.coalesce(text.try_cast("bigint") * F.lit(NS_PER_UNIT[unit]).cast("bigint"),
                      to_unix_ns(text.cast("double"), unit, whole=False))


def cut_to_whole(text: Column) -> Column:
    """Number text as BIGINT; a fraction is cut off toward zero."""
    return F.coalesce(text.try_cast("bigint"), text.cast("double").cast("bigint"))


def iso_to_unix_ns(text: Column) -> Column:
    """ISO-8601 text to nanoseconds, at microsecond resolution.  Needs a UTC session."""
    return F.unix_micros(F.to_timestamp(text)) * F.lit(1000).cast("bigint")


def seconds_to_ns(seconds: float) -> int:
    return int(round(seconds * 1e9))


def in_any(value: Column, ranges: tuple) -> Column:
    """Is the magnitude of ``value`` inside one of the half-open ranges?"""
    size = F.abs(value)
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | ((size >= F.lit(low)) & (size < F.lit(high)))
    return F.coalesce(hit, F.lit(False))


def in_any_sql(name: str, ranges: tuple) -> str:
    """The same test as SQL text over a column; NULL where that is NULL."""
    return " OR ".join(f"abs({name}) >= {low!r} AND abs({name}) < {high!r}" for low, high in ranges)


def looks_like_unix_time(value: Column) -> Column:
    return in_any(value.cast("double"), UNIX_RANGES)


def rebased_ms(value: Column, origin_ns: Column, *, whole: bool) -> Column:
    """Milliseconds minus the origin; whole milliseconds stay whole."""
    if whole:
        return value - floor_div(origin_ns, 1_000_000)
    return value - origin_ns / F.lit(1e6)
