"""Integer time arithmetic: everything is whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000


def micros(seconds: float) -> int:
    """Seconds given by a caller, as whole microseconds (at least one)."""
    us = round(seconds * SECOND_US)
    if us < 1:
        raise ValueError(f"a duration must be at least one microsecond, got {seconds} s")
    return us


def floor_to(value: Column, step: int) -> Column:
    """Greatest multiple of ``step`` not above ``value``; right for negative values too."""
    return value - F.pmod(value, F.lit(step))


def floor_div(value: Column, step: int) -> Column:
    """Whole steps in ``value``, rounded down, without going through doubles."""
    return F.call_function("div", floor_to(value, step), F.lit(step))


def seconds(us: Column) -> Column:
    return us / F.lit(1e6)


def guarded_rate(count: Column, span_us: Column) -> Column:
    """Events per second; spans under a millisecond count as one millisecond."""
    return count / F.greatest(span_us / F.lit(1e6), F.lit(0.001))
