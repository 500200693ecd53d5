"""Rounding to decimals by the exact value of a double, ties to the even digit.

``round`` and ``bround`` round the shortest decimal that reads back as the double, and
``format_string`` rounds that half up: 1000.45, which is a little more as a double, becomes
1000.4 with the one, and 1000.25, an exact tie, 1000.3 with the other. A report that rounds by
the exact value says 1000.5 and 1000.2. Here a number times a power of ten is held as a sum
of two doubles that is exact, which decides each case, in plain column arithmetic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# a power of ten as powers of two: products with those are exact
_POWERS = {0: (1,), 1: (8, 2), 2: (64, 32, 4), 3: (1_024, -16, -8)}
_WHOLE = float(1 << 52)  # doubles from here on have no fraction


def _exact_sum(total: tuple[Column, Column], b: Column) -> tuple[Column, Column]:
    """The nearest double of a sum, and what it is off by."""
    a, rest = total
    s = a + b
    part = s - a
    return s, rest + ((a - (s - part)) + (b - part))


def units(x: Column, digits: int) -> Column:
    """``x`` in units of ``10^-digits``, rounded: a whole number as a double."""
    x = x.cast("double")
    first, *more = (x * float(p) for p in _POWERS[digits])
    total, off = reduce(_exact_sum, more, (first, F.lit(0.0)))
    near = total + off  # the nearest double to both, and again what it is off by
    rest = off - (near - total)
    floor = F.floor(near).cast("double")
    over = near - floor
    odd = F.pmod(floor, F.lit(2.0)) == 1
    up = (over > 0.5) | ((over == 0.5) & ((rest > 0) | ((rest == 0) & odd)))
    return floor + F.when(up, 1.0).otherwise(0.0)


def _fine(x: Column, digits: int) -> Column:
    return F.abs(x.cast("double")) < _WHOLE / 10**digits


def rounded(x: Column, digits: int) -> Column:
    """``x`` to ``digits`` decimals, as the nearest double. Null, NaN and infinity stay."""
    return F.when(_fine(x, digits), units(x, digits) / float(10**digits)).otherwise(x.cast("double"))


def fixed(x: Column, digits: int) -> Column:
    """``x`` as text with exactly ``digits`` decimals (one at least)."""
    n = F.abs(units(x, digits)).cast("bigint")
    scale = F.lit(10**digits).cast("bigint")
    sign = F.when(x < 0, "-").otherwise("")
    whole, part = F.call_function("div", n, scale).cast("string"), F.lpad((n % scale).cast("string"), digits, "0")
    other = F.when(x.isNotNull(), F.format_string(f"%.{digits}f", x.cast("double")))
    return F.when(_fine(x, digits), F.concat(sign, whole, F.lit("."), part)).otherwise(other)
