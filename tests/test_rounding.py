"""Rounding by the exact value of a double, beside Python's own."""

import math
import random

import pytest
from pyspark.sql import functions as F

from eventrill.functions.rounding import fixed, rounded

SPECIAL = [0.25, 0.35, 1000.45, 1000.25, 2.5, 0.05, -0.04, -0.05, 0.0, 1e15, -1e17, 5e-324, 0.5, 1.5, 2.675, 1.005, 66866.4405, -66790.5365]


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_as_python_rounds(spark, digits):
    rng = random.Random(digits)
    numbers = [rng.randrange(-(10**9), 10**9) / rng.choice([8, 16, 20, 40, 1_000, 10**4, 10**6]) for _ in range(20_000)]
    numbers += [rng.randrange(-(10**6), 10**6) / 1_000 + 0.0005 for _ in range(2_000)] + SPECIAL
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", fixed(F.col("x"), digits), rounded(F.col("x"), digits))
    for x, text, value in rows.collect():
        assert (text, value) == (f"{x:.{digits}f}", round(x, digits)), x


def test_what_is_no_number(spark):
    rows = spark.createDataFrame([(None,), (math.nan,), (math.inf,)], "x double").select(rounded(F.col("x"), 2), fixed(F.col("x"), 1))
    values = [tuple(r) for r in rows.collect()]
    assert values[0] == (None, None) and math.isnan(values[1][0]) and values[2][0] == math.inf
