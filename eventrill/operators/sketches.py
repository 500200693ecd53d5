"""Latency percentiles from mergeable sketches: stored per window, merged over any span.

The exact summary (``load.latency_summary``) reads every sample for every question. Here a
window's samples are summarised once, by the KLL sketches of Spark, in an aggregate with a
map-side part: what is shuffled and stored is a sketch per task, window and group, whatever
the number of samples. A question about any span of windows merges their sketches. An
answer's rank is off by a share of the samples that ``k`` fixes, not their number: about 1.3 %
for 200, 0.35 % for 800, in 99 of 100 answers. Count, mean, least and greatest stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrill.functions.times import floor_to, micros
from eventrill.operators.load import PERCENTILES

SKETCH_K = 800
RANK_ERROR = {200: 0.0133, 800: 0.0035}  # fixed values: normalised rank error of one answer, 99 of 100


def sketch_windows(
    samples: DataFrame, column: str, size_s: float, by: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    """Per window and group ``start_us, by, samples, total, least, greatest, sketch``: a table to store."""
    value = F.col(column).cast("double")
    start = floor_to(F.col("ts_us"), micros(size_s)).alias("start_us")
    return samples.where(value.isNotNull()).groupBy(start, *by).agg(
        F.count(value).alias("samples"), F.sum(value).alias("total"), F.min(value).alias("least"),
        F.max(value).alias("greatest"), F.kll_sketch_agg_double(value, k).alias("sketch"),
    )


def merged_sketches(
    windows: DataFrame, by: Sequence[str] = (), from_us: int | None = None, to_us: int | None = None, k: int = SKETCH_K
) -> DataFrame:
    """The windows that start in ``[from_us, to_us)`` as one, per group of ``by``."""
    if from_us is not None:
        windows = windows.where(F.col("start_us") >= from_us)
    if to_us is not None:
        windows = windows.where(F.col("start_us") < to_us)
    return windows.groupBy(*by).agg(
        F.sum("samples").alias("samples"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double("sketch", k).alias("sketch"),
    )


def summary(sketches: DataFrame, by: Sequence[str] = (), percentiles: dict[str, float] = PERCENTILES) -> DataFrame:
    """The latency summary of each row: exact but for the percentiles."""
    at = [F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100.0)).alias(name) for name, p in percentiles.items()]
    mean = (F.col("total") / F.col("samples")).alias("mean_ms")
    known = sketches.where(F.col("samples") > 0)
    return known.select(*by, "samples", mean, *at, F.col("least").alias("min_ms"), F.col("greatest").alias("max_ms"))
