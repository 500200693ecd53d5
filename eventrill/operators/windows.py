"""Tumbling, sliding and session windows over the whole stream or per key.

Windows are aggregates, never lists of rows: ``start_us, end_us, count`` (plus any
``by`` columns). Windows without events are part of the result when ``fill`` is on,
built from a distributed range and joined to the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.functions.times import floor_div, floor_to, guarded_rate, micros
from eventrill.operators.order import OrderedScan

WINDOW_TYPES = ("tumbling", "sliding", "session")


def bounds(env: DataFrame) -> tuple[int, int, int] | None:
    """(first_us, last_us, events) of the stream, or None if there are no events."""
    row = env.agg(F.min("ts_us"), F.max("ts_us"), F.count(F.lit(1))).first()
    return None if row[2] == 0 else (row[0], row[1], row[2])


def _empty_windows(env: DataFrame, by: Sequence[str]) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    none = env.select(zero.alias("start_us"), zero.alias("end_us"), *by, zero.alias("count"))
    return none.limit(0)


def _spine(spark: SparkSession, first_us: int, step_us: int, windows: int, size_us: int) -> DataFrame:
    start = F.col("id") * step_us + first_us
    return spark.range(windows).select(start.alias("start_us"), (start + size_us).alias("end_us"))


def _filled(spine: DataFrame, counts: DataFrame) -> DataFrame:
    joined = spine.join(counts.select("start_us", "count"), "start_us", "left")
    return joined.select("start_us", "end_us", F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def tumbling(env: DataFrame, size_s: float, fill: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Windows ``[start, end)`` aligned to the epoch, from the first event's to the last's."""
    size = micros(size_s)
    counts = (
        env.groupBy(floor_to(F.col("ts_us"), size).alias("start_us"), *by)
        .agg(F.count(F.lit(1)).alias("count"))
        .select("start_us", (F.col("start_us") + size).alias("end_us"), *by, "count")
    )
    if not fill or by:
        return counts
    span = bounds(env)
    if span is None:
        return _empty_windows(env, by)
    first = span[0] // size * size
    spine = _spine(env.sparkSession, first, size, (span[1] - first) // size + 1, size)
    return _filled(spine, counts)


def sliding(
    env: DataFrame, size_s: float, slide_s: float, fill: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """Windows starting every ``slide_s`` from the first event on; a slide above the size leaves gaps.

    Events are counted once per pane (the greatest step that divides size and slide);
    only the pane counts are copied into the windows that hold them.
    """
    size, slide = micros(size_s), micros(slide_s)
    span = bounds(env)
    if span is None:
        return _empty_windows(env, by)
    first, last, _ = span
    pane_us = gcd(size, slide)
    pane = floor_div(F.col("ts_us") - F.lit(first), pane_us)
    panes = env.groupBy(pane.alias("_pane"), *by).agg(F.count(F.lit(1)).alias("_n"))

    at = F.col("_pane") * pane_us
    newest = floor_div(at, slide)
    oldest = F.greatest(F.lit(0).cast("bigint"), floor_div(at - size, slide) + 1)
    counts = (
        panes.select(*by, "_n", oldest.alias("_oldest"), newest.alias("_newest"))
        .where(F.col("_oldest") <= F.col("_newest"))
        .select(*by, "_n", F.explode(F.sequence("_oldest", "_newest")).alias("_k"))
        .groupBy("_k", *by)
        .agg(F.sum("_n").alias("count"))
    )
    start = F.col("_k") * slide + first
    counts = counts.select(start.alias("start_us"), (start + size).alias("end_us"), *by, "count")
    if not fill or by:
        return counts
    spine = _spine(env.sparkSession, first, slide, (last - first) // slide + 1, size)
    return _filled(spine, counts)


def with_session(env: DataFrame, gap_s: float, keys: Sequence[str] = (), **scan_args) -> DataFrame:
    """Each event with ``session_us``, the start of its session.

    A session ends where the next event is more than ``gap_s`` away.
    """
    gap = micros(gap_s)
    scan = OrderedScan(env, keys, ["ts_us", "ordinal"], **scan_args).lag(_prev_us="ts_us")
    opens = F.col("_prev_us").isNull() | (F.col("ts_us") - F.col("_prev_us") > gap)
    scan.df = scan.df.withColumn("_opened", F.when(opens, F.col("ts_us")))
    return scan.running_max("session_us", "_opened").result().drop("_prev_us", "_opened")


def sessions(env: DataFrame, gap_s: float, keys: Sequence[str] = (), **scan_args) -> DataFrame:
    """Sessions of the whole stream, or per key; ``end_us`` is the time of the last event."""
    columns = dict.fromkeys([*keys, "ts_us", "ordinal"])
    rows = with_session(env.select(*columns), gap_s, keys, **scan_args)
    return (
        rows.groupBy(*keys, "session_us")
        .agg(F.max("ts_us").alias("end_us"), F.count(F.lit(1)).alias("count"))
        .select(*keys, F.col("session_us").alias("start_us"), "end_us", "count")
    )


def windows_of(
    env: DataFrame, window_type: str, size_s: float = 10.0, slide_s: float = 5.0, gap_s: float = 10.0
) -> DataFrame:
    if window_type == "tumbling":
        return tumbling(env, size_s)
    if window_type == "sliding":
        return sliding(env, size_s, slide_s)
    if window_type == "session":
        return sessions(env, gap_s)
    raise ValueError(f"unknown window type {window_type!r}; choose one of {', '.join(WINDOW_TYPES)}")


def distribution(
    env: DataFrame,
    column: str,
    window_type: str = "tumbling",
    size_s: float = 10.0,
    slide_s: float = 5.0,
    gap_s: float = 10.0,
) -> DataFrame:
    """Events per window and value of ``column``: ``start_us, <column>, count``."""
    if window_type == "tumbling":
        out = tumbling(env, size_s, by=[column])
    elif window_type == "sliding":
        out = sliding(env, size_s, slide_s, by=[column])
    elif window_type == "session":
        rows = with_session(env.select("ts_us", "ordinal", column), gap_s)
        out = rows.groupBy(F.col("session_us").alias("start_us"), column)
        out = out.agg(F.count(F.lit(1)).alias("count"))
    else:
        raise ValueError(f"unknown window type {window_type!r}; choose one of {', '.join(WINDOW_TYPES)}")
    return out.select("start_us", column, "count")


def type_distribution(env: DataFrame, **window) -> DataFrame:
    return distribution(env, "event_type", **window)


def partition_distribution(env: DataFrame, **window) -> DataFrame:
    return distribution(env, "partition", **window)


def with_throughput(windows: DataFrame) -> DataFrame:
    return windows.withColumn("eps", throughput())


def throughput() -> Column:
    return guarded_rate(F.col("count"), F.col("end_us") - F.col("start_us"))


def non_empty(windows: DataFrame) -> DataFrame:
    return windows.where(F.col("count") > 0)


def throughput_series(windows: DataFrame) -> DataFrame:
    """``t_us, eps, count`` per window, unrounded; the report rounds."""
    return windows.select(F.col("start_us").alias("t_us"), throughput().alias("eps"), "count")


def tail_rate(env: DataFrame, every_s: float = 5.0) -> DataFrame:
    """New rows per interval, as a follower of a growing log sees them."""
    return tumbling(env, every_s).select("start_us", F.col("count").alias("new_rows"))
