"""Counts, top-N, summary and gap statistics of an envelope DataFrame."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrill.functions.times import guarded_rate, seconds
from eventrill.operators.order import OrderedScan


def _count_by(env: DataFrame, column: str) -> DataFrame:
    return env.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def count_by_type(env: DataFrame) -> DataFrame:
    return _count_by(env, "event_type")


def count_by_partition(env: DataFrame) -> DataFrame:
    return _count_by(env, "partition")


def count_by_producer(env: DataFrame) -> DataFrame:
    return _count_by(env, "producer_id")


def top_event_types(env: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent types; equal counts in order of first appearance."""
    # time and arrival order as one number: a minimum of structs would sort the events
    place = F.col("ts_us").cast("decimal(18,0)") * F.lit(Decimal(1 << 63)) + F.col("ordinal")
    first = F.min(place.cast("decimal(38,0)"))
    ranked = env.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"), first.alias("_first"))
    return ranked.orderBy(F.desc("count"), F.asc("_first")).limit(n).select("event_type", "count")


def stream_summary(env: DataFrame) -> DataFrame:
    """One row: ``total_events, duration_s, overall_eps``; no row for an empty stream."""
    span = F.col("_last") - F.col("_first")
    return (
        env.agg(
            F.count(F.lit(1)).alias("total_events"), F.min("ts_us").alias("_first"), F.max("ts_us").alias("_last")
        )
        .where(F.col("total_events") > 0)
        .select(
            "total_events",
            seconds(span).alias("duration_s"),
            guarded_rate(F.col("total_events"), span).alias("overall_eps"),
        )
    )


def with_gap(env: DataFrame, **scan_args) -> DataFrame:
    """Each event with ``gap_us`` to the event before it in time, and that event's id and time."""
    scan = OrderedScan(env, [], ["ts_us", "ordinal"], **scan_args)
    scan.lag(prev_us="ts_us", prev_event="event_id")
    return scan.result().withColumn("gap_us", F.col("ts_us") - F.col("prev_us"))


def gaps_of(env: DataFrame, **scan_args) -> DataFrame:
    """What gap statistics and silences are read from: ``ts_us, prev_us, prev_event, gap_us`` of each event."""
    return with_gap(env.select("event_id", "ts_us", "ordinal"), **scan_args).drop("event_id", "ordinal")


def gap_stats(env: DataFrame, gaps: DataFrame | None = None, **scan_args) -> DataFrame:
    """Least, greatest and mean time between neighbours in ms; no row under two events.

    ``gaps`` is ``gaps_of(env)``, if it is there already.
    """
    gaps = gaps_of(env, **scan_args) if gaps is None else gaps
    return (
        gaps.agg(
            F.min("gap_us").alias("_min"), F.max("gap_us").alias("_max"),
            F.sum("gap_us").alias("_sum"), F.count("gap_us").alias("gaps"),
        )
        .where(F.col("gaps") > 0)
        .select(
            (F.col("_min") / 1e3).alias("min_ms"),
            (F.col("_max") / 1e3).alias("max_ms"),
            (F.col("_sum") / F.col("gaps") / 1e3).alias("mean_ms"),
        )
    )


def ordered(env: DataFrame) -> DataFrame:
    """Time order, ties in arrival order. For an output edge only: nothing else needs it."""
    return env.orderBy("ts_us", "ordinal")
