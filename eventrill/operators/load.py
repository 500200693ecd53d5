"""Load runs: synthetic arrivals, rate conformance, latency summaries, reports.

Runs are told apart by ``pattern``. Load events are ``event_id, ts_us, pattern,
sequence, payload_size, payload``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.functions.rates import Profile, floored, mean_rate
from eventrill.functions.times import SECOND_US, floor_to, guarded_rate, micros, seconds
from eventrill.operators.order import OrderedScan
from eventrill.operators.quantiles import (
    grouped_percentiles, interpolated, interpolation_rank, values_at,
)
from eventrill.session import broadcast_if_small

# The percentiles of a latency summary, and what an envelope takes of a payload.
PERCENTILES = {"p50_ms": 50.0, "p95_ms": 95.0, "p99_ms": 99.0, "p999_ms": 99.9}
ENVELOPE_BYTES = 80
REPORT_EVERY_S = 2.0


def synth_load(
    spark: SparkSession,
    pattern: str,
    profile: Profile,
    duration_s: int,
    payload_size: int = 128,
    start_us: int = 0,
    slices: int | None = None,
) -> DataFrame:
    """Events arriving as ``profile`` says, evenly spread within each second.

    What one second leaves over of an event is carried to the next: the running total
    of the rate, cut to whole events, says how many have arrived by each second.
    """
    arrivals = spark.range(0, duration_s, 1, slices).select(
        F.col("id").alias("second"), floored(profile)(F.col("id").cast("double")).alias("rate")
    )
    upto = OrderedScan(arrivals, [], ["second"]).running_sum("_upto", "rate").result()
    first = F.floor(F.col("_upto") - F.col("rate") + 1e-9)
    due = (F.floor(F.col("_upto") + 1e-9) - first).cast("bigint")
    events = (
        upto.select("second", first.alias("_first"), due.alias("_due"))
        .where(F.col("_due") > 0)
        .select("second", "_first", "_due", F.explode(F.sequence(F.lit(1), F.col("_due"))).alias("_i"))
    )
    sequence = (F.col("_first") + F.col("_i")).cast("bigint")
    at = F.col("second") * SECOND_US + F.floor((F.col("_i") - 1) * SECOND_US / F.col("_due"))
    return events.select(sequence.alias("sequence"), (at + start_us).cast("bigint").alias("ts_us")).select(
        F.substring(F.md5(F.concat_ws(":", F.lit(pattern), "sequence")), 1, 12).alias("event_id"),
        "ts_us",
        F.lit(pattern).alias("pattern"),
        "sequence",
        F.lit(payload_size).alias("payload_size"),
        load_payload(F.concat_ws(":", F.lit(pattern), "sequence"), payload_size).alias("payload"),
    )


def load_payload(seed: Column, payload_size: int) -> Column:
    """Padding up to the wanted size, and a number in [0, 1) fixed by ``seed``."""
    rand = F.conv(F.substring(F.md5(seed), 13, 8), 16, 10).cast("bigint") / float(1 << 32)
    return F.struct(F.lit("x" * max(0, payload_size - ENVELOPE_BYTES)).alias("data"), rand.alias("rand"))


def latency_summary(samples: DataFrame, column: str, by: Sequence[str] = (), **scan_args) -> DataFrame:
    """Count, mean, interpolated percentiles, min and max, over all rows or per group.

    Unrounded. Without samples the ungrouped form gives one row of zeros.
    """
    value = F.col(column)
    basics = [
        F.count(value).alias("samples"), F.avg(value).alias("mean_ms"),
        F.min(value).alias("min_ms"), F.max(value).alias("max_ms"),
    ]
    order = [*by, "samples", "mean_ms", *PERCENTILES, "min_ms", "max_ms"]
    if by:
        percentiles = grouped_percentiles(samples, by, column, PERCENTILES, **scan_args)
        found = percentiles.select(*[F.col(c).alias(f"_p_{c}") for c in by], *PERCENTILES)
        same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in by]
        # a group without samples stays, with 0 samples and no values
        return samples.groupBy(*by).agg(*basics).join(found, same, "left").select(*order)

    row = samples.agg(*basics).first()
    n = row["samples"]
    found: dict[str, float] = dict.fromkeys(PERCENTILES, 0.0)
    if n:
        wanted: set[int] = set()
        for p in PERCENTILES.values():
            at, frac = interpolation_rank(n, p)
            wanted |= {at} if frac == 0.0 else {at, at + 1}
        values = values_at(samples, column, sorted(wanted))
        found = {name: interpolated(values, n, p) for name, p in PERCENTILES.items()}
    scalars = {"samples": n, **{c: float(row[c] or 0.0) for c in ("mean_ms", "min_ms", "max_ms")}, **found}
    return samples.sparkSession.range(1).select(*[F.lit(scalars[c]).alias(c) for c in order]).withColumn(
        "samples", F.col("samples").cast("bigint")
    )


def rate_conformance(events: DataFrame, profiles: dict[str, Profile]) -> DataFrame:
    """Per pattern: events, duration, target and actual rate, and the one in percent of the other.

    The target is the mean of the pattern's profile over the run.
    """
    span = F.col("_last") - F.col("_first")
    runs = (
        events.where(F.col("pattern").isin(*profiles))
        .groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("total_events"), F.min("ts_us").alias("_first"), F.max("ts_us").alias("_last"))
        .select(
            "pattern", "total_events",
            seconds(span).alias("duration_s"),
            guarded_rate(F.col("total_events"), span).alias("actual_eps"),
        )
    )
    target = F.lit(None).cast("double")
    for name, profile in profiles.items():
        target = F.when(F.col("pattern") == name, mean_rate(profile, F.col("duration_s"))).otherwise(target)
    conformance = F.col("actual_eps") * 100.0 / F.greatest(F.col("target_eps"), F.lit(0.001))
    return runs.withColumn("target_eps", target).withColumn("conformance_pct", conformance)


def throughput_points(events: DataFrame, every_s: float = REPORT_EVERY_S, **scan_args) -> DataFrame:
    """Per pattern: the rate of each interval of the run (``t_us`` is its end) and the events so far."""
    size = micros(every_s)
    begins = broadcast_if_small(events.groupBy("pattern").agg(F.min("ts_us").alias("_first")))
    begins = begins.withColumnRenamed("pattern", "_pattern")
    since = events.select("pattern", "ts_us").join(begins, F.col("pattern").eqNullSafe(F.col("_pattern")))
    counted = since.groupBy("pattern", floor_to(F.col("ts_us") - F.col("_first"), size).alias("t_us")).agg(
        F.count(F.lit(1)).alias("count")
    )
    totals = OrderedScan(counted, ["pattern"], ["t_us"], **scan_args).running_sum("total", "count").result()
    return totals.select("pattern", (F.col("t_us") + size).alias("t_us"), (F.col("count") / F.lit(every_s)).alias("eps"), "total")


def load_report(runs: DataFrame) -> DataFrame:
    """One row over several runs: how many, and their events together."""
    return runs.agg(
        F.count(F.lit(1)).alias("total_patterns"),
        F.coalesce(F.sum("total_events"), F.lit(0)).cast("bigint").alias("total_events"),
    )
