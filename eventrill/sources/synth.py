"""Synthetic events with typed payloads, made on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.functions.payloads import FACTORIES, Dice, rolls, with_synthetic
from eventrill.functions.times import SECOND_US
from eventrill.operators.topiclog import key_partition
from eventrill.sources.eventlog import ENVELOPE_COLUMNS

SCHEMA_VERSION = "1.0"
TOPIC = "events"


def events_from(
    rows: DataFrame,
    number: str,
    ts_us: str,
    types: Sequence[str] | None = None,
    partitions: int = 4,
    strategy: str = "key",
    seed: str = "0",
    producer_id: str = "producer-0",
) -> DataFrame:
    """One event per row of ``rows``; column ``number`` (0, 1, 2 …) fixes what it holds."""
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    if strategy not in ("key", "roundrobin"):
        raise ValueError(f"unknown strategy {strategy!r}; choose key or roundrobin")
    names = list(types or FACTORIES)
    stamp = F.concat_ws(":", F.lit(seed), F.col(number))
    picked = rows.select(F.col(number).alias("_n"), F.col(ts_us).alias("ts_us"), stamp.alias("_seed"))
    of_type = Dice(rolls(F.md5(F.concat(F.col("_seed"), F.lit(":type")))))
    made = with_synthetic(picked.withColumn("event_type", of_type.pick(0, names)), "_seed", names)
    in_turn = F.pmod(F.col("_n"), F.lit(partitions)).cast("int")
    placed = key_partition(F.col("partition_key"), F.lit(partitions)) if strategy == "key" else in_turn
    return made.select(
        F.md5(F.concat(F.col("_seed"), F.lit(":id"))).alias("event_id"),
        "event_type",
        F.timestamp_micros("ts_us").alias("ts"),
        "ts_us",
        "partition_key",
        placed.alias("partition"),
        (F.col("_n") + 1).alias("sequence_number"),
        F.lit(producer_id).alias("producer_id"),
        F.struct(
            F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(TOPIC).alias("topic"),
            F.lit(partitions).alias("num_partitions"),
        ).alias("metadata"),
        "payload",
        F.col("_n").alias("ordinal"),
    ).select(*ENVELOPE_COLUMNS)


def synth_events(
    spark: SparkSession, n: int, rate: float = 10.0, start_us: int = 0, slices: int | None = None, **options
) -> DataFrame:
    """``n`` events at ``rate`` per second from ``start_us`` on."""
    step_us = round(SECOND_US / max(rate, 0.001))
    numbers = spark.range(0, n, 1, slices).withColumn("_at", F.col("id") * step_us + start_us)
    return events_from(numbers, "id", "_at", **options)


def synth_stream(spark: SparkSession, rate: int = 10, **options) -> DataFrame:
    """An endless stream of events at ``rate`` per second."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rate).load()
    return events_from(ticks.withColumn("_at", F.unix_micros("timestamp")), "value", "_at", **options)
