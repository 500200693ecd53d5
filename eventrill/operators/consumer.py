"""Consuming an event stream: filters, deduplication, latency, offsets, statistics."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrill.functions.times import guarded_rate
from eventrill.operators.order import OrderedScan
from eventrill.operators.quantiles import floor_rank, values_at
from eventrill.session import written

COMMIT_INTERVAL = 100


def accepts(
    types: Collection[str] | None = None,
    partitions: Collection[int] | None = None,
    predicate: Column | None = None,
) -> Column:
    """The filter as one expression. An empty or missing set lets everything through."""
    condition = F.lit(True)
    if types:
        condition = condition & F.col("event_type").isin(*types)
    if partitions:
        condition = condition & F.col("partition").isin(*partitions)
    if predicate is not None:
        condition = condition & predicate
    return condition


def filter_events(env: DataFrame, types=None, partitions=None, predicate: Column | None = None) -> DataFrame:
    return env.where(accepts(types, partitions, predicate))


def _first_of(env: DataFrame, *keys: str) -> DataFrame:
    """The first row of each key, in order of ``ordinal``.

    ``row_number() = 1`` also cuts each map task's share to one row per key before the
    shuffle, so a hot key needs no splitting.
    """
    order = Window.partitionBy(*keys).orderBy("ordinal")
    return env.withColumn("_sighting", F.row_number().over(order)).where(F.col("_sighting") == 1).drop("_sighting")


def dedup_first(env: DataFrame, rows_per_piece: int | None = None) -> DataFrame:
    """Keep the first arrival of each event id. No id needs cutting, whatever ``rows_per_piece`` says."""
    return _first_of(env, "event_id")


def drop_processed(env: DataFrame, processed: DataFrame) -> DataFrame:
    """Drop events whose id an earlier run has already processed."""
    return env.join(processed.select("event_id").distinct(), "event_id", "left_anti")


def consume(
    env: DataFrame, types=None, partitions=None, predicate: Column | None = None, dedup: bool = True, **scan_args
) -> DataFrame:
    """Every received event with ``processed``: it passes the filter and is the first such of its id."""
    passed = env.withColumn("processed", F.coalesce(accepts(types, partitions, predicate), F.lit(False)))
    if not dedup:
        return passed
    # filtered-out events do not count as seen: they are ranked apart
    ranked = OrderedScan(passed, ["event_id", "processed"], ["ordinal"], **scan_args).rank("_sighting").result()
    return ranked.withColumn("processed", F.col("processed") & (F.col("_sighting") == 1)).drop("_sighting")


def with_latency(env: DataFrame) -> DataFrame:
    return env.withColumn("latency_ms", (F.col("received_at_us") - F.col("ts_us")) / 1e3)


def consumer_totals(consumed: DataFrame) -> DataFrame:
    """One row: ``received = filtered_out + processed``, and processed events per second received."""
    processed = F.count_if("processed")
    span = F.max("received_at_us") - F.min("received_at_us")
    return consumed.agg(
        F.count(F.lit(1)).alias("received"),
        (F.count(F.lit(1)) - processed).alias("filtered_out"),
        processed.alias("processed"),
        # all received at one time, as in a replay: there is no rate
        F.when(span > 0, guarded_rate(processed, span)).otherwise(0.0).alias("eps"),
    )


def latency_percentiles(env: DataFrame, percentiles: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """One row: samples with a latency of at least 0, and the value at each rounded-down rank.

    Without samples every percentile is 0.
    """
    samples = env.select((F.col("received_at_us") - F.col("ts_us")).alias("us")).where(F.col("us") >= 0)
    samples = written(samples, "latencies")
    n = samples.count()
    at = {p: floor_rank(n, p) for p in percentiles} if n else {}
    values = values_at(samples, "us", list(at.values()), stored=True)
    row = [F.lit(n).cast("bigint").alias("samples")]
    row += [F.lit(values[at[p]] / 1e3 if n else 0.0).alias(f"p{p}_ms") for p in percentiles]
    return env.sparkSession.range(1).select(*row)


def partition_offsets(env: DataFrame, num_partitions: int) -> DataFrame:
    """Greatest sequence number per partition, −1 where nothing arrived; new partitions are added."""
    known = env.sparkSession.range(num_partitions).select(F.col("id").cast("int").alias("partition"))
    seen = env.groupBy("partition").agg(F.max("sequence_number").alias("_max"))
    return known.join(seen, "partition", "full").select(
        "partition", F.greatest(F.coalesce("_max", F.lit(-1)), F.lit(-1)).cast("bigint").alias("pending")
    )


def commit_offsets(accepted: DataFrame, num_partitions: int, interval: int = COMMIT_INTERVAL) -> DataFrame:
    """Pending and committed sequence number and lag per partition.

    After every ``interval``-th accepted event, counted over all partitions in arrival
    order, all partitions are committed. So what is committed is what had arrived by the
    last full interval: one position in arrival order, found without ranking the rows.
    """
    rows = written(accepted.select("partition", "sequence_number", "ordinal"), "accepted")
    full = rows.count() // interval * interval
    edge = values_at(rows, "ordinal", [full - 1], stored=True)[full - 1] if full else None
    in_time = F.col("ordinal") <= F.lit(edge).cast("bigint")
    seen = rows.groupBy("partition").agg(
        F.max("sequence_number").alias("_pending"),
        F.max(F.when(in_time, F.col("sequence_number"))).alias("_committed"),
    )
    known = accepted.sparkSession.range(num_partitions).select(F.col("id").cast("int").alias("partition"))
    pending = F.greatest(F.coalesce("_pending", F.lit(-1)), F.lit(-1)).cast("bigint")
    committed = F.greatest(F.coalesce("_committed", F.lit(-1)), F.lit(-1)).cast("bigint")
    return known.join(seen, "partition", "full").select(
        "partition",
        pending.alias("pending"),
        committed.alias("committed"),
        F.greatest(pending - committed, F.lit(0)).alias("lag"),
    )


def take_accepted(accepted: DataFrame, n: int) -> DataFrame:
    """The first ``n`` accepted events in arrival order (all of them if there are fewer)."""
    if n <= 0:
        return accepted.limit(0)
    accepted = written(accepted, "accepted")
    total = accepted.count()
    if total <= n:
        return accepted
    edge = values_at(accepted, "ordinal", [n - 1], stored=True)[n - 1]
    return accepted.where(F.col("ordinal") <= F.lit(edge))


def consumer_stats(consumed: DataFrame, percentiles: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """All consumer statistics in long form: ``metric, key, value``."""
    # one pass over what led here: every part below reads this narrow table
    consumed = written(consumed.select("processed", "event_type", "partition", "ts_us", "received_at_us"), "consumed")
    done = consumed.where("processed")
    totals = consumer_totals(consumed)
    span_s = F.greatest((F.max("received_at_us") - F.min("received_at_us")) / 1e6, F.lit(0.001))
    elapsed = consumed.agg(F.coalesce(span_s, F.lit(0.001)).alias("elapsed_s"))
    latencies = latency_percentiles(done, percentiles)

    def long(one_row: DataFrame) -> DataFrame:
        pairs = F.array(*[
            F.struct(F.lit(c).alias("metric"), F.lit("").alias("key"), F.col(c).cast("double").alias("value"))
            for c in one_row.columns
        ])
        return one_row.select(F.inline(pairs))

    def counts(column: str, metric: str) -> DataFrame:
        grouped = done.groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return grouped.select(F.lit(metric).alias("metric"), "key", F.col("n").cast("double").alias("value"))

    out = long(totals).unionByName(long(elapsed)).unionByName(long(latencies))
    return out.unionByName(counts("event_type", "by_type")).unionByName(counts("partition", "by_partition"))


def ordered_stats(stats: DataFrame) -> DataFrame:
    """``consumer_stats`` with ``place``, the row's place within its metric, as the table is read.

    Types by falling count, equal ones by name; partitions by rising number. A metric has as
    many rows as there are types, or partitions.
    """
    number = F.when(F.col("metric") == "by_partition", F.col("key").try_cast("bigint")).otherwise(-F.col("value"))
    order = Window.partitionBy("metric").orderBy(F.asc_nulls_last(number), "key")
    return stats.withColumn("place", F.row_number().over(order))
