"""Message life cycles: routing, retries, dead letters, and depths over time.

Attempts are rows ``message_id, consumer_id, topic, partition, attempt, ok, ts_us``
with attempts numbered from 1. A life-cycle log has one row per thing that happened:
``ts_us, kind, message_id, producer_id, consumer_id, topic, partition, attempt`` with
``kind`` one of produced, consumed, retry (an attempt failed), dlq.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.functions.times import floor_div, floor_to, micros
from eventrill.operators.order import OrderedScan
from eventrill.operators.windows import tumbling
from eventrill.session import broadcast_if_small, written

MAX_RETRIES = 3
HISTORY = 30
RUN_PIECE = 10_000  # intervals that a value is carried over at once
COLUMNS = ["ts_us", "kind", "message_id", "producer_id", "consumer_id", "topic", "partition", "attempt"]


def fan_out(env: DataFrame, routes: DataFrame) -> DataFrame:
    """Each event once per topic its producer feeds; events of unrouted producers vanish."""
    return env.join(broadcast_if_small(routes.select("producer_id", "topic")), "producer_id")


def _reached(attempts: DataFrame, max_retries: int, crashed: DataFrame | None) -> DataFrame:
    """Attempts that can take place: within the budget, and no retry on a crashed consumer."""
    rows = attempts.where(F.col("attempt") <= max_retries)
    if crashed is not None:
        down = broadcast_if_small(crashed.select("consumer_id", F.lit(True).alias("_down")))
        rows = rows.join(down, "consumer_id", "left")
        rows = rows.where(F.col("_down").isNull() | (F.col("attempt") == 1)).drop("_down")
    return rows


def outcome_of(max_retries: int) -> tuple[Column, Column]:
    """``status`` and ``failures`` of a message by ``_ok``, its first success, and ``_failed`` attempts."""
    status = F.when(F.col("_ok").isNotNull(), "consumed").when(F.col("_failed") >= max_retries, "dlq")
    return status.otherwise("pending"), F.coalesce(F.col("_ok") - 1, F.col("_failed")).cast("bigint")


def route_retries(
    attempts: DataFrame, max_retries: int = MAX_RETRIES, crashed: DataFrame | None = None
) -> DataFrame:
    """Per message: ``status`` (consumed, pending or dlq), ``failures`` and ``attempts`` made.

    The first success ends a message; ``max_retries`` failures send it to the dead letters.
    """
    rows = _reached(attempts, max_retries, crashed)
    per_message = rows.groupBy("message_id").agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("_ok"),
        F.count_if(~F.col("ok")).alias("_failed"),
    )
    status, failures = outcome_of(max_retries)
    return per_message.select(
        "message_id",
        status.alias("status"),
        failures.alias("failures"),
        (failures + F.col("_ok").isNotNull().cast("bigint")).alias("attempts"),
    )


def lifecycle_log(
    produced: DataFrame,
    attempts: DataFrame,
    max_retries: int = MAX_RETRIES,
    crashed: DataFrame | None = None,
    dlq_delay_s: float = 1.0,
) -> DataFrame:
    """What happened to the ``produced`` messages (``message_id, producer_id, topic, partition, ts_us``).

    Every failed attempt is a *retry* row; the dead letter follows ``dlq_delay_s`` later.
    """
    made = _reached(attempts, max_retries, crashed)
    ends = made.groupBy("message_id").agg(F.min(F.when(F.col("ok"), F.col("attempt"))).alias("_ok"))
    tried = made.join(ends, "message_id").where(F.col("_ok").isNull() | (F.col("attempt") <= F.col("_ok")))
    outcome = tried.withColumn("kind", F.when(F.col("ok"), "consumed").otherwise("retry"))
    dead = outcome.where((F.col("kind") == "retry") & (F.col("attempt") == max_retries))
    dead = dead.withColumn("kind", F.lit("dlq")).withColumn("ts_us", F.col("ts_us") + micros(dlq_delay_s))
    consumer_side = outcome.unionByName(dead).withColumn("producer_id", F.lit(None).cast("string"))
    producer_side = (
        produced.withColumn("kind", F.lit("produced"))
        .withColumn("consumer_id", F.lit(None).cast("string"))
        .withColumn("attempt", F.lit(None).cast("int"))
    )
    return producer_side.select(*COLUMNS).unionByName(consumer_side.select(*COLUMNS))


def lifecycle_counters(log: DataFrame) -> DataFrame:
    """One row: produced, consumed, failed (messages whose first attempt failed), dlq."""
    kind = F.col("kind")
    return log.agg(
        F.count_if(kind == "produced").alias("produced"),
        F.count_if(kind == "consumed").alias("consumed"),
        F.count_if((kind == "retry") & (F.col("attempt") == 1)).alias("failed"),
        F.count_if(kind == "dlq").alias("dlq"),
    )


def rollup(log: DataFrame, every_s: float = 1.0) -> DataFrame:
    """What happened per interval: rows of a life-cycle log counted by all the series need.

    Every series below takes this table; make it once (``written``) to draw several.
    """
    start = floor_to(F.col("ts_us"), micros(every_s)).alias("start_us")
    first = (F.col("attempt") == 1).alias("first")
    by = [start, "kind", first, "producer_id", "consumer_id", "topic", "partition"]
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _counted(rolled: DataFrame, kind: str, by: str) -> DataFrame:
    return rolled.where(F.col("kind") == kind).groupBy("start_us", by).agg(F.sum("n").alias("count"))


def produced_per_second(rolled: DataFrame) -> DataFrame:
    """Messages produced per interval and producer."""
    return _counted(rolled, "produced", "producer_id")


def consumer_offsets_series(rolled: DataFrame, **scan_args) -> DataFrame:
    """Messages consumed so far per consumer, at each interval in which it consumed any."""
    counts = written(_counted(rolled, "consumed", "consumer_id"), "consumed")
    scan = OrderedScan(counts, ["consumer_id"], ["start_us"], **scan_args)
    return scan.running_sum("consumer_offset", "count").result().drop("count")


def queue_delta() -> Column:
    # a message leaves the queue at its first attempt, whatever the outcome
    kind = F.col("kind")
    left = kind.isin("consumed", "retry") & F.col("first")
    return F.when(kind == "produced", F.col("n")).when(left, -F.col("n")).otherwise(0)


def retry_delta() -> Column:
    kind, first = F.col("kind"), F.col("first")
    left = ((kind == "consumed") & ~first) | (kind == "dlq")
    return F.when((kind == "retry") & first, F.col("n")).when(left, -F.col("n")).otherwise(0)


def depth_series(rolled: DataFrame, every_s: float = 1.0, **scan_args) -> DataFrame:
    """Queue, retry and dead-letter depth at the end of every interval."""
    size = micros(every_s)
    deltas = rolled.groupBy("start_us").agg(
        F.sum(queue_delta()).alias("queue_depth"),
        F.sum(retry_delta()).alias("retry_depth"),
        F.sum(F.when(F.col("kind") == "dlq", F.col("n")).otherwise(0)).alias("dlq_depth"),
    )
    depths = ["queue_depth", "retry_depth", "dlq_depth"]
    deltas = written(deltas, "depths")  # one row per interval, read by several passes
    spine = tumbling(deltas.withColumn("ts_us", F.col("start_us")).select("ts_us"), every_s)
    zero = F.lit(0).cast("bigint")
    every = spine.select("start_us").join(deltas, "start_us", "left")
    every = every.select("start_us", *[F.coalesce(c, zero).alias(f"_{c}") for c in depths])
    scan = OrderedScan(every, [], ["start_us"], **scan_args).running_sums({c: f"_{c}" for c in depths})
    return scan.result().select("start_us", (F.col("start_us") + size).alias("end_us"), *depths)


def consumer_lag_series(rolled: DataFrame, assignments: DataFrame, **scan_args) -> DataFrame:
    """Messages waiting in each consumer's partitions, at each interval in which any came or went."""
    owned = assignments.select("topic", "partition", F.col("member_id").alias("_owner"))
    moved = rolled.withColumn("_delta", queue_delta()).where(F.col("_delta") != 0)
    # summed per partition before the join: the join then sees intervals, not messages
    per_partition = moved.groupBy("start_us", "topic", "partition").agg(F.sum("_delta").alias("_delta"))
    per_owner = per_partition.join(owned, ["topic", "partition"]).groupBy(
        F.col("_owner").alias("consumer_id"), "start_us"
    )
    moves = written(per_owner.agg(F.sum("_delta").alias("_delta")), "moves")
    scan = OrderedScan(moves, ["consumer_id"], ["start_us"], **scan_args)
    return scan.running_sum("lag", "_delta").result().drop("_delta")


def carried_forward(
    changes: DataFrame, keys: DataFrame, value: str, span_us: tuple[int, int], every_s: float = 1.0, **scan_args
) -> DataFrame:
    """``value`` of every key at every interval, the last change carried forward; 0 before the first one.

    ``changes`` has the key's columns, ``start_us`` and ``value``, at most a row per key and interval;
    ``keys`` are all keys; ``span_us`` is the first and the last interval's start. A row finds
    the next one of its key and is copied into the intervals up to there, in pieces, so
    that neither a key's dense series nor a long silence is in one place at a time.
    """
    size, by = micros(every_s), keys.columns
    first, last = span_us
    before = keys.select(*by, F.lit(first - size).alias("start_us"), F.lit(0).cast("bigint").alias(value))
    rows = changes.select(*by, "start_us", F.col(value).cast("bigint").alias(value)).unionByName(before)
    rows = written(rows.withColumn("_back", -F.col("start_us")), "changes")
    runs = OrderedScan(rows, by, ["_back"], **scan_args).lag(_next="start_us").result()
    at = F.greatest("start_us", F.lit(first))
    until = F.coalesce("_next", F.lit(last + size))
    runs = runs.select(*by, value, at.alias("_at"), floor_div(until - at, size).alias("_n")).where("_n > 0")
    piece = F.sequence(F.lit(0).cast("bigint"), floor_div(F.col("_n") - 1, RUN_PIECE))
    from_i = F.col("_p") * RUN_PIECE
    step = F.sequence(from_i, F.least(F.col("_n"), from_i + RUN_PIECE) - 1)
    dense = runs.withColumn("_p", F.explode(piece)).withColumn("_i", F.explode(step))
    return dense.select(*by, (F.col("_at") + F.col("_i") * size).alias("start_us"), value)


def metrics_snapshots(
    rolled: DataFrame, assignments: DataFrame | None = None, every_s: float = 1.0, **scan_args
) -> DataFrame:
    """All metrics of a run in long form: ``t_us`` (end of the interval), ``metric, id, value``.

    Every snapshot has the depths, and the offset (and, with ``assignments``, the lag) of every
    consumer that is assigned or ever consumed; ``produced`` names the producers that did.
    """
    size = micros(every_s)
    rolled = written(rolled, "rollup")  # every metric reads it
    bounds = rolled.agg(F.min("start_us"), F.max("start_us")).first()
    span = (bounds[0] or 0, bounds[1] if bounds[1] is not None else -size)
    consumers = rolled.where(F.col("consumer_id").isNotNull()).select("consumer_id")
    if assignments is not None:
        consumers = consumers.unionByName(assignments.select(F.col("member_id").alias("consumer_id")))
    consumers = consumers.distinct()

    def long(df: DataFrame, metric: str, id_col: Column, value: str) -> DataFrame:
        t = (F.col("start_us") + size).alias("t_us")
        return df.select(t, F.lit(metric).alias("metric"), id_col.alias("id"), F.col(value).cast("bigint").alias("value"))

    depths = depth_series(rolled, every_s)
    depths = depths.select(
        F.col("end_us").alias("t_us"),
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.lit("").alias("id"), F.col(c).alias("value"))
            for c in ("queue_depth", "retry_depth", "dlq_depth")
        ])),
    )
    out = depths.unionByName(long(produced_per_second(rolled), "produced", F.col("producer_id"), "count"))
    offsets = consumer_offsets_series(rolled, **scan_args)
    offsets = carried_forward(offsets, consumers, "consumer_offset", span, every_s, **scan_args)
    out = out.unionByName(long(offsets, "consumer_offset", F.col("consumer_id"), "consumer_offset"))
    if assignments is not None:
        lags = consumer_lag_series(rolled, assignments, **scan_args)
        lags = carried_forward(lags, consumers, "lag", span, every_s, **scan_args)
        out = out.unionByName(long(lags, "consumer_lag", F.col("consumer_id"), "lag"))
    return out


def recent_snapshots(series: DataFrame, n: int = HISTORY) -> DataFrame:
    """The rows of the last ``n`` snapshot times."""
    series = written(series, "snapshots")
    last = series.select("t_us").distinct().orderBy(F.desc("t_us")).limit(n)
    return series.join(last, "t_us", "left_semi")
