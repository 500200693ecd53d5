"""Streaming forms of the window, session and deduplication operators.

The batch operators give the complete answer; a stream gives the windows its watermark
has closed. Streaming windows are aligned to the epoch (no first event is known), and
windows without events are not emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventrill.functions.times import micros
from eventrill.session import shared_dir


def interval(seconds: float) -> str:
    return f"{micros(seconds)} microseconds"


def with_watermark(env: DataFrame, delay_s: float) -> DataFrame:
    """Rows more than ``delay_s`` behind the latest event time are late and may be dropped."""
    return env.withWatermark("ts", f"{delay_s} seconds")


def _flat(windowed: DataFrame, by: Sequence[str]) -> DataFrame:
    return windowed.select(
        F.unix_micros("window.start").alias("start_us"), F.unix_micros("window.end").alias("end_us"), *by, "count"
    )


def stream_tumbling(env: DataFrame, size_s: float, by: Sequence[str] = ()) -> DataFrame:
    grouped = env.groupBy(F.window("ts", interval(size_s)), *by)
    return _flat(grouped.agg(F.count(F.lit(1)).alias("count")), by)


def stream_sliding(env: DataFrame, size_s: float, slide_s: float, by: Sequence[str] = ()) -> DataFrame:
    if slide_s > size_s:
        raise ValueError("a streaming window cannot slide by more than its size")
    grouped = env.groupBy(F.window("ts", interval(size_s), interval(slide_s)), *by)
    return _flat(grouped.agg(F.count(F.lit(1)).alias("count")), by)


def stream_sessions(env: DataFrame, gap_s: float, keys: Sequence[str] = ()) -> DataFrame:
    """Closed sessions; ``end_us`` is the last event's time. Without keys there is one session line
    for the whole stream, kept in one state: prefer keys."""
    # a key is required; a literal would be folded away
    columns = list(keys) or [F.substring(F.col("ts").cast("string"), 1, 0).alias("_stream")]
    grouped = env.groupBy(*columns, F.session_window("ts", interval(gap_s)))
    out = grouped.agg(F.max("ts").alias("_last"), F.count(F.lit(1)).alias("count"))
    return out.select(
        *keys, F.unix_micros("session_window.start").alias("start_us"), F.unix_micros("_last").alias("end_us"), "count"
    )


def stream_dedup(env: DataFrame) -> DataFrame:
    """First arrival of each event id; ids are remembered for the watermark delay."""
    return env.dropDuplicatesWithinWatermark(["event_id"])


def stream_metrics(lifecycle: DataFrame, every_s: float = 1.0) -> DataFrame:
    """Per interval and kind, how often it happened: the deltas that depths are summed from."""
    return stream_tumbling(lifecycle, every_s, by=["kind"])


def run_to_table(
    df: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None, **writer_options
) -> DataFrame:
    """Run an append-mode stream over all there is now, and give what it wrote.

    Output and checkpoint lie in the shared folder, so a restart goes on where it stopped.
    """
    spark = df.sparkSession
    out = out or shared_dir(spark, f"{name}-out")
    checkpoint = checkpoint or shared_dir(spark, f"{name}-checkpoint")
    writer = df.writeStream.format("parquet").outputMode("append").options(**writer_options)
    query = writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``handle(batch, batch_id)`` over all there is now."""
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def progress(query: StreamingQuery) -> list[dict]:
    """Rows and rows per second of each micro-batch so far."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_s": p["processedRowsPerSecond"]}
        for p in query.recentProgress
    ]
