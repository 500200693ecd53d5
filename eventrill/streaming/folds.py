"""Depths, session lines, silences and retries of an endless stream, by chained stateful operators.

Each begins with one of Spark's own streaming aggregates, which count map-side before the
shuffle, so a busy second, a hot producer or a heavy partition is one row per window and
task. The watermark closes windows in order of their time. Where a result needs what came
before a window, a second stateful operator follows: a processor that keeps one small record
per key and gets closed windows only, a row per window. It passes its record from batch to
batch in Spark's state store, so a restart goes on where it stopped and a repeated batch
gives the same rows.

Late rows count as long as they are no later than the watermark's delay; the rest is dropped
by the first operator, for all of them alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventrill.functions.times import micros
from eventrill.operators.lifecycle import MAX_RETRIES, outcome_of, queue_delta, retry_delta
from eventrill.streaming.queries import interval, stream_sessions

ROWS_AT_ONCE = 100_000  # of intervals without events, when they are filled in
DEPTHS = ("queue_depth", "retry_depth", "dlq_depth")
_KEY = "_stream"


def _one_key(windowed: DataFrame) -> Column:
    """The same text for all rows, that is not folded away as a literal would be."""
    return F.substring(windowed["window.start"].cast("string"), 1, 0)


def _in_order(rows: Iterator[pd.DataFrame], by: str) -> pd.DataFrame:
    """The closed windows of a batch: as many rows as windows, not as events."""
    return pd.concat(list(rows)).sort_values(by, ignore_index=True)


class _RunningDepths(StatefulProcessor):
    """Carries the depths, and where their last window ended, from one closed window to the next."""

    def __init__(self, step_us: int, keys: Sequence[str]) -> None:
        self._step, self._keys = step_us, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"{c} bigint" for c in DEPTHS)
        self._state = handle.getValueState("depths", f"end_us bigint, {fields}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        deltas = _in_order(rows, "start_us")
        starts = deltas["start_us"].to_numpy(np.int64)
        before = self._state.get() if self._state.exists() else (int(starts[0]), 0, 0, 0)
        depths = np.cumsum(np.vstack([np.array(before[1:], np.int64), deltas[list(DEPTHS)].to_numpy(np.int64)]), axis=0)
        ends = starts + self._step
        self._state.update((int(ends[-1]), *map(int, depths[-1])))
        at = int(before[0])  # every interval from here on, those without a window with the depths before them
        total = (int(ends[-1]) - at) // self._step
        for first in range(0, total, ROWS_AT_ONCE):
            start = at + self._step * np.arange(first, min(total, first + ROWS_AT_ONCE))
            row = np.searchsorted(starts, start, side="right")
            out = {k: [v] * len(start) for k, v in zip(self._keys, key)}
            out |= {"start_us": start, "end_us": start + self._step}
            out |= {c: depths[row, i] for i, c in enumerate(DEPTHS)}
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def stream_depths(lifecycle: DataFrame, every_s: float = 1.0, keys: Sequence[str] = ()) -> DataFrame:
    """Queue, retry and dead-letter depth at the end of every interval that the watermark has closed.

    ``lifecycle`` is a life-cycle log as a stream (``kind, attempt``) with a watermark on ``ts``. With
    ``keys`` there is one series per key, from its first interval with an event to its last.
    """
    one = lifecycle.withColumn("n", F.lit(1).cast("bigint")).withColumn("first", F.col("attempt") == 1)
    deltas = one.groupBy(F.window("ts", interval(every_s)), *keys).agg(
        F.sum(queue_delta()).alias("queue_depth"),
        F.sum(retry_delta()).alias("retry_depth"),
        F.count_if(F.col("kind") == "dlq").alias("dlq_depth"),
    )
    by = list(keys) or [_KEY]
    deltas = deltas.withColumn(_KEY, _one_key(deltas)) if not keys else deltas
    closed = deltas.select(*by, F.unix_micros("window.start").alias("start_us"), *DEPTHS)
    kinds = {f.name: f.dataType.simpleString() for f in lifecycle.schema.fields}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"{c} bigint" for c in ("start_us", "end_us", *DEPTHS)])
    return closed.groupBy(*by).transformWithStateInPandas(
        _RunningDepths(micros(every_s), keys), schema, "Append", "None"
    )


class _SessionLine(StatefulProcessor):
    """Joins panes into sessions; a session ends at the next one, or when the watermark leaves it behind."""

    def __init__(self, gap_us: int) -> None:
        self._gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("session", "start_us bigint, end_us bigint, count bigint, timer_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        panes = _in_order(rows, "first_us")
        first, last, count = (panes[c].to_numpy(np.int64) for c in ("first_us", "last_us", "count"))
        timer = None
        if self._open.exists():
            start, end, n, timer = self._open.get()
            first, last, count = np.r_[start, first], np.r_[end, last], np.r_[n, count]
        opens = np.nonzero(np.r_[True, first[1:] - last[:-1] > self._gap])[0]
        start, end, n = first[opens], last[np.r_[opens[1:] - 1, len(last) - 1]], np.add.reduceat(count, opens)
        # the last one may go on: events up to a gap later lie in a pane that ends within another gap
        closes_ms = -(-(int(end[-1]) + 2 * self._gap) // 1000)
        if timer is not None and timer != closes_ms:
            self._handle.deleteTimer(timer)
        if timer != closes_ms:
            self._handle.registerTimer(closes_ms)
        self._open.update((int(start[-1]), int(end[-1]), int(n[-1]), closes_ms))
        yield pd.DataFrame({"start_us": start[:-1], "end_us": end[:-1], "count": n[:-1]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, end, n, _ = self._open.get()
        self._open.clear()
        yield pd.DataFrame({"start_us": [start], "end_us": [end], "count": [n]})

    def close(self) -> None:
        pass


def stream_session_line(env: DataFrame, gap_s: float) -> DataFrame:
    """Closed sessions of the whole stream: ``start_us, end_us`` (of the last event), ``count``.

    Events of one pane, a window as wide as the gap, belong together, so the panes are counted
    like any window, spread over the cluster, and only closed panes meet in the session line.
    """
    panes = env.groupBy(F.window("ts", interval(gap_s))).agg(
        F.min(F.unix_micros("ts")).alias("first_us"), F.max(F.unix_micros("ts")).alias("last_us"),
        F.count(F.lit(1)).alias("count"),
    )
    closed = panes.select(_one_key(panes).alias(_KEY), F.window_time("window").alias("ts"), "first_us", "last_us", "count")
    return closed.groupBy(_KEY).transformWithStateInPandas(
        _SessionLine(micros(gap_s)), "start_us bigint, end_us bigint, count bigint", "Append", "EventTime"
    )


def stream_silences(env: DataFrame, gap_s: float, key: str = "producer_id") -> DataFrame:
    """An alarm for each silence of a producer: ``key, last_us, raised_us, events``.

    It is raised when the watermark says that nothing came for ``gap_s`` after ``last_us``, not
    when the producer's next event does, so a producer that never comes back has one too.
    The timer is that of a session: Spark drops a key's session, and gives it out, once the
    watermark has passed its end. ``events`` are those since the silence before.
    """
    ended = stream_sessions(env, gap_s, [key])
    return ended.select(
        key, F.col("end_us").alias("last_us"), (F.col("end_us") + micros(gap_s)).alias("raised_us"),
        F.col("count").alias("events"),
    )


def stream_retries(attempts: DataFrame, within_s: float, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Where each message stands when no attempt came for ``within_s``: ``message_id, status, failures``.

    ``attempts`` (``message_id, attempt, ok``) has a watermark on ``ts``. The attempts of a message may
    come in any batch and order; one small record per message in flight is kept, and dropped
    once the message is given out. An attempt that was delivered twice counts once.
    """
    made = attempts.where(F.col("attempt") <= max_retries)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("attempt"))
    # the state store keeps its keys in order, and a look-up steps over the removed ones that lie before the
    # next key: ids that go up with time are removed side by side, so a hash spreads them
    spread = F.xxhash64("message_id").alias("_spread")
    tried = made.groupBy(spread, "message_id", F.session_window("ts", interval(within_s))).agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("_ok"),
        F.bit_or(F.when(~F.col("ok"), bit).otherwise(F.lit(0).cast("bigint"))).alias("_failures"),
    )
    counted = tried.withColumn("_failed", F.bit_count("_failures").cast("bigint"))
    status, failures = outcome_of(max_retries)
    return counted.select("message_id", status.alias("status"), failures.alias("failures"))
