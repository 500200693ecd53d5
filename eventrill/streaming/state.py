"""Stream state kept as tables: committed offsets, gap alarms, retry routing.

Each micro-batch runs a batch operator over its rows and the state left by the batch
before, so a heavy producer or partition is split up like in a batch job, and no state
sits in one Python worker. State is written per batch id: a batch that is run again
after a failure reads the same predecessor and replaces its own output.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.functions.times import micros
from eventrill.operators.lifecycle import MAX_RETRIES, route_retries
from eventrill.operators.order import OrderedScan
from eventrill.session import broadcast_if_small


class BatchTable:
    """A table with one folder per batch id.

    With ``keep`` only the newest so many batches stay: state needs the one before, for a
    batch that is run again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int | None = None) -> None:
        self._spark, self._path, self._schema, self._keep = spark, path.rstrip("/"), schema, keep

    def before(self, batch_id: int) -> DataFrame:
        """What the batch before wrote; empty for the first one."""
        if batch_id == 0:
            return self._spark.createDataFrame([], self._schema)
        return self._read(f"{self._path}/batch={batch_id - 1}")

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        path = f"{self._path}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        if self._keep:
            for old in self._batches():
                if old <= batch_id - self._keep:
                    self._folder(f"{self._path}/batch={old}", delete=True)
        return self._read(path)

    def all(self) -> DataFrame:
        """The output of all batches, with their ``batch``."""
        return self._spark.read.schema(f"{self._schema}, batch bigint").parquet(self._path)

    def latest(self) -> DataFrame:
        """What the last batch wrote, which may be no row at all."""
        return self.before(max(self._batches(), default=-1) + 1)

    def _batches(self) -> list[int]:
        """Batch ids by the names of their folders."""
        names = self._folder(self._path)
        return [int(m.group(1)) for m in (re.fullmatch(r"batch=(\d+)", n) for n in names) if m]

    def _folder(self, path: str, delete: bool = False) -> list[str]:
        """Names in a folder of whatever store the path is in, which may not exist yet."""
        jvm = self._spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
        if delete:
            store.delete(at, True)
            return []
        return [f.getPath().getName() for f in store.listStatus(at)] if store.exists(at) else []

    def _read(self, path: str) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(path)


class OffsetCommits:
    """``foreachBatch`` handler: after each batch, the greatest sequence number per partition."""

    SCHEMA = "partition int, committed bigint"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = BatchTable(spark, path, self.SCHEMA, keep=2)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = batch.groupBy("partition").agg(F.max("sequence_number").alias("committed"))
        both = self.table.before(batch_id).unionByName(seen)
        self.table.write(both.groupBy("partition").agg(F.max("committed").alias("committed")), batch_id)

    def lag(self, pending: DataFrame) -> DataFrame:
        """``pending(partition, pending)`` against what is committed."""
        known = pending.join(self.table.latest(), "partition", "left")
        committed = F.coalesce("committed", F.lit(-1))
        return known.select(
            "partition", "pending", committed.alias("committed"),
            F.greatest(F.col("pending") - committed, F.lit(0)).alias("lag"),
        )


class GapAlarms:
    """``foreachBatch`` handler: per producer, silences above ``gap_s`` and jumps in the sequence.

    ``alarms`` holds ``producer_id, kind, start_us, end_us, missing``. Within a batch events
    are taken in sequence order; an event numbered below what was already seen raises none.
    """

    STATE = "producer_id string, sequence_number bigint, ts_us bigint"
    ALARMS = "producer_id string, kind string, start_us bigint, end_us bigint, missing bigint"

    def __init__(self, spark: SparkSession, path: str, gap_s: float) -> None:
        self.state = BatchTable(spark, f"{path}/state", self.STATE, keep=2)
        self.alarms = BatchTable(spark, f"{path}/alarms", self.ALARMS)
        self._gap_us = micros(gap_s)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        known = self.state.before(batch_id)
        last = broadcast_if_small(known.select(F.col("producer_id").alias("_p"), F.col("sequence_number").alias("_last")))
        new = batch.select("producer_id", "sequence_number", "ts_us").join(
            last, F.col("producer_id").eqNullSafe(F.col("_p")), "left"
        )
        # what is numbered at or below the state is late or seen: it raises none and hides none
        new = new.where(F.col("_last").isNull() | (F.col("sequence_number") > F.col("_last")))
        rows = new.select("producer_id", "sequence_number", "ts_us").unionByName(known)
        scan = OrderedScan(rows, ["producer_id"], ["sequence_number", "ts_us"])
        steps = scan.lag(_seq="sequence_number", _us="ts_us").result()
        missing = F.col("sequence_number") - F.col("_seq") - 1
        silence = F.col("ts_us") - F.col("_us") > self._gap_us
        kinds = F.array_compact(
            F.array(F.when(missing > 0, "sequence_gap"), F.when(silence, "rate_gap"))
        )
        raised = steps.where(F.col("_seq").isNotNull()).select(
            "producer_id", F.explode(kinds).alias("kind"), F.col("_us").alias("start_us"),
            F.col("ts_us").alias("end_us"), missing.alias("missing"),
        )
        counted = F.when(F.col("kind") == "sequence_gap", F.col("missing")).cast("bigint")
        self.alarms.write(raised.withColumn("missing", counted), batch_id)
        newest = rows.groupBy("producer_id").agg(
            F.max(F.struct("sequence_number", "ts_us")).alias("_last")
        )
        self.state.write(newest.select("producer_id", "_last.sequence_number", "_last.ts_us"), batch_id)


class RetryRouter:
    """``foreachBatch`` handler: where each message stands after its attempts so far.

    Takes ``message_id, attempt, ok``. ``outcomes`` holds ``message_id, status, failures`` for
    every message a batch touched. Only attempts of messages still pending are carried to
    the next batch, so the state is as large as what is in flight. An ended message gets no
    further attempts; one that arrives all the same begins a new message.
    """

    OUTCOMES = "message_id string, status string, failures bigint"
    CARRIED = "message_id string, attempt int, ok boolean"

    def __init__(self, spark: SparkSession, path: str, max_retries: int = MAX_RETRIES) -> None:
        self.outcomes = BatchTable(spark, f"{path}/outcomes", self.OUTCOMES)
        self.carried = BatchTable(spark, f"{path}/carried", self.CARRIED, keep=2)
        self._max = max_retries

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        new = batch.select("message_id", "attempt", "ok")
        touched = new.select("message_id").distinct()
        waiting = self.carried.before(batch_id)
        rows = new.unionByName(waiting)
        routed = route_retries(rows, self._max).select("message_id", "status", "failures")
        written = self.outcomes.write(routed.join(touched, "message_id", "left_semi"), batch_id)
        ended = written.where(F.col("status") != "pending").select("message_id")
        self.carried.write(rows.join(ended, "message_id", "left_anti"), batch_id)

    def newest(self) -> DataFrame:
        """The newest outcome of every message over all batches."""
        last = F.max(F.struct("batch", "status", "failures")).alias("_last")
        rows = self.outcomes.all().groupBy("message_id").agg(last)
        return rows.select("message_id", "_last.status", "_last.failures")
