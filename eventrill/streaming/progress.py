"""What a running query has read, let through, left out and found late, as a table.

Counts are taken while the rows pass (``observe``): no job of their own, and no second pass.
"""

from __future__ import annotations

import threading
from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from eventrill.operators.consumer import accepts

COUNTS = "events"
ROWS = "batch bigint, rows bigint, received bigint, filtered_out bigint, processed bigint, late bigint"


def _counts(passes):
    zero = F.lit(0).cast("bigint")
    return [
        F.count(F.lit(1)).alias("received"),
        F.coalesce(F.count_if(~passes), zero).alias("filtered_out"), F.coalesce(F.count_if(passes), zero).alias("processed"),
    ]


def counted_filter(env: DataFrame, types: Collection[str] | None = None, partitions: Collection[int] | None = None, observation: Observation | None = None) -> DataFrame:
    """The events that pass, counted on the way: into ``observation`` in batch, into the progress of a stream."""
    passes = F.coalesce(accepts(types, partitions), F.lit(False))
    marked = env.withColumn("_passes", passes)
    seen = marked.observe(observation or COUNTS, *_counts(F.col("_passes")))
    return seen.where("_passes").drop("_passes")


class ProgressRows(StreamingQueryListener):
    """Keeps a row per micro-batch of the queries that run while it listens.

    ``late`` are the rows that the watermark dropped, as the stateful operators report them.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._rows, self._ended = spark, {}, threading.Event()

    def __enter__(self) -> "ProgressRows":
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        # events come in their own thread: the end of the query comes after all of its batches
        if failure[0] is None and not self._ended.wait(60):
            raise TimeoutError("the query's end was not reported")
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(COUNTS)
        counts = [seen[c] for c in ("received", "filtered_out", "processed")] if seen else [None] * 3
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if p.numInputRows or late:
            self._rows[p.batchId] = (p.batchId, p.numInputRows, *counts, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def table(self) -> DataFrame:
        """``batch, rows, received, filtered_out, processed, late``: a row per micro-batch that read something."""
        return self._spark.createDataFrame(sorted(self._rows.values()), ROWS)
