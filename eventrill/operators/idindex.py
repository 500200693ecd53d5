"""Ids that earlier runs have seen: a bucketed index, with a Bloom filter before it.

An id's hash gives its bucket, and a bit in a bitmap of that bucket. Each run stores the ids it
accepted, by bucket, and the bits they set. A later run first asks the bitmaps: an id whose
bit is not set was never seen, which settles nearly all new ids without reading any stored
one. Only ids that may have been seen are looked up, in their buckets' files alone, and the
exact anti join then has these few on one side.

A run is stored under its number and replaced if it is run again; it sees only runs of
smaller numbers. So a repeated run, or micro-batch, gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.operators.consumer import dedup_first
from eventrill.session import broadcast_if_small, written

BUCKETS = 64
IDS_PER_BUCKET = 1_000_000  # expected; with more, more ids have to be looked up
BITS_PER_ID = 16  # about one new id in sixteen is looked up for nothing
_SEGMENT = 32_768  # bits of one bitmap of Spark

IDS = "event_id string, run bigint, bucket int"
BITS = "bucket int, segment bigint, bits binary, run bigint"


class IdIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, ids_per_bucket: int = IDS_PER_BUCKET) -> None:
        self._spark, self._path, self._buckets = spark, path.rstrip("/"), buckets
        self._segments = max(1, -(-ids_per_bucket * BITS_PER_ID // _SEGMENT))
        for name, schema, by in (("ids", IDS, ["run", "bucket"]), ("bits", BITS, ["run"])):
            none = spark.createDataFrame([], schema)
            none.write.mode("append").partitionBy(*by).parquet(f"{self._path}/{name}")

    def _hashed(self, rows: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64("event_id", F.lit("bit")), F.lit(self._segments * _SEGMENT))
        return rows.withColumns({
            "bucket": F.pmod(F.xxhash64("event_id"), F.lit(self._buckets)).cast("int"),
            "segment": F.call_function("div", slot, F.lit(_SEGMENT)),
            "bit": F.pmod(slot, F.lit(_SEGMENT)),
        })

    def known(self, run: int) -> DataFrame:
        """Ids of the runs before ``run``, with their ``bucket``."""
        stored = self._spark.read.schema(IDS).parquet(f"{self._path}/ids")
        return stored.where(F.col("run") < run)

    def maybe_seen(self, rows: DataFrame, run: int) -> DataFrame:
        """``event_id, bucket`` of the rows whose bit an earlier run has set."""
        stored = self._spark.read.schema(BITS).parquet(f"{self._path}/bits").where(F.col("run") < run)
        bits = written(stored.groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits")), "bits")
        joined = self._hashed(rows.select("event_id")).join(broadcast_if_small(bits, 2_000), ["bucket", "segment"])
        byte = F.conv(F.hex(F.substring("bits", (F.call_function("div", F.col("bit"), F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10)
        is_set = F.call_function("shiftright", byte.cast("int"), F.pmod(F.col("bit"), F.lit(8)).cast("int")).bitwiseAND(1) == 1
        return joined.where(is_set).select("event_id", "bucket").distinct()

    def seen(self, rows: DataFrame, run: int) -> DataFrame:
        """``event_id`` of the rows that an earlier run has accepted."""
        maybe = written(self.maybe_seen(rows, run), "maybe-seen")
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # at most one per bucket
        known = self.known(run).where(F.col("bucket").isin(buckets))
        return known.join(broadcast_if_small(maybe), ["event_id", "bucket"], "left_semi").select("event_id").distinct()

    def first_seen(self, rows: DataFrame, run: int) -> DataFrame:
        """The first arrival of every id that no earlier run has accepted; these ids are stored as the run's.

        A null id is never seen before; of a run's null ids the first one counts.
        """
        first = written(dedup_first(rows), "first")
        seen = written(self.seen(first, run), "seen")
        fresh = written(first.join(broadcast_if_small(seen), "event_id", "left_anti").select(*rows.columns), "fresh")
        ids = self._hashed(fresh.where(F.col("event_id").isNotNull()).select("event_id")).withColumn("run", F.lit(run).cast("bigint"))
        bits = ids.groupBy("bucket", "segment", "run").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self._replace(ids.select("event_id", "run", "bucket").repartition("bucket"), "ids", run, ["run", "bucket"])
        self._replace(bits.select("bucket", "segment", "bits", "run"), "bits", run, ["run"])
        return fresh

    def _replace(self, rows: DataFrame, name: str, run: int, by: list[str]) -> None:
        """Stores a run's rows; what it stored before under this number goes."""
        inner = [c for c in by if c != "run"]
        writer = rows.drop("run").write.mode("overwrite")
        (writer.partitionBy(*inner) if inner else writer).parquet(f"{self._path}/{name}/run={run}")


class FirstSeen:
    """``foreachBatch`` handler: the rows of each micro-batch whose id is new, over all batches and restarts."""

    def __init__(self, index: IdIndex, out: str) -> None:
        self._index, self._out = index, out.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fresh = self._index.first_seen(batch, batch_id)
        fresh.write.mode("overwrite").parquet(f"{self._out}/batch={batch_id}")
