"""The given ``events`` table seen as event streams, topic logs, attempts and load runs.

The table has no partitions, producers or repeated ids, so those are derived from its
columns: four partitions and ten producers from the user, arrival times from the value,
and every ``error`` event delivered a second time one second later. All of it is made by
Spark from whole columns; nothing is sampled or left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.operators.topiclog import key_hash
from eventrill.session import shared_dir

NUM_PARTITIONS = 4
STREAM_BATCHES = 5
FILES_PER_BATCH = 2  # of a small table
ROWS_PER_FILE = 1_000_000
GROUP = "analytics"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _typed(raw: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.unix_micros("ts").alias("ts_us"),
        F.format_string("user_%04d", user).alias("partition_key"),
        F.pmod(user, F.lit(NUM_PARTITIONS)).cast("int").alias("partition"),
        (F.col("event_id") + 1).alias("sequence_number"),
        F.concat(F.lit("producer-"), F.pmod(user, F.lit(10)).cast("string")).alias("producer_id"),
        F.col("props").alias("payload"),
        F.col("value").alias("amount"),
        (F.unix_micros("ts") + F.round(F.col("value") * 1000).cast("bigint") - 5000).alias("received_at_us"),
        (F.col("event_id") * 2).alias("ordinal"),
        F.pmod(user, F.lit(3)).alias("_group"),
    )


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as envelopes, plus ``received_at_us`` and ``amount``.

    One scan: an ``error`` row is copied into its redelivery where it is read.
    """
    rows = _typed(raw_events(spark, sf_dir)).drop("_group")
    sightings = F.when(F.col("event_type") == "error", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = rows.withColumn("_again", F.explode(sightings))
    return copies.select(
        "event_id", "event_type",
        (F.col("ts_us") + F.col("_again") * 1_000_000).alias("ts_us"),
        "partition_key", "partition", "sequence_number", "producer_id", "payload", "amount",
        "received_at_us",
        (F.col("ordinal") + F.col("_again")).alias("ordinal"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer records: topic = event type; amounts from 50 up have no key, under 5 no acknowledgement."""
    env = envelope(spark, sf_dir)
    return env.select(
        F.col("event_type").alias("topic"),
        F.when(F.col("amount") < 50, F.col("partition_key")).alias("key"),
        F.col("payload").alias("value"),
        F.create_map(F.lit("producer"), F.col("producer_id")).alias("headers"),
        F.timestamp_micros("ts_us").alias("ts"),
        F.concat_ws("-", "event_id", "ordinal").alias("record_id"),
        F.when(F.col("amount") < 5, "none").otherwise("leader").alias("acks"),
        "ordinal",
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = F.greatest(F.max(F.pmod("user_id", F.lit(NUM_PARTITIONS))) + 1, F.lit(1)).cast("int")
    return raw_events(spark, sf_dir).groupBy(F.col("event_type").alias("topic")).agg(sizes.alias("num_partitions"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = F.concat(F.lit("consumer-"), F.pmod("user_id", F.lit(3)).cast("string"))
    return raw_events(spark, sf_dir).select(F.col("event_type").alias("topic"), member.alias("member_id")).distinct()


def commits_of(log: DataFrame) -> DataFrame:
    """Commits of the group: the unacknowledged records of each partition but ``signup``'s, less one."""
    done = F.count_if(F.col("acks") == "none") - 1
    per_partition = log.where(F.col("topic") != "signup").groupBy("topic", "partition").agg(done.alias("committed"))
    return per_partition.select(F.lit(GROUP).alias("group_id"), "topic", "partition", "committed")


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each producer feeds the topics in which it ever had an amount above 100."""
    rows = _typed(raw_events(spark, sf_dir)).where(F.col("amount") > 100)
    return rows.select("producer_id", F.col("event_type").alias("topic")).distinct()


def _fails(message_id: Column, attempt: Column) -> Column:
    return F.pmod(key_hash(F.concat_ws(":", message_id, attempt)), F.lit(100)) < 30


def produced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _typed(raw_events(spark, sf_dir))
    return rows.select(
        F.col("event_id").alias("message_id"), "producer_id", F.col("event_type").alias("topic"), "partition", "ts_us"
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three possible attempts per message, a second apart; a hash decides which fail."""
    rows = _typed(raw_events(spark, sf_dir)).withColumn("attempt", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    return rows.select(
        F.col("event_id").alias("message_id"),
        F.concat(F.lit("consumer-"), F.pmod("partition", F.lit(3)).cast("string")).alias("consumer_id"),
        F.col("event_type").alias("topic"),
        "partition",
        "attempt",
        (~_fails(F.col("event_id"), F.col("attempt"))).alias("ok"),
        (F.col("ts_us") + F.col("attempt") * 1_000_000).alias("ts_us"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load runs: one pattern per event type."""
    rows = _typed(raw_events(spark, sf_dir))
    return rows.select("event_id", "ts_us", F.col("event_type").alias("pattern"), "amount")


def enveloped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, without redeliveries, with every field of an envelope."""
    rows = _typed(raw_events(spark, sf_dir)).drop("_group")
    kind = "struct<schema_version: string, topic: string, num_partitions: int>"
    about = F.struct(F.lit("1.0"), F.col("event_type"), F.lit(NUM_PARTITIONS)).cast(kind)
    return rows.withColumn("metadata", about).withColumn("ts", F.timestamp_micros("ts_us"))


def event_stream(
    spark: SparkSession, sf_dir: str, late_s: float = 0, closing_s: float | None = None
) -> DataFrame:
    """The table as a stream of ``STREAM_BATCHES`` micro-batches of envelopes, ``ts`` the event time.

    The events (without redeliveries) are written in order of time, one part per batch. With
    ``late_s`` every tenth event counts as that much later when it is dealt to a part, so that
    some come a batch late, but no later than ``late_s``. With ``closing_s`` one more event,
    so much after the last one, ends the stream: it makes a bounded run give its last windows.
    """
    rows = _typed(raw_events(spark, sf_dir)).drop("_group").withColumn("ts", F.timestamp_micros("ts_us"))
    return _as_stream(rows, F.pmod("sequence_number", F.lit(10)) == 0, late_s, closing_s)


def _as_stream(rows: DataFrame, late: Column, late_s: float, closing_s: float | None, **closing: Column) -> DataFrame:
    """``rows`` in parts, by ``ts_us``; those that are ``late`` count as later; ``closing`` are columns of the last event."""
    spark = rows.sparkSession
    lo, hi = rows.agg(F.min("ts_us"), F.max("ts_us")).first()
    path, files = shared_dir(spark, "event-stream"), FILES_PER_BATCH
    if hi is None:
        rows.write.parquet(path)
    else:
        tardy = F.when(late, round(late_s * 1_000_000)).otherwise(0)
        width = max(1, -(-(hi - lo + 1) // STREAM_BATCHES))
        part = F.least(F.floor((F.col("ts_us") - lo + tardy) / width), F.lit(STREAM_BATCHES - 1))
        sizes = {r["part"]: r["count"] for r in rows.where(part.isNotNull()).groupBy(part.alias("part")).count().collect()}
        files = _files_per_batch([sizes.get(k, 0) for k in range(STREAM_BATCHES)])
        for k in range(STREAM_BATCHES):  # one after another: the files' times give their order
            rows.where(part == k).repartition(files).write.mode("append").parquet(path)
        if closing_s is not None:
            last = F.lit(hi + round(closing_s * 1_000_000)).cast("bigint")
            known = {"ts_us": last, "ts": F.timestamp_micros(last), **closing}
            end = spark.range(1).select(*[known.get(c, F.lit(None)).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
            end.write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _files_per_batch(sizes: list[int]) -> int:
    """How many files each part is written to, which a batch then reads, so that no task writes more than a bounded part.

    A batch is as many files as this, so every part must fill all of its files: where one is too
    small for that, all have as few as a small table.
    """
    files = -(-max(sizes) // ROWS_PER_FILE)
    return max(files, FILES_PER_BATCH) if min(sizes) >= 1_000 * files else FILES_PER_BATCH


def redelivered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_stream`` with the second deliveries of ``error`` events."""
    sightings = F.when(F.col("event_type") == "error", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = event_stream(spark, sf_dir, late_s=1_800).withColumn("_again", F.explode(sightings))
    later = F.col("ts_us") + F.col("_again") * 1_000_000
    return copies.withColumn("ts_us", later).withColumn("ts", F.timestamp_micros("ts_us")).drop("_again")


def attempt_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_stream(spark, sf_dir).withColumn("attempt", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    ok = ~_fails(F.col("event_id"), F.col("attempt"))
    return rows.select(F.col("event_id").alias("message_id"), "attempt", ok.alias("ok"))


def attempts_apart(spark: SparkSession, sf_dir: str, apart_s: float, late_s: float, closing_s: float) -> DataFrame:
    """The attempts of ``attempts`` as a stream, those of a message ``apart_s`` apart, so in different batches."""
    rows = _typed(raw_events(spark, sf_dir)).withColumn("attempt", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    rows = rows.select(
        F.col("event_id").alias("message_id"), "attempt", (~_fails(F.col("event_id"), F.col("attempt"))).alias("ok"),
        (F.col("ts_us") + (F.col("attempt") - 1) * round(apart_s * 1_000_000)).alias("ts_us"),
    )
    rows = rows.withColumn("ts", F.timestamp_micros("ts_us"))
    late = F.pmod(F.crc32("message_id") + F.col("attempt"), F.lit(10)) == 0
    # the event that ends the stream is an attempt, too: what is filtered out moves no watermark
    return _as_stream(rows, late, late_s, closing_s, attempt=F.lit(1))


def whole_lifecycle_stream(spark: SparkSession, sf_dir: str, **stream) -> DataFrame:
    """Everything that happens to each message, as ``lifecycle_log`` tells it of ``produced`` and ``attempts``."""
    def step(kind: Column, attempt: int | None, later_s: int, when: Column) -> Column:
        fields = F.struct(kind.alias("kind"), F.lit(attempt).cast("int").alias("attempt"), F.lit(later_s).alias("_later"))
        return F.when(when, fields)

    failed = [_fails(F.col("event_id"), F.lit(k)) for k in (1, 2, 3)]
    tries = [F.lit(True), failed[0], failed[0] & failed[1]]
    steps = [step(F.lit("produced"), None, 0, F.lit(True))]
    steps += [step(F.when(failed[k], "retry").otherwise("consumed"), k + 1, k + 1, tries[k]) for k in range(3)]
    steps.append(step(F.lit("dlq"), 3, 4, tries[2] & failed[2]))
    rows = event_stream(spark, sf_dir, **stream).select("ts_us", F.inline(F.array_compact(F.array(*steps))))
    return rows.select(F.timestamp_micros(F.col("ts_us") + F.col("_later") * 1_000_000).alias("ts"), "kind", "attempt")


def lifecycle_stream(spark: SparkSession, sf_dir: str, **stream) -> DataFrame:
    """Production and first attempt of each message, as they happen."""
    outcome = F.when(_fails(F.col("event_id"), F.lit(1)), "retry").otherwise("consumed")
    steps = F.array(
        F.struct(F.lit("produced").alias("kind"), F.lit(0).alias("_later")),
        F.struct(outcome.alias("kind"), F.lit(1).alias("_later")),
    )
    rows = event_stream(spark, sf_dir, **stream).select("ts_us", F.inline(steps))
    at = F.timestamp_micros(F.col("ts_us") + F.col("_later") * 1_000_000)
    return rows.select(at.alias("ts"), "kind")
