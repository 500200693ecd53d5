"""Operators on a partitioned topic log held as a table.

A log row is a record (``topic, key, value, headers, ts, record_id, acks``) with
its ``partition, offset, size_bytes, checksum``. Side tables: ``topics(topic,
num_partitions)``, ``commits(group_id, topic, partition, committed)``,
``assignments(member_id, topic, partition)``. Where one meets log rows it is counted
first and broadcast only if it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrill.operators.order import OrderedScan
from eventrill.session import broadcast_if_small

TP = ["topic", "partition"]
NO_OFFSET = -1
RECORD_OVERHEAD_BYTES = 64
RETENTION_BYTES = 10 * 1024 * 1024
STRATEGIES = ("key", "roundrobin")


def key_hash(key: Column) -> Column:
    """A fixed, well-spread hash of a string: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def key_partition(key: Column, num_partitions: Column) -> Column:
    """Same key, same partition; records without a key go to partition 0."""
    return F.when(key.isNull(), 0).otherwise(F.pmod(key_hash(key), num_partitions)).cast("int")


def _check(num_partitions: int, strategy: str) -> None:
    if num_partitions < 1:
        raise ValueError("num_partitions must be at least 1")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose one of {', '.join(STRATEGIES)}")


def assign_partition(
    df: DataFrame,
    key: str,
    num_partitions: int,
    strategy: str = "key",
    scope: Sequence[str] = (),
    order: Sequence[str] = ("ordinal",),
    **scan_args,
) -> DataFrame:
    """Set ``partition`` by key, or in turn over the rows of each ``scope`` in ``order``."""
    _check(num_partitions, strategy)
    if strategy == "key":
        return df.withColumn("partition", key_partition(F.col(key), F.lit(num_partitions)))
    ranked = OrderedScan(df.drop("partition"), scope, order, **scan_args).rank("_turn").result()
    turn = F.pmod(F.col("_turn") - 1, F.lit(num_partitions)).cast("int")
    return ranked.withColumn("partition", turn).drop("_turn")


def with_record_size(records: DataFrame) -> DataFrame:
    size = F.length("value") + F.length(F.coalesce("key", F.lit(""))) + RECORD_OVERHEAD_BYTES
    return records.withColumn("size_bytes", size.cast("bigint"))


def canonical_json(value: Column) -> Column:
    """JSON without spaces and with the keys of all objects sorted, however deep: equal content is equal text.

    A VARIANT keeps its keys sorted. What is no JSON stays as it is.
    """
    return F.coalesce(F.to_json(F.try_parse_json(value)), value)


def content_checksum(value: Column) -> Column:
    """60 bits of the MD5 of the canonical JSON."""
    return F.conv(F.substring(F.md5(canonical_json(value)), 1, 15), 16, 10).cast("bigint")


def with_checksum(records: DataFrame) -> DataFrame:
    return records.withColumn("checksum", content_checksum(F.col("value")))


def flatten_log(log: DataFrame) -> DataFrame:
    """The flat listing of log entries."""
    return log.select("offset", "partition", "ts", "key", "value", "headers", "record_id", "checksum")


def _with_topic(records: DataFrame, topics: DataFrame) -> DataFrame:
    """Attach ``num_partitions``; a record of an unknown topic fails the query.

    The check sits in ``topic``, which every use of the log reads, so it is never pruned.
    """
    dim = broadcast_if_small(topics.select("topic", "num_partitions"))
    fail = F.raise_error(F.concat(F.lit("unknown topic: "), F.col("topic")))
    joined = records.join(dim, "topic", "left")
    return joined.withColumn("topic", F.when(F.col("num_partitions").isNull(), fail).otherwise(F.col("topic")))


def append_log(
    records: DataFrame,
    topics: DataFrame,
    log: DataFrame | None = None,
    strategy: str = "key",
    **scan_args,
) -> DataFrame:
    """The rows that appending ``records`` (in ``ordinal`` order) adds to ``log``.

    Offsets go on from each partition's end. In-turn placement starts at each topic's
    partition 0 for every batch, and gives the offset by division.
    """
    _check(1, strategy)
    known = _with_topic(records, topics)
    if strategy == "roundrobin":
        known = OrderedScan(known, ["topic"], ["ordinal"], **scan_args).rank("_turn").result()
        n = F.col("num_partitions")
        placed = known.select(
            *records.columns,
            F.pmod(F.col("_turn") - 1, n).cast("int").alias("partition"),
            F.floor((F.col("_turn") - 1) / n).cast("bigint").alias("_nth"),
        )
    else:
        keyed = known.withColumn("partition", key_partition(F.col("key"), F.col("num_partitions")))
        ranked = OrderedScan(keyed.drop("num_partitions"), TP, ["ordinal"], **scan_args).rank("_r").result()
        placed = ranked.withColumn("_nth", F.col("_r") - 1).drop("_r")
    if log is not None:
        ends = broadcast_if_small(log.groupBy(*TP).agg((F.max("offset") + 1).alias("_end")))
        placed = placed.join(ends, TP, "left").withColumn("_nth", F.col("_nth") + F.coalesce("_end", F.lit(0)))
        placed = placed.drop("_end")
    return with_checksum(with_record_size(placed.withColumnRenamed("_nth", "offset")))


def topic_partitions(topics: DataFrame) -> DataFrame:
    """Every partition of ``topics(topic, num_partitions)``, with records or without."""
    numbers = F.sequence(F.lit(0), (F.col("num_partitions") - 1).cast("int"))
    return topics.where("num_partitions > 0").select("topic", F.explode(numbers).alias("partition"))


def topic_stats(log: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    """Per partition: log start, high watermark, end, entries, bytes.

    With ``topics`` their partitions without records are there too, all zero. The high watermark follows the last record appended with acknowledgement; an
    acknowledged record also makes the unacknowledged ones before it readable.
    """
    acked = F.max(F.when(F.col("acks") != "none", F.col("offset")))
    found = log.groupBy(*TP).agg(
        F.min("offset").alias("log_start_offset"),
        (F.coalesce(acked, F.lit(-1)) + 1).cast("bigint").alias("high_watermark"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("entries"),
        F.sum("size_bytes").alias("total_bytes"),
    )
    if topics is None:
        return found
    return topic_partitions(topics).join(found, TP, "left").fillna(0)


def watermarks(log: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    return topic_stats(log, topics).select(*TP, "high_watermark", "end_offset")


def _first_per_partition(rows: DataFrame, n: int) -> DataFrame:
    # ``row_number <= n`` also cuts each map task's share to n rows before the shuffle,
    # so a partition with most of the log sends n rows per task, not its rows
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*TP).orderBy("offset")))
    return ranked.where(F.col("_r") <= n).drop("_r")


def read_log(
    log: DataFrame,
    start_offsets: DataFrame | None = None,
    max_records: int = 500,
    isolation: str = "uncommitted",
) -> DataFrame:
    """Up to ``max_records`` per partition from ``start_offsets(topic, partition, start)`` on.

    Partitions without a start are read from the log start. ``committed`` stops at the
    high watermark.
    """
    if isolation not in ("uncommitted", "committed"):
        raise ValueError(f"unknown isolation {isolation!r}")
    rows = log
    if start_offsets is not None:
        starts = broadcast_if_small(start_offsets.select(*TP, "start"))
        rows = rows.join(starts, TP, "left").where(F.col("offset") >= F.coalesce("start", F.lit(0))).drop("start")
    if isolation == "committed":
        marks = broadcast_if_small(watermarks(log).select(*TP, "high_watermark"))
        rows = rows.join(marks, TP).where(F.col("offset") < F.col("high_watermark")).drop("high_watermark")
    return _first_per_partition(rows, max_records)


def committed_offset(partitions: DataFrame, commits: DataFrame, group_id: str) -> DataFrame:
    """``partitions`` with the group's ``committed`` offset, −1 where it has none."""
    mine = commits.where(F.col("group_id") == group_id).select(*TP, "committed")
    known = F.coalesce("committed", F.lit(NO_OFFSET)).cast("bigint")
    return partitions.join(mine, TP, "left").withColumn("committed", known)


def commit_offset(commits: DataFrame, new: DataFrame, groups: DataFrame) -> DataFrame:
    """``commits`` with the rows of ``new`` put in place; an unregistered group fails the query."""
    registered = groups.select("group_id", F.lit(True).alias("_known"))
    message = F.concat(F.lit("group not registered: "), F.col("group_id"))
    checked = (
        new.join(registered, "group_id", "left")
        .withColumn("group_id", F.when(F.col("_known"), F.col("group_id")).otherwise(F.raise_error(message)))
        .select("group_id", *TP, "committed")
    )
    kept = commits.join(checked, ["group_id", *TP], "left_anti").select("group_id", *TP, "committed")
    return kept.unionByName(checked)


def poll(
    log: DataFrame, commits: DataFrame, assignments: DataFrame, group_id: str, max_records: int = 50
) -> tuple[DataFrame, DataFrame]:
    """One poll of every assigned member: (records with ``member_id``, the offsets they commit)."""
    starts = committed_offset(assignments.select("member_id", *TP), commits, group_id)
    rows = log.join(broadcast_if_small(starts), TP).where(F.col("offset") > F.col("committed")).drop("committed")
    fetched = _first_per_partition(rows, max_records)
    new = fetched.groupBy(*TP).agg(F.max("offset").alias("committed"))
    return fetched, new.select(F.lit(group_id).alias("group_id"), *TP, "committed")


def consumer_lag(log: DataFrame, commits: DataFrame, group_id: str, topics: DataFrame | None = None) -> DataFrame:
    """Records not yet committed per partition; with ``topics`` also of partitions without records (0)."""
    ends = log.groupBy(*TP).agg((F.max("offset") + 1).alias("end_offset"))
    if topics is not None:
        ends = topic_partitions(topics).join(ends, TP, "left").fillna(0, ["end_offset"])
    behind = F.greatest(F.col("end_offset") - (F.col("committed") + 1), F.lit(0))
    return committed_offset(ends, commits, group_id).withColumn("lag", behind)


def lag_by_consumer(partition_lag: DataFrame, assignments: DataFrame) -> DataFrame:
    """Lag summed over each member's partitions; partitions without a log count as 0."""
    rows = assignments.join(partition_lag.select(*TP, "lag"), TP, "left")
    return rows.groupBy("member_id").agg(F.sum(F.coalesce("lag", F.lit(0))).alias("lag"))


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).cast("bigint").alias("total_lag"))


def apply_retention(log: DataFrame, retention_bytes: int = RETENTION_BYTES, **scan_args) -> DataFrame:
    """Per partition, the longest tail of the log within ``retention_bytes``; at least one record."""
    scan = OrderedScan(log, TP, ["offset"], **scan_args)
    tail = scan.running_sum("_tail_bytes", "size_bytes", from_end=True).result()
    # the newest record is the one whose tail is itself alone
    newest = F.col("_tail_bytes") == F.col("size_bytes")
    return tail.where((F.col("_tail_bytes") <= retention_bytes) | newest).drop("_tail_bytes")


def compact(log: DataFrame) -> DataFrame:
    """The last record of each key per partition; records without a key all stay.

    Only offsets are aggregated, by hash and with a map-side part, so a key with most of the
    log is reduced before the shuffle; the rows are then picked by partition and offset.
    """
    last = log.where(F.col("key").isNotNull()).groupBy(*TP, "key").agg(F.max("offset").alias("offset"))
    kept = log.where(F.col("key").isNotNull()).join(last.select(*TP, "offset"), [*TP, "offset"], "left_semi")
    return log.where(F.col("key").isNull()).unionByName(kept.select(*log.columns))


def list_topics(topics: DataFrame) -> DataFrame:
    return topics.select("topic").distinct().orderBy("topic")


def create_topics(topics: DataFrame, new: DataFrame) -> DataFrame:
    """``topics`` and ``new`` together; a name that is taken fails the query."""
    both = topics.select("topic", "num_partitions").unionByName(new.select("topic", "num_partitions"))
    message = F.concat(F.lit("topic exists: "), F.col("topic"))
    grouped = both.groupBy("topic").agg(F.count(F.lit(1)).alias("_n"), F.max("num_partitions").alias("num_partitions"))
    once = F.when(F.col("_n") == 1, F.col("topic")).otherwise(F.raise_error(message))
    return grouped.select(once.alias("topic"), "num_partitions")


def drop_topics(topics: DataFrame, names: DataFrame) -> DataFrame:
    """``topics`` without ``names``; a name that is not there fails the query."""
    there = topics.join(names.select("topic", F.lit(True).alias("_drop")), "topic", "full")
    fail = F.raise_error(F.concat(F.lit("unknown topic: "), F.col("topic"))).cast("boolean")
    stays = F.when(F.col("num_partitions").isNull(), fail).otherwise(F.col("_drop").isNull())
    return there.where(stays).drop("_drop")


def active_members(members: DataFrame, connected: DataFrame, crashed: DataFrame | None = None) -> DataFrame:
    """Members connected to the topic and not crashed."""
    active = members.join(connected.select("topic", "member_id"), ["topic", "member_id"], "left_semi")
    if crashed is not None:
        active = active.join(crashed.select("member_id"), "member_id", "left_anti")
    return active.select("topic", "member_id")


def assign_members(partitions: DataFrame, members: DataFrame, strategy: str = "range") -> DataFrame:
    """Which member reads which partition: ``topic, partition, member_id``.

    ``partitions(topic, num_partitions)``, ``members(topic, member_id)``. *range* gives each
    member (by id) a run of ``max(1, P // M)`` partitions and the last one the rest;
    *roundrobin* deals them out in turn. A topic without members is not assigned.
    """
    if strategy not in ("range", "roundrobin"):
        raise ValueError(f"unknown strategy {strategy!r}; choose range or roundrobin")
    per_topic = Window.partitionBy("topic")
    ranked = members.select("topic", "member_id").distinct()
    ranked = ranked.withColumn("_m", F.row_number().over(per_topic.orderBy("member_id")) - 1)
    sizes = ranked.groupBy("topic").agg(F.count(F.lit(1)).cast("int").alias("_members"))
    spread = partitions.join(sizes, "topic").select(
        "topic", "num_partitions", "_members", F.explode(F.sequence(F.lit(0), F.col("num_partitions") - 1)).alias("partition")
    )
    p, m = F.col("partition"), F.col("_members")
    chunk = F.greatest(F.lit(1), F.floor(F.col("num_partitions") / m))
    index = F.least(F.floor(p / chunk), m - 1) if strategy == "range" else F.pmod(p, m)
    spread = spread.withColumn("_m", index.cast("int"))
    return spread.join(ranked, ["topic", "_m"]).select("topic", "partition", "member_id")
