"""JSON-lines event logs and captured server-sent events, as typed envelopes.

Lines are parsed as VARIANT, which tells a missing field from a null one: a missing
field takes its default; a null or non-numeric value in a numeric field, or a line
that is no JSON object, makes the line a reject. Blank lines are skipped.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventrill.schema import ENVELOPE
from eventrill.session import broadcast_if_small, written

MAX_INFLATION = 1_100  # a compressed file holds at most so many lines per byte (deflate: 1,032)

_TYPE_DEFAULT_ANALYSIS = "unknown"
_TYPE_DEFAULT_CONSUMER = ""

ENVELOPE_COLUMNS = ENVELOPE.fieldNames()


def _missing(path: str) -> Column:
    return F.try_variant_get("_json", path, "variant").isNull()


def _text(name: str, default: str) -> Column:
    path = f"$.{name}"
    return F.when(_missing(path), default).otherwise(F.try_variant_get("_json", path, "string"))


def _number(name: str, kind: str) -> Column:
    """Numbers and numeric strings; missing is 0, anything else null (a reject)."""
    path = f"$.{name}"
    value = F.try_variant_get("_json", path, "string").try_cast(kind)
    return F.when(_missing(path), F.lit(0).cast(kind)).otherwise(value)


def to_envelope(lines: DataFrame, type_default: str = _TYPE_DEFAULT_ANALYSIS) -> DataFrame:
    """Lines (``value, ordinal``, any other columns kept) as envelopes with ``rejected``."""
    parsed = lines.where(F.col("value").rlike(r"\S")).withColumn("_json", F.try_parse_json("value"))
    is_object = F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    fields = F.struct(
        is_object.alias("_object"),
        _text("event_id", "").alias("event_id"),
        _text("event_type", type_default).alias("event_type"),
        # 15 decimals: cut, not rounded, to a whole number; 6 decimals are microseconds
        F.round(_number("timestamp", "decimal(24,6)") * 1_000_000).cast("bigint").alias("ts_us"),
        _text("partition_key", "").alias("partition_key"),
        _number("partition", "decimal(38,15)").cast("int").alias("partition"),
        _number("sequence_number", "decimal(38,15)").cast("bigint").alias("sequence_number"),
        _text("producer_id", "").alias("producer_id"),
        F.struct(
            F.try_variant_get("_json", "$.metadata.schema_version", "string").alias("schema_version"),
            F.try_variant_get("_json", "$.metadata.topic", "string").alias("topic"),
            F.try_variant_get("_json", "$.metadata.num_partitions", "int").alias("num_partitions"),
        ).alias("metadata"),
        F.to_json(F.try_variant_get("_json", "$.payload", "variant")).alias("payload"),
    )
    # A row of one through ``inline``: a filter on the fields then stays above the parsing
    # instead of repeating it.
    typed = parsed.select(*lines.columns, F.inline(F.array(fields)))
    bad_number = F.col("ts_us").isNull() | F.col("partition").isNull() | F.col("sequence_number").isNull()
    return typed.withColumn("ts", F.timestamp_micros("ts_us")).withColumn(
        "rejected", ~F.col("_object") | bad_number
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` and ``ordinal``, a number that grows along each file and from file to file.

    Within a file it is the byte at which the line's split starts plus the line's number
    in its task. A split ends before the next one starts, a line has at least one byte,
    and only the last split of a file can share a task with other splits, so this never
    runs backwards. Files, by path, begin where the sizes of those before them end.
    """
    line_no = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") + line_no).alias("_at"),
    )
    # one short row per file, taken from the listing: the contents are not read
    sizes = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("_bytes")
    )
    earlier = F.sum(F.col("_bytes") * MAX_INFLATION + 1).over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = sizes.select("file", F.coalesce(earlier, F.lit(0)).alias("_begin"))
    ordinal = F.col("_begin") + F.col("_at")
    joined = rows.join(broadcast_if_small(written(begins, "files")), "file")
    return joined.withColumn("ordinal", ordinal).select("value", "file", "ordinal")


def read_event_log(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(envelopes, rejected lines) for analysis; an event without a type is ``unknown``."""
    return _split(to_envelope(_lines(spark, path)))


def replay_event_log(
    spark: SparkSession, path: str | list[str], received_at_us: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(envelopes with ``received_at_us``, rejected lines) for consumption, in file order by ``ordinal``.

    All events of one replay are received at one time, that of this call if none is given:
    a time that differed from job to job would give other latencies each time it is read.
    """
    env, rejects = _split(to_envelope(_lines(spark, path), _TYPE_DEFAULT_CONSUMER))
    now = time.time_ns() // 1_000 if received_at_us is None else received_at_us
    return env.withColumn("received_at_us", F.lit(now).cast("bigint")), rejects


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = rows.where(~F.col("rejected")).select(*ENVELOPE_COLUMNS)
    return good, rows.where("rejected").select("file", "ordinal", "value")


def read_event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Envelopes of a growing directory of JSON-lines files, as a streaming DataFrame.

    ``files_per_trigger`` paces a replay. ``ordinal`` is when the line's file was written.
    Lines read and rejected are counted per micro-batch in the query's progress, as
    ``observedMetrics["lines"]``.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    written_at = F.unix_micros("_metadata.file_modification_time")
    lines = reader.load(path).select("value", written_at.alias("ordinal"))
    parsed = to_envelope(lines, _TYPE_DEFAULT_CONSUMER)
    counted = parsed.observe(
        "lines", F.count(F.lit(1)).alias("read"), F.coalesce(F.count_if("rejected"), F.lit(0)).alias("rejected")
    )
    rows = counted.where(~F.col("rejected")).select(*ENVELOPE_COLUMNS)
    return rows.withColumn("received_at_us", F.unix_micros(F.current_timestamp()))


def read_sse_capture(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(envelopes, rejected lines) of captured server-sent events: the ``data:`` lines."""
    data = _lines(spark, path).where(F.col("value").startswith("data:"))
    body = F.regexp_replace(F.substring("value", 6, 2_147_483_647), r"^\s+|\s+$", "")
    return _split(to_envelope(data.withColumn("value", body), _TYPE_DEFAULT_CONSUMER))


def to_json_line(env: DataFrame) -> Column:
    """An envelope as one compact JSON object, as ``read_event_log`` reads it back."""
    return F.to_json(
        F.struct(
            "event_id",
            "event_type",
            (F.col("ts_us").cast("decimal(24,6)") / 1_000_000).cast("decimal(24,6)").alias("timestamp"),
            "partition_key",
            "partition",
            "sequence_number",
            "producer_id",
            "metadata",
            F.try_parse_json("payload").alias("payload"),
        ),
        {"ignoreNullFields": "false"},
    )


def write_event_log(env: DataFrame, path: str, mode: str = "append") -> None:
    env.select(to_json_line(env).alias("value")).write.mode(mode).text(path)


def format_sse(env: DataFrame) -> DataFrame:
    """Event-stream frames; the text sink's line end makes the blank line after each."""
    frame = F.concat(F.lit("id: "), "event_id", F.lit("\ndata: "), to_json_line(env), F.lit("\n"))
    return env.select(frame.alias("value"))


def write_sse(env: DataFrame, path: str, mode: str = "append") -> None:
    format_sse(env).write.mode(mode).text(path)


def write_noop(df: DataFrame) -> None:
    """Compute everything, keep nothing."""
    df.write.format("noop").mode("overwrite").save()
