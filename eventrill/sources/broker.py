"""A message broker as a source of topic-log records (needs Spark's Kafka package)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_kafka(spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, **options: str) -> DataFrame:
    """Records ``topic, partition, offset, key, value, headers, ts`` of ``topics``.

    ``options`` go to the connector, such as ``startingOffsets`` or ``maxOffsetsPerTrigger``.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    raw = reader.option("includeHeaders", "true").options(**options).load()
    headers = F.map_from_entries(
        F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string")))
    )
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        headers.alias("headers"),
        F.col("timestamp").alias("ts"),
    )
