"""The event envelope, payload structs and anomaly report schema."""

from __future__ import annotations

from pyspark.sql import types as T

METADATA = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("num_partitions", T.IntegerType()),
    ]
)

# ``ts_us`` carries the time in whole microseconds: all window and gap arithmetic
# is done on it, so bucket edges never drift. ``ordinal`` is the arrival order.
ENVELOPE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("producer_id", T.StringType()),
        T.StructField("metadata", METADATA),
        T.StructField("payload", T.StringType()),
        T.StructField("ordinal", T.LongType()),
    ]
)

# The six event types and the fields of their payloads.
PAYLOADS: dict[str, str] = {
    "PageView": (
        "user_id string, page string, referrer string, session_id string, duration_ms int, "
        "viewport struct<w: int, h: int>"
    ),
    "Click": "user_id string, element string, x int, y int, page string",
    "Purchase": (
        "user_id string, order_id string, product_id string, quantity int, "
        "unit_price_usd double, total_usd double, currency string, payment_method string"
    ),
    "Heartbeat": "host string, status string, uptime_s int",
    "MetricSample": (
        "host string, cpu_pct double, mem_mb int, disk_io_kbps int, net_rx_kbps int, "
        "net_tx_kbps int, metric_name string"
    ),
    "SensorReading": (
        "sensor_id string, temperature_c double, humidity_pct double, pressure_hpa double, "
        "battery_pct int"
    ),
}

ANOMALY = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("start_us", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)
