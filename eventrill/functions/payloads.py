"""Typed payloads: parsing them, and making synthetic ones as expressions.

A synthetic value is picked by 16 bits of the MD5 of a seed string, so a row gets
the same event however often and wherever it is computed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.schema import PAYLOADS

# What synthetic payloads choose from.
PAGES = ["/", "/pricing", "/docs", "/blog", "/signup", "/login", "/dashboard"]
REFERRERS = ["google", "direct", "twitter", "newsletter", ""]
ELEMENTS = ["btn-cta", "nav-link", "card", "icon", "hero-banner"]
PRODUCTS = ["sku-001", "sku-042", "sku-105", "sku-203", "sku-317"]
PAYMENT_METHODS = ["card", "paypal", "crypto"]
METRIC_NAMES = ["cpu", "memory", "disk_io", "network"]
VIEWPORT_WIDTHS = [1280, 1440, 1920]
VIEWPORT_HEIGHTS = [720, 900, 1080]
USERS, HOSTS, SENSOR_ROWS, SENSORS_PER_ROW = 200, 8, 4, 5

SLOTS = 8  # 16-bit picks in one MD5


def rolls(digest: Column) -> list[Column]:
    """The eight 16-bit numbers in an MD5 digest."""
    return [F.conv(F.substring(digest, 4 * slot + 1, 4), 16, 10).cast("int") for slot in range(SLOTS)]


class Dice:
    """Picks made from ``rolls``. Where there are many picks, pass the rolls as columns."""

    def __init__(self, rolled: list[Column]) -> None:
        self._rolled = rolled

    def roll(self, slot: int) -> Column:
        """A whole number in 0..65535."""
        return self._rolled[slot]

    def unit(self, slot: int) -> Column:
        """A number strictly between 0 and 1."""
        return (self.roll(slot) + F.lit(0.5)) / F.lit(65536.0)

    def whole(self, slot: int, low: int, high: int) -> Column:
        return (F.lit(low) + F.floor(self.unit(slot) * (high - low + 1))).cast("int")

    def pick(self, slot: int, values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.pmod(self.roll(slot), F.lit(len(values))) + 1)

    def normal(self, slot: int, mean: float, deviation: float) -> Column:
        """Box-Muller on two slots."""
        radius = F.sqrt(F.log(self.unit(slot)) * -2)
        return radius * F.cos(self.unit(slot + 1) * (2 * math.pi)) * deviation + mean


def _numbered(prefix: str, number: Column, width: int, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"), F.lit(suffix))


def _sensor(d: Dice) -> Column:
    row = F.char(F.lit(65) + d.whole(0, 0, SENSOR_ROWS - 1))
    return F.concat(F.lit("sensor-"), row, F.lpad(d.whole(1, 1, SENSORS_PER_ROW).cast("string"), 2, "0"))


def _user(d: Dice) -> Column:
    return _numbered("user_", d.whole(0, 1, USERS), 4)


def _host(d: Dice) -> Column:
    return _numbered("node-", d.whole(0, 1, HOSTS), 2, ".prod")


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


# type -> (partition key, payload); add an entry to add a type
FACTORIES = {
    "PageView": lambda d, token: (
        _user(d),
        _struct(
            user_id=_user(d), page=d.pick(1, PAGES), referrer=d.pick(2, REFERRERS),
            session_id=F.substring(token, 1, 8), duration_ms=d.whole(3, 200, 45_000),
            viewport=_struct(w=d.pick(4, VIEWPORT_WIDTHS), h=d.pick(5, VIEWPORT_HEIGHTS)),
        ),
    ),
    "Click": lambda d, token: (
        _user(d),
        _struct(
            user_id=_user(d), element=d.pick(1, ELEMENTS), x=d.whole(2, 0, 1920), y=d.whole(3, 0, 1080),
            page=d.pick(4, PAGES),
        ),
    ),
    "Purchase": lambda d, token: (_user(d), _purchase(d, token)),
    "Heartbeat": lambda d, token: (
        _host(d), _struct(host=_host(d), status=F.lit("ok"), uptime_s=d.whole(1, 3600, 86_400 * 30))
    ),
    "MetricSample": lambda d, token: (
        _host(d),
        _struct(
            host=_host(d), cpu_pct=F.round(d.normal(1, 35, 20), 1), mem_mb=d.whole(3, 512, 8192),
            disk_io_kbps=d.whole(4, 0, 5000), net_rx_kbps=d.whole(5, 0, 10_000),
            net_tx_kbps=d.whole(6, 0, 10_000), metric_name=d.pick(7, METRIC_NAMES),
        ),
    ),
    "SensorReading": lambda d, token: (
        _sensor(d),
        _struct(
            sensor_id=_sensor(d), temperature_c=F.round(d.normal(2, 22, 5), 2),
            humidity_pct=F.round(d.unit(4) * 50 + 30, 1), pressure_hpa=F.round(d.normal(5, 1013, 5), 1),
            battery_pct=d.whole(7, 10, 100),
        ),
    ),
}


def _purchase(d: Dice, token: Column) -> Column:
    quantity = d.whole(1, 1, 5)
    # prices in whole cents, so the total is exact
    cents = d.whole(2, 999, 29_999)
    return _struct(
        user_id=_user(d), order_id=F.concat(F.lit("ord-"), F.substring(token, 9, 10)),
        product_id=d.pick(3, PRODUCTS), quantity=quantity, unit_price_usd=cents / 100.0,
        total_usd=cents * quantity / 100.0, currency=F.lit("USD"), payment_method=d.pick(4, PAYMENT_METHODS),
    )


def with_synthetic(rows: DataFrame, seed: str, types=None) -> DataFrame:
    """``rows`` (with ``event_type`` and a ``seed`` column) plus ``partition_key`` and ``payload``."""
    seeded = rows.select(
        "*", F.md5(F.concat(F.col(seed), F.lit(":payload"))).alias("_digest"),
        F.md5(F.concat(F.col(seed), F.lit(":token"))).alias("_token"),
    )
    rolled = seeded.select("*", *[r.alias(f"_roll{i}") for i, r in enumerate(rolls(F.col("_digest")))])
    dice, token = Dice([F.col(f"_roll{i}") for i in range(SLOTS)]), F.col("_token")
    key = F.lit(None).cast("string")
    payload = F.lit(None).cast("string")
    for name in types or FACTORIES:
        made_key, made = FACTORIES[name](dice, token)
        key = F.when(F.col("event_type") == name, made_key).otherwise(key)
        payload = F.when(F.col("event_type") == name, F.to_json(made)).otherwise(payload)
    return rolled.select(*rows.columns, key.alias("partition_key"), payload.alias("payload"))


def parse_payload(env: DataFrame, event_type: str, schema: str | None = None) -> DataFrame:
    """Events of one type with ``data``, the payload as a struct (null if it is not valid JSON)."""
    ddl = schema or PAYLOADS[event_type]
    rows = env.where(F.col("event_type") == event_type)
    return rows.withColumn("data", F.from_json("payload", ddl))
