"""The four anomaly detectors: rates, silences, repeated ids, missing sequence numbers.

All give ``kind, severity, start_us, end_us, description, details``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.functions.rounding import fixed, rounded
from eventrill.functions.times import micros, seconds
from eventrill.operators.aggregates import gaps_of
from eventrill.operators.order import OrderedScan
from eventrill.operators.windows import non_empty, with_throughput
from eventrill.schema import ANOMALY
from eventrill.session import broadcast_if_small, written

COLUMNS = ANOMALY.fieldNames()


def _details(**values: Column) -> Column:
    pairs: list[Column] = []
    for name, value in values.items():
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def window_rates(windows: DataFrame, compat: bool = False) -> DataFrame:
    """Windows with events, their ``eps``, ``mean_eps``, ``std_eps``, ``z_score`` and ``rates``.

    ``compat`` attributes the k-th rate to the k-th of *all* windows, empty ones
    included, and loses the windows beyond; otherwise a rate stays with its window.
    """
    windows = written(windows.select("start_us", "end_us", "count"), "windows")  # read twice; a row per window
    rated = with_throughput(non_empty(windows))
    stats = rated.agg(
        F.struct(
            F.count("eps").alias("rates"), F.avg("eps").alias("mean_eps"), F.stddev_pop("eps").alias("std_eps")
        )
    ).scalar()
    if compat:
        every = OrderedScan(windows.select("start_us", "end_us"), [], ["start_us"]).rank("_k").result()
        nth = OrderedScan(rated.select("start_us", "count", "eps"), [], ["start_us"]).rank("_k").result()
        rated = every.join(nth.drop("start_us"), "_k").drop("_k")
    rated = rated.withColumn("_stats", stats)
    rated = rated.select("*", "_stats.rates", "_stats.mean_eps", "_stats.std_eps").drop("_stats")
    z = F.abs(F.col("eps") - F.col("mean_eps")) / F.col("std_eps")
    usable = (F.col("rates") >= 3) & (F.col("std_eps") >= 0.001)
    return rated.withColumn("z_score", F.when(usable, z))


def rate_anomalies(windows: DataFrame, spike_threshold: float = 3.0, compat: bool = False) -> DataFrame:
    """Windows whose rate is more than ``spike_threshold`` standard deviations off the mean."""
    eps, mean, z = F.col("eps"), F.col("mean_eps"), F.col("z_score")
    return (
        window_rates(windows, compat)
        .where(z > spike_threshold)
        .select(
            F.when(eps > mean, "rate_spike").otherwise("rate_gap").alias("kind"),
            F.when(z > spike_threshold * 2, "high").otherwise("medium").alias("severity"),
            "start_us",
            "end_us",
            # fixed values: the texts of the reports, here and below
            F.format_string(
                "Rate %s eps deviates %sσ from mean %s eps", fixed(eps, 1), fixed(z, 1), fixed(mean, 1)
            ).alias("description"),
            _details(
                rate_eps=rounded(eps, 2), mean_eps=rounded(mean, 2), z_score=rounded(z, 2)
            ).alias("details"),
        )
    )


def time_gaps(env: DataFrame, gap_s: float = 10.0, gaps: DataFrame | None = None, **scan_args) -> DataFrame:
    """Silences of more than ``gap_s`` between neighbours in time. ``gaps`` is ``gaps_of(env)``, if it is there already."""
    threshold = micros(gap_s)
    gap = seconds(F.col("gap_us"))
    return (
        (gaps_of(env, **scan_args) if gaps is None else gaps)
        .where(F.col("gap_us") > threshold)
        .select(
            F.lit("rate_gap").alias("kind"),
            F.when(F.col("gap_us") < threshold * 3, "medium").otherwise("high").alias("severity"),
            F.col("prev_us").alias("start_us"),
            F.col("ts_us").alias("end_us"),
            F.format_string("Event gap of %ss between events", fixed(gap, 1)).alias("description"),
            _details(gap_s=rounded(gap, 2), prev_event=F.col("prev_event")).alias("details"),
        )
    )


def with_sighting(env: DataFrame, order: tuple[str, ...] = ("ts_us", "ordinal"), **scan_args) -> DataFrame:
    """Each event with ``sighting`` = 1 for the first of its id in ``order``, 2 for the next, …"""
    return OrderedScan(env, ["event_id"], order, **scan_args).rank("sighting").result()


def duplicates(env: DataFrame, **scan_args) -> DataFrame:
    """One report per repeated sighting of an event id, in time order.

    Ids that occur once are most of them and are left out before anything is ordered: of the
    whole table only ids are counted, and only rows of repeated ids are ranked.
    """
    narrow = env.select("event_id", "event_type", "ts_us", "ordinal")
    repeated = narrow.groupBy(F.col("event_id").alias("_id")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    repeated = broadcast_if_small(written(repeated.select("_id"), "repeated"))
    again = written(narrow.join(repeated, F.col("event_id").eqNullSafe(F.col("_id")), "left_semi"), "repeated")
    rows = with_sighting(again, **scan_args)
    return rows.where(F.col("sighting") > 1).select(
        F.lit("duplicate").alias("kind"),
        F.lit("high").alias("severity"),
        F.col("ts_us").alias("start_us"),
        F.col("ts_us").alias("end_us"),
        F.concat(F.lit("Duplicate event_id detected: "), "event_id").alias("description"),
        _details(event_id=F.col("event_id"), event_type=F.col("event_type")).alias("details"),
    )


def sequence_steps(env: DataFrame, **scan_args) -> DataFrame:
    """Per producer in sequence order: the previous sequence number and time of each event."""
    rows = env.select("producer_id", "sequence_number", "ts_us", "ordinal")
    scan = OrderedScan(rows, ["producer_id"], ["sequence_number", "ts_us", "ordinal"], **scan_args)
    return scan.lag(from_seq="sequence_number", from_us="ts_us").result()


def sequence_gaps(env: DataFrame, **scan_args) -> DataFrame:
    """Jumps of more than one in a producer's sequence numbers."""
    missing = F.col("sequence_number") - F.col("from_seq") - 1
    return (
        sequence_steps(env, **scan_args)
        .where(missing > 0)
        .select(
            F.lit("sequence_gap").alias("kind"),
            F.lit("medium").alias("severity"),
            F.col("from_us").alias("start_us"),
            F.col("ts_us").alias("end_us"),
            F.concat(
                F.lit("Sequence gap of "), missing.cast("string"), F.lit(" in producer "), "producer_id"
            ).alias("description"),
            _details(
                producer_id=F.col("producer_id"), from_seq=F.col("from_seq"),
                to_seq=F.col("sequence_number"), gap=missing,
            ).alias("details"),
        )
    )


def detect_anomalies(
    env: DataFrame,
    windows: DataFrame,
    spike_threshold: float = 3.0,
    gap_s: float = 10.0,
    compat: bool = False,
    gaps: DataFrame | None = None,
) -> DataFrame:
    """All four detectors' reports, with ``detector`` naming the one that made each."""
    parts = {
        "rate": rate_anomalies(windows, spike_threshold, compat),
        "gap": time_gaps(env, gap_s, gaps),
        "duplicate": duplicates(env),
        "sequence": sequence_gaps(env),
    }
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("detector"), *COLUMNS)
        out = part if out is None else out.unionByName(part)
    return out


def first_anomalies(anomalies: DataFrame, n: int = 50) -> DataFrame:
    """The head of a report: detectors in the order they run, then by time."""
    place = F.array_position(F.array(*map(F.lit, ("rate", "gap", "duplicate", "sequence"))), F.col("detector"))
    return anomalies.orderBy(place, "start_us", "end_us", "description").limit(n)
