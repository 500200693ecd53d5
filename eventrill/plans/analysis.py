"""The full analysis of an event stream, as a bundle of DataFrames and as reports of JSON rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.operators.aggregates import (
    count_by_partition, count_by_producer, gap_stats, gaps_of, stream_summary, top_event_types,
)
from eventrill.operators.anomalies import detect_anomalies
from eventrill.functions.rates import Profile
from eventrill.functions.rounding import rounded
from eventrill.operators.load import (
    REPORT_EVERY_S, latency_summary, load_report, rate_conformance, throughput_points,
)
from eventrill.operators.windows import WINDOW_TYPES, throughput_series, windows_of
from eventrill.session import written


def analyze(
    env: DataFrame,
    window_type: str = "tumbling",
    window_size_s: float = 10.0,
    slide_s: float = 5.0,
    top_n: int = 5,
    spike_threshold: float = 3.0,
    gap_s: float = 10.0,
    compat: bool = False,
) -> dict[str, DataFrame]:
    """Windows, anomalies, distributions, throughput and gaps of ``env``. Empty frames on no events."""
    if window_type not in WINDOW_TYPES:
        raise ValueError(f"unknown window type {window_type!r}; choose one of {', '.join(WINDOW_TYPES)}")
    # each is read by several parts below, so it is made once
    windows = written(windows_of(env, window_type, window_size_s, slide_s, gap_s), "windows")
    gaps = written(gaps_of(env), "gaps")
    return {
        "windows": windows,
        "anomalies": detect_anomalies(env, windows, spike_threshold, gap_s, compat, gaps),
        "summary": stream_summary(env),
        "top_event_types": top_event_types(env, top_n),
        "partition_distribution": count_by_partition(env),
        "producer_distribution": count_by_producer(env),
        "throughput_series": throughput_series(windows),
        "gap_stats": gap_stats(env, gaps),
    }


def analysis_report(env: DataFrame, **options) -> DataFrame:
    """The analysis as JSON rows ``section, body``, one row per entry of each section.

    A section can have as many rows as there are windows or anomalies, so the report is
    a distributed table (see ``write_report``), not one document.
    """
    parts = analyze(env, **options)
    windows = parts["windows"]
    anomalies = written(parts["anomalies"], "anomalies")  # counted and listed
    size = float(options.get("window_size_s", 10.0))
    kind = options.get("window_type", "tumbling")

    def sec(us: str) -> Column:
        return rounded(F.col(us) / 1e6, 2)

    summary = parts["summary"].select(
        "total_events",
        rounded(F.col("duration_s"), 2).alias("duration_s"),
        rounded(F.col("overall_eps"), 2).alias("overall_throughput_eps"),
        F.lit(windows.count()).alias("num_windows"),
        F.lit(anomalies.count()).alias("num_anomalies"),
        F.lit(kind).alias("window_type"),
        F.lit(size).alias("window_size_s"),
    )
    sections = {
        "summary": summary,
        "top_event_types": parts["top_event_types"].select(F.col("event_type").alias("type"), "count"),
        "partition_distribution": parts["partition_distribution"],
        "producer_distribution": parts["producer_distribution"],
        "throughput_series": throughput_series(windows).select(
            sec("t_us").alias("t"), rounded(F.col("eps"), 2).alias("eps"), "count"
        ),
        "gap_stats": parts["gap_stats"].select(*[rounded(F.col(c), 2).alias(c) for c in ("min_ms", "max_ms", "mean_ms")]),
        "anomalies": anomalies.select(
            "kind", "severity", "description",
            sec("start_us").alias("window_start"), sec("end_us").alias("window_end"), "details",
        ),
    }
    return _json_rows(sections)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder of JSON lines per section."""
    report.select("section", F.col("body").alias("value")).write.mode(mode).partitionBy("section").text(path)


def load_run_report(
    events: DataFrame, profiles: dict[str, Profile], latency_ms: str, every_s: float = REPORT_EVERY_S
) -> DataFrame:
    """Load runs as JSON rows ``section, body``: totals, one row per pattern, the rates over time."""
    runs = written(rate_conformance(events, profiles), "runs")  # one row per pattern
    latency = latency_summary(events, latency_ms, ["pattern"])
    summaries = latency.select(F.col("pattern").alias("_pattern"), F.struct(*latency.columns[1:]).alias("latency"))
    patterns = runs.join(summaries, F.col("pattern").eqNullSafe(F.col("_pattern")), "left").drop("_pattern")
    return _json_rows(
        {
            "totals": load_report(runs),
            "patterns": patterns,
            "throughput_series": throughput_points(events, every_s),
        }
    )


def _json_rows(sections: dict[str, DataFrame]) -> DataFrame:
    rows = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("body")) for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, rows)
