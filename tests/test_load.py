import math

import pytest
from pyspark.sql import functions as F

from eventrill.functions import rates
from eventrill.operators import load


@pytest.fixture
def rate_at(spark):
    def at(kind, times, **params):
        df = spark.createDataFrame([(float(t),) for t in times], "t double")
        out = df.select("t", rates.load_profile(kind, F.col("t"), **params).alias("r")).collect()
        found = {r["t"]: r["r"] for r in out}
        return [found[float(t)] for t in times]

    return at


def test_profiles(rate_at):
    assert rate_at("steady", [0, 9], rate=50) == [50, 50]
    assert rate_at("burst", [0, 1.9, 2, 11.9, 12], baseline_rate=5, burst_rate=50) == [50, 50, 5, 5, 50]
    assert rate_at("ramp_up", [0, 5, 10, 20], start_rate=10, end_rate=20, duration_s=10) == [10, 15, 20, 20]
    assert rate_at("ramp_down", [0, 5, 10], start_rate=20, end_rate=10, duration_s=10) == [20, 15, 10]
    assert rate_at("spike", [3.9, 4, 6.9, 7], baseline_rate=5, spike_rate=99, duration_s=10) == [5, 99, 99, 5]
    assert rate_at("sinusoidal", [0, 5, 15], min_rate=10, max_rate=20, period_s=20) == pytest.approx([15, 20, 10])


def test_lowest_rate_and_unknown_profile(rate_at):
    assert rate_at("steady", [0], rate=0) == [0.1]
    with pytest.raises(ValueError, match="unknown profile"):
        rate_at("square", [0])


def test_mean_rate(spark):
    mean = rates.mean_rate(rates.ramp_up(0, 100, F.lit(10.0)), F.lit(10.0))
    assert spark.range(1).select(mean).first()[0] == pytest.approx(50, rel=1e-3)


@pytest.fixture
def samples(spark):
    return lambda values: spark.createDataFrame([("p", float(v)) for v in values], "pattern string, ms double")


def test_interpolated_percentiles(samples):
    row = load.latency_summary(samples(range(1, 101)), "ms").first()
    assert (row["p50_ms"], row["p95_ms"], row["p99_ms"]) == pytest.approx((50.5, 95.05, 99.01))
    assert (row["samples"], row["mean_ms"], row["min_ms"], row["max_ms"]) == (100, 50.5, 1, 100)


def test_few_samples(samples):
    none = load.latency_summary(samples([]), "ms").first()
    assert all(none[c] == 0 for c in none.asDict())
    assert load.latency_summary(samples([5]), "ms").first()["p999_ms"] == 5
    assert load.latency_summary(samples([1, 2, 3, 4, 5]), "ms").first()["p50_ms"] == 3
    assert load.latency_summary(samples([2, 4, 6]), "ms").first()["mean_ms"] == 4


@pytest.mark.parametrize("rows_per_piece", [9, 10**6])
def test_grouped_summary_equals_the_global_one(samples, rows_per_piece):
    df = samples([math.sin(i) * 50 for i in range(200)] + [3.0] * 40)
    one = load.latency_summary(df, "ms").first().asDict()
    by = load.latency_summary(df, "ms", ["pattern"], rows_per_piece=rows_per_piece).first().asDict()
    assert by.pop("pattern") == "p"
    assert by == pytest.approx(one)


def test_conformance(spark):
    events = spark.createDataFrame([("a", i * 10_000) for i in range(96)], "pattern string, ts_us long")
    row = load.rate_conformance(events, {"a": rates.steady(100)}).first()
    assert row["actual_eps"] == pytest.approx(96 / 0.95) and row["conformance_pct"] == pytest.approx(101.05, abs=0.01)
    assert load.load_report(load.rate_conformance(events, {"a": rates.steady(0)})).first()["total_events"] == 96
    assert load.load_report(load.rate_conformance(events, {})).first()["total_events"] == 0


def test_arrivals_follow_the_profile(spark):
    events = load.synth_load(spark, "ramp", rates.ramp_up(0, 10, 10.0), 10, payload_size=100)
    rows = events.orderBy("sequence").collect()
    # 0.1 (the lowest rate) and then 1, 2, ... 9 events per second
    assert [r["sequence"] for r in rows] == list(range(1, 46))
    assert [r["ts_us"] for r in rows] == sorted(r["ts_us"] for r in rows)
    assert len(rows[0]["payload"]["data"]) == 20 and 0 <= rows[0]["payload"]["rand"] < 1
    assert len({r["event_id"] for r in rows}) == 45
    slow = load.synth_load(spark, "slow", rates.steady(0.4), 10)
    assert slow.count() == 4


def test_throughput_points(spark):
    rows = [("a", 100 + i * 500_000) for i in range(10)]
    points = load.throughput_points(spark.createDataFrame(rows, "pattern string, ts_us long"), 2).orderBy("t_us")
    assert [(r["t_us"], r["eps"], r["total"]) for r in points.collect()] == [
        (2_000_000, 2.0, 4), (4_000_000, 2.0, 8), (6_000_000, 1.0, 10)
    ]


def test_report_rows(spark, tmp_path):
    import json

    from eventrill.plans.analysis import load_run_report, write_report

    events = spark.createDataFrame([("a", i * 500_000, float(i)) for i in range(11)], "pattern string, ts_us long, ms double")
    report = load_run_report(events, {"a": rates.steady(2)}, "ms")
    rows = {(r["section"], i): json.loads(r["body"]) for i, r in enumerate(report.collect())}
    totals, pattern = (next(v for (s, _), v in rows.items() if s == n) for n in ("totals", "patterns"))
    assert totals == {"total_patterns": 1, "total_events": 11}
    assert pattern["latency"]["p50_ms"] == 5 and pattern["conformance_pct"] == pytest.approx(110)
    write_report(report, str(tmp_path / "report"))
    back = spark.read.text(str(tmp_path / "report")).where("section = 'throughput_series'")
    assert sorted(json.loads(r["value"])["total"] for r in back.collect()) == [4, 8, 11]


THIRTY_DAYS = 30 * 86_400


@pytest.mark.parametrize(
    "profile,duration,mean",
    [
        (rates.burst(50, 500, 2, 10), THIRTY_DAYS, 125.0),
        (rates.steady(0.01), 10, 0.1),
        (rates.ramp_up(0, 10, 100), 100, None),
        (rates.ramp_down(8, -3, 60), 90, None),
        (rates.ramp_up(-2, -1, 60), 90, 0.1),
        (rates.spike(1, 50, 100, 30), 55, None),
        (rates.sinusoidal(1, 5, 20), 33, None),
        (rates.sinusoidal(-3, 4, 20), 47, None),
        (rates.sinusoidal(-9, 0, 20), 47, 0.1),
        (rates.sinusoidal(4, -3, 20), 47, None),
    ],
)
def test_mean_rates_are_exact(spark, profile, duration, mean):
    got = spark.range(1).select(rates.mean_rate(profile, F.lit(float(duration)))).first()[0]
    if mean is None:
        n = 200_000
        at = (F.col("id") + 0.5) * (duration / n)
        mean = spark.range(n).select(F.avg(rates.floored(profile)(at))).first()[0]
    assert got == pytest.approx(mean, rel=1e-4)


def test_latency_summary_keeps_every_group(spark):
    rows = [("a", 1.0), ("a", 3.0), (None, 5.0), ("empty", None)]
    df = spark.createDataFrame(rows, "kind string, ms double")
    got = {r["kind"]: (r["samples"], r["p50_ms"]) for r in load.latency_summary(df, "ms", ["kind"]).collect()}
    assert got == {"a": (2, 2.0), None: (1, 5.0), "empty": (0, None)}
