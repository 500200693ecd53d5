import json

import pytest

from tests.conftest import T0_US
from eventrill.operators import anomalies, windows
from eventrill.plans.analysis import analysis_report, analyze


@pytest.fixture
def planted(make_env):
    """300 events: a pause of 15.1 s at 50, 50 numbers lost at 150, one id twice at 99 and 100."""
    events = []
    for i in range(300):
        events.append(
            {
                "event_id": "e99" if i == 100 else f"e{i}",
                "at": i / 10 + (15 if i >= 50 else 0),
                "sequence_number": i + (51 if i >= 150 else 1),
            }
        )
    return make_env(events)


def test_planted_anomalies(planted):
    found = anomalies.detect_anomalies(planted, windows.tumbling(planted, 5), 50, 10).collect()
    by = {r["detector"]: r for r in found}
    assert len(found) == 3
    assert by["gap"]["severity"] == "medium" and by["gap"]["details"]["gap_s"] == "15.1"
    assert by["gap"]["description"] == "Event gap of 15.1s between events"
    assert by["gap"]["details"]["prev_event"] == "e49"
    assert by["duplicate"]["details"]["event_id"] == "e99" and by["duplicate"]["severity"] == "high"
    assert by["duplicate"]["start_us"] == T0_US + 25_000_000
    assert by["sequence"]["details"] == {
        "producer_id": "test-producer", "from_seq": "150", "to_seq": "201", "gap": "50"
    }
    assert by["sequence"]["description"] == "Sequence gap of 50 in producer test-producer"


def test_steady_stream_has_none(make_env, steady):
    env = make_env(steady(100, 10))
    assert anomalies.detect_anomalies(env, windows.tumbling(env, 1), 5, 30).count() == 0


def test_rate_spike(make_env, steady):
    env = make_env(steady(200, 10) + steady(100, 100, 20))
    found = anomalies.rate_anomalies(windows.tumbling(env, 1), 2.0).collect()
    assert [r["kind"] for r in found] == ["rate_spike"]
    assert found[0]["description"].startswith("Rate 100.0 eps deviates")


def test_rates_need_three_windows_and_some_spread(make_env, steady):
    assert anomalies.rate_anomalies(windows.tumbling(make_env(steady(20, 10)), 1), 0.1).count() == 0
    assert anomalies.rate_anomalies(windows.tumbling(make_env(steady(50, 10)), 1), 0.0).count() == 0


def test_compat_shifts_rates_past_empty_windows(make_env, steady):
    env = make_env(steady(100, 10) + steady(50, 50, 20))
    one_second = windows.tumbling(env, 1)
    right = anomalies.rate_anomalies(one_second, 2.0).first()
    shifted = anomalies.rate_anomalies(one_second, 2.0, compat=True).first()
    assert right["start_us"] == T0_US + 20_000_000
    assert shifted["start_us"] == T0_US + 10_000_000


@pytest.mark.parametrize("gap,severity", [(10.0, None), (10.000001, "medium"), (29.9, "medium"), (30, "high")])
def test_gap_threshold_is_strict(make_env, gap, severity):
    found = anomalies.time_gaps(make_env([{"at": 0}, {"at": gap}]), 10).collect()
    assert [r["severity"] for r in found] == ([severity] if severity else [])


def test_long_gap_is_high(make_env, steady):
    env = make_env(steady(10, 10) + steady(10, 10, 31))
    found = anomalies.time_gaps(env, 5).collect()
    assert [(r["kind"], r["severity"]) for r in found] == [("rate_gap", "high")]


def test_each_repeat_is_reported(make_env):
    env = make_env([{"event_id": i, "at": t} for t, i in enumerate(["dup", "x", "dup", "dup"])])
    assert sorted(r["start_us"] - T0_US for r in anomalies.duplicates(env).collect()) == [2_000_000, 3_000_000]


@pytest.mark.parametrize("rows_per_piece", [2, 10**6])
def test_sequence_gap(make_env, rows_per_piece):
    env = make_env([{"at": i, "sequence_number": s} for i, s in enumerate((1, 10, 2))])
    found = anomalies.sequence_gaps(env, rows_per_piece=rows_per_piece).collect()
    assert [r["details"]["gap"] for r in found] == ["7"]


def test_first_anomalies_keep_detector_order(planted):
    found = anomalies.detect_anomalies(planted, windows.tumbling(planted, 5), 50, 10)
    assert [r["detector"] for r in anomalies.first_anomalies(found, 2).collect()] == ["gap", "duplicate"]


def test_analyze(planted):
    parts = analyze(planted, window_type="session", top_n=2)
    assert parts["windows"].count() == 2
    assert parts["top_event_types"].count() == 1
    assert parts["throughput_series"].count() == 2
    with pytest.raises(ValueError):
        analyze(planted, window_type="none")


def test_report(planted):
    rows = analysis_report(planted, window_size_s=5.0).collect()
    summary = json.loads(next(r["body"] for r in rows if r["section"] == "summary"))
    assert summary["total_events"] == 300 and summary["window_type"] == "tumbling"
    series = [json.loads(r["body"]) for r in rows if r["section"] == "throughput_series"]
    assert len(series) == summary["num_windows"] and sum(s["count"] for s in series) == 300
    assert sum(r["section"] == "anomalies" for r in rows) == summary["num_anomalies"]


def test_report_of_nothing(make_env):
    assert analysis_report(make_env([])).count() == 0
