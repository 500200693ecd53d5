import pytest
from pyspark.sql import functions as F

from tests.conftest import T0_US
from eventrill.operators import aggregates, windows


def pairs(df):
    return sorted((r["start_us"], r["end_us"], r["count"]) for r in df.collect())


def brute(starts, size, times):
    return [(s, s + size, sum(s <= t < s + size for t in times)) for s in starts]


def test_tumbling_covers_all_events(make_env, steady):
    out = pairs(windows.tumbling(make_env(steady(100, 10)), 1))
    assert 10 <= len(out) <= 12
    assert sum(c for *_, c in out) == 100
    assert all(a[1] == b[0] for a, b in zip(out, out[1:]))


def test_tumbling_emits_empty_windows(make_env):
    out = pairs(windows.tumbling(make_env([{"at": 0}, {"at": 5.5}]), 1))
    assert [c for *_, c in out] == [1, 0, 0, 0, 0, 1]


def test_half_second_windows_do_not_drift(make_env, steady):
    out = pairs(windows.tumbling(make_env(steady(1000, 10)), 0.5))
    assert {c for *_, c in out} == {5}


@pytest.mark.parametrize("size,slide", [(2, 1), (3, 2), (1, 3), (2.5, 0.7), (1, 1)])
def test_sliding_is_anchored_at_the_first_event(make_env, size, slide):
    at = [0.3, 0.35, 1.0, 1.1, 2.2999, 4.3, 7.77, 7.78]
    times = [T0_US + round(a * 1_000_000) for a in at]
    out = pairs(windows.sliding(make_env([{"at": a} for a in at]), size, slide))
    step = round(slide * 1_000_000)
    starts = range(times[0], times[-1] + 1, step)
    assert out == brute(starts, round(size * 1_000_000), times)


def test_two_sessions(make_env, steady):
    env = make_env(steady(10, 10) + steady(10, 10, 10.1))
    assert [c for *_, c in pairs(windows.sessions(env, 5))] == [10, 10]


def test_gap_equal_to_the_threshold_stays_in_the_session(make_env):
    env = make_env([{"at": 0}, {"at": 5}, {"at": 10.000001}])
    assert pairs(windows.sessions(env, 5)) == [
        (T0_US, T0_US + 5_000_000, 2), (T0_US + 10_000_001, T0_US + 10_000_001, 1)
    ]


@pytest.mark.parametrize("rows_per_piece", [3, 10**6])
def test_sessions_by_key_with_a_cut_key(make_env, rows_per_piece):
    events = [{"at": i * (1 + (i % 7 == 0) * 3), "producer_id": "hot"} for i in range(40)]
    events += [{"at": 1, "producer_id": "cold"}, {"at": 50, "producer_id": "cold"}]
    out = windows.sessions(make_env(events), 2, ["producer_id"], rows_per_piece=rows_per_piece)
    got = sorted((r["producer_id"], r["start_us"], r["end_us"], r["count"]) for r in out.collect())
    want = []
    for key in ("cold", "hot"):
        times = sorted(T0_US + e["at"] * 1_000_000 for e in events if e["producer_id"] == key)
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] > 2_000_000:
                want.append((key, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        want.append((key, run[0], run[-1], len(run)))
    assert got == sorted(want)


def test_single_event_session_counts_a_millisecond(make_env):
    out = windows.throughput_series(windows.sessions(make_env([{"at": 0}]), 5)).first()
    assert out["eps"] == 1000.0


def test_throughput(make_env, steady):
    out = windows.throughput_series(windows.tumbling(make_env(steady(20, 10)), 2)).collect()
    assert sum(r["count"] for r in out) == 20
    assert all(r["eps"] == r["count"] / 2 for r in out)


def test_distributions_add_up(make_env, steady):
    env = make_env(steady(60, 10))
    for kind in windows.WINDOW_TYPES:
        total = windows.type_distribution(env, window_type=kind, size_s=2, slide_s=2, gap_s=1).agg(F.sum("count"))
        assert total.first()[0] == 60
    parts = windows.partition_distribution(env, size_s=100).collect()
    assert sorted(r["count"] for r in parts) == [15, 15, 15, 15]


def test_empty_input(make_env):
    env = make_env([])
    for kind in windows.WINDOW_TYPES:
        assert windows.windows_of(env, kind).count() == 0
    assert aggregates.stream_summary(env).count() == 0
    assert aggregates.gap_stats(env).count() == 0


def test_bad_arguments(make_env):
    env = make_env([{"at": 0}, {"at": 10**6}])
    with pytest.raises(ValueError, match="unknown window type"):
        windows.windows_of(env, "hopping")
    with pytest.raises(ValueError, match="at least one microsecond"):
        windows.tumbling(env, 0)


def test_top_types_tie_by_first_appearance(make_env):
    env = make_env([{"at": i, "event_type": t} for i, t in enumerate("ZAAZB")])
    top = [(r["event_type"], r["count"]) for r in aggregates.top_event_types(env, 3).collect()]
    assert top == [("Z", 2), ("A", 2), ("B", 1)]


def test_summary_and_gaps_of_500_events(make_env):
    env = make_env([{"at": i / 10, "event_type": str(i % 6)} for i in range(500)])
    assert aggregates.stream_summary(env).first()["duration_s"] == pytest.approx(49.9)
    assert {r["count"] for r in aggregates.count_by_partition(env).collect()} == {125}
    gaps = aggregates.gap_stats(env).first()
    assert (gaps["min_ms"], gaps["max_ms"], gaps["mean_ms"]) == (100, 100, 100)
    assert aggregates.gap_stats(make_env([{"at": 1}])).count() == 0


def test_one_event_of_each_type(make_env):
    kinds = ["PageView", "Click", "Purchase", "Heartbeat", "MetricSample", "SensorReading"]
    env = make_env([{"at": i, "event_type": t} for i, t in enumerate(kinds)])
    assert {r["event_type"]: r["count"] for r in aggregates.count_by_type(env).collect()} == dict.fromkeys(kinds, 1)
    assert [r["count"] for r in aggregates.count_by_partition(env).orderBy("partition").collect()] == [2, 2, 1, 1]
    assert [r["ordinal"] for r in aggregates.ordered(env).collect()] == list(range(6))


def test_ordered(make_env):
    env = make_env([{"at": a} for a in (5, 1, 3, 2, 4)])
    assert [r["ordinal"] for r in aggregates.ordered(env).collect()] == [1, 3, 2, 4, 0]
