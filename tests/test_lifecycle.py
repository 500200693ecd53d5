import pytest
from pyspark.sql import functions as F

from eventrill.operators import lifecycle as lc

ATTEMPT = "message_id string, consumer_id string, topic string, partition int, attempt int, ok boolean, ts_us bigint"
S = 1_000_000


@pytest.fixture
def attempts(spark):
    def make(outcomes, consumer="c"):
        rows = [
            (m, consumer, "t", 0, i + 1, ok, (i + 1) * S) for m, oks in outcomes.items() for i, ok in enumerate(oks)
        ]
        return spark.createDataFrame(rows, ATTEMPT)

    return make


@pytest.fixture
def produced(spark):
    def make(ids):
        rows = [(m, "p", "t", 0, 0) for m in ids]
        return spark.createDataFrame(rows, "message_id string, producer_id string, topic string, partition int, ts_us bigint")

    return make


OUTCOMES = {"a": [True], "b": [False, True], "c": [False, False], "d": [False] * 3, "e": [False, False, True]}


def test_routing(attempts):
    rows = {r["message_id"]: (r["status"], r["failures"], r["attempts"]) for r in lc.route_retries(attempts(OUTCOMES)).collect()}
    assert rows == {
        "a": ("consumed", 0, 1), "b": ("consumed", 1, 2), "c": ("pending", 2, 2), "d": ("dlq", 3, 3), "e": ("consumed", 2, 3)
    }


def test_attempts_beyond_the_budget_do_not_count(attempts):
    row = lc.route_retries(attempts({"m": [False, False, False, True]})).first()
    assert row["status"] == "dlq"


def test_retries_of_a_crashed_consumer_wait(spark, attempts):
    crashed = spark.createDataFrame([("c",)], "consumer_id string")
    row = lc.route_retries(attempts({"m": [False, True]}), crashed=crashed).first()
    assert (row["status"], row["failures"]) == ("pending", 1)


def test_log_and_counters(attempts, produced):
    log = lc.lifecycle_log(produced(OUTCOMES), attempts(OUTCOMES))
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds == {"produced": 5, "consumed": 3, "retry": 8, "dlq": 1}
    counters = lc.lifecycle_counters(log).first().asDict()
    assert counters == {"produced": 5, "consumed": 3, "failed": 4, "dlq": 1}


def test_depths(attempts, produced):
    log = lc.lifecycle_log(produced(OUTCOMES), attempts(OUTCOMES))
    rows = lc.depth_series(lc.rollup(log)).orderBy("start_us").collect()
    assert [(r["queue_depth"], r["retry_depth"], r["dlq_depth"]) for r in rows] == [
        (5, 0, 0), (0, 4, 0), (0, 3, 0), (0, 2, 0), (0, 1, 1)
    ]


def test_series_and_snapshots(spark, attempts, produced):
    rolled = lc.rollup(lc.lifecycle_log(produced(OUTCOMES), attempts(OUTCOMES)))
    assert lc.produced_per_second(rolled).first()["count"] == 5
    offsets = lc.consumer_offsets_series(rolled).orderBy("start_us").collect()
    assert [r["consumer_offset"] for r in offsets] == [1, 2, 3]
    assigned = spark.createDataFrame([("t", 0, "c")], "topic string, partition int, member_id string")
    lags = lc.consumer_lag_series(rolled, assigned).orderBy("start_us").collect()
    assert [r["lag"] for r in lags] == [5, 0]
    series = lc.metrics_snapshots(rolled, assigned)
    assert series.where("metric = 'dlq_depth'").agg(F.max("value")).first()[0] == 1
    last = lc.recent_snapshots(series, 2)
    assert sorted({r["t_us"] for r in last.collect()}) == [4 * S, 5 * S]


def test_fan_out(spark, make_env):
    routes = spark.createDataFrame([("p", "t"), ("p", "u"), ("q", "t")], "producer_id string, topic string")
    env = make_env([{"producer_id": "p"}, {"producer_id": "q"}, {"producer_id": "r"}])
    assert sorted(r["topic"] for r in lc.fan_out(env, routes).collect()) == ["t", "t", "u"]


def test_last_values_are_carried_to_every_interval(spark, monkeypatch):
    monkeypatch.setattr(lc, "RUN_PIECE", 3)  # runs longer than a piece
    changes = spark.createDataFrame([("a", 2 * S, 5), ("a", 3 * S, 7), ("b", 0, 1), ("z", 11 * S, 4)], "k string, start_us bigint, v bigint")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "k string")
    rows = lc.carried_forward(changes, keys, "v", (0, 11 * S), rows_per_piece=2).orderBy("k", "start_us").collect()
    series = {}
    for i, r in enumerate(rows):
        assert r["start_us"] == i % 12 * S
        series.setdefault(r["k"], []).append(r["v"])
    assert series == {"a": [0, 0, 5] + [7] * 9, "b": [1] * 12, "c": [0] * 12, "z": [0] * 11 + [4]}
    assert lc.carried_forward(changes, keys.limit(0), "v", (0, S)).where("k <> 'a' AND k <> 'b' AND k <> 'z'").count() == 0


def test_every_consumer_is_in_every_snapshot(spark, attempts, produced):
    rolled = lc.rollup(lc.lifecycle_log(produced(OUTCOMES), attempts(OUTCOMES)))
    assigned = spark.createDataFrame([("t", 0, "c"), ("u", 0, "idle")], "topic string, partition int, member_id string")
    series = lc.metrics_snapshots(rolled, assigned)
    held = {}
    for r in series.where("metric IN ('consumer_offset', 'consumer_lag')").orderBy("t_us").collect():
        held.setdefault((r["metric"], r["id"]), []).append(r["value"])
    consumed = held.pop(("consumer_offset", "c"))
    assert consumed == [0, 1, 2, 3, 3]
    assert held == {("consumer_lag", "c"): [5, 0, 0, 0, 0], ("consumer_offset", "idle"): [0] * 5, ("consumer_lag", "idle"): [0] * 5}
    assert lc.metrics_snapshots(rolled.limit(0), assigned).count() == 0
