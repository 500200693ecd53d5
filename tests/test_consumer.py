import pytest
from pyspark.sql import functions as F

from eventrill.operators import consumer


@pytest.fixture
def latencies(spark):
    def make(ms):
        rows = [(0, int(v * 1000), i) for i, v in enumerate(ms)]
        return spark.createDataFrame(rows, "ts_us long, received_at_us long, ordinal long")

    return make


def test_filter_counts(make_env):
    env = make_env([{"event_type": t} for t in ("PageView", "Click", "Purchase", "PageView")])
    env = env.withColumn("received_at_us", F.col("ts_us"))
    totals = consumer.consumer_totals(consumer.consume(env, types=["PageView"])).first()
    assert (totals["received"], totals["processed"], totals["filtered_out"]) == (4, 2, 2)


def test_empty_sets_do_not_filter(make_env):
    env = make_env([{}, {}])
    assert consumer.filter_events(env, types=[], partitions=set()).count() == 2
    assert consumer.filter_events(env, partitions={1}).count() == 1
    assert consumer.filter_events(env, predicate=F.col("ordinal") > 5).count() == 0


def test_the_same_event_twice(make_env):
    env = make_env([{"event_id": "a"}, {"event_id": "a"}]).withColumn("received_at_us", F.col("ts_us"))
    with_group = consumer.consumer_totals(consumer.consume(env)).first()
    assert (with_group["processed"], with_group["filtered_out"]) == (1, 1)
    without = consumer.consumer_totals(consumer.consume(env, dedup=False)).first()
    assert without["processed"] == 2


def test_filtered_events_are_not_remembered(make_env):
    env = make_env([{"event_id": "a", "event_type": "Click"}, {"event_id": "a", "event_type": "View"}])
    done = consumer.consume(env, types=["View"]).where("processed").collect()
    assert [r["ordinal"] for r in done] == [1]


@pytest.mark.parametrize("rows_per_piece", [3, 10**6])
def test_dedup_keeps_the_first_arrival_of_a_hot_id(make_env, rows_per_piece):
    env = make_env([{"event_id": "hot" if i % 2 else f"e{i}", "at": -i, "ordinal": i} for i in range(30)])
    kept = consumer.dedup_first(env, rows_per_piece=rows_per_piece).collect()
    assert sorted(r["ordinal"] for r in kept) == [0, 1] + list(range(2, 30, 2))


def test_drop_processed(spark, make_env):
    done = spark.createDataFrame([("a",)], "event_id string")
    assert consumer.drop_processed(make_env([{"event_id": "a"}, {"event_id": "b"}]), done).count() == 1


def test_floor_rank_percentiles(latencies):
    row = consumer.latency_percentiles(latencies(range(1, 101))).first()
    assert (row["p50_ms"], row["p95_ms"], row["p99_ms"], row["samples"]) == (51, 96, 100, 100)
    assert consumer.latency_percentiles(latencies([5, -3])).first()["p99_ms"] == 5
    none = consumer.latency_percentiles(latencies([-1])).first()
    assert (none["samples"], none["p50_ms"]) == (0, 0)


def test_offsets_of_silent_and_new_partitions(make_env):
    env = make_env([{"partition": 7, "sequence_number": 10}])
    rows = {r["partition"]: r["pending"] for r in consumer.partition_offsets(env, 2).collect()}
    assert rows == {0: -1, 1: -1, 7: 10}


def test_nothing_committed_before_a_full_interval(make_env):
    row = consumer.commit_offsets(make_env([{"partition": 0, "sequence_number": 10}]), 1).first()
    assert (row["pending"], row["committed"], row["lag"]) == (10, -1, 11)


def test_commit_after_every_interval(make_env):
    env = make_env([{"partition": p, "sequence_number": 10 + p} for p in range(4)])
    rows = consumer.commit_offsets(env, 4, interval=4).orderBy("partition").collect()
    assert [(r["pending"], r["committed"], r["lag"]) for r in rows] == [(10 + p, 10 + p, 0) for p in range(4)]
    rows = consumer.commit_offsets(env, 4, interval=3).orderBy("partition").collect()
    assert [r["committed"] for r in rows] == [10, 11, 12, -1]


def test_take_accepted(make_env):
    env = make_env([{"ordinal": i} for i in (30, 10, 20, 40)])
    assert sorted(r["ordinal"] for r in consumer.take_accepted(env, 2).collect()) == [10, 20]
    assert consumer.take_accepted(env, 9).count() == 4 and consumer.take_accepted(env, 0).count() == 0


def test_stats(make_env):
    env = make_env([{"event_type": "A", "partition": 1}, {"event_type": "B", "partition": 1}])
    env = env.withColumn("received_at_us", F.col("ts_us") + 2000)
    stats = {(r["metric"], r["key"]): r["value"] for r in consumer.consumer_stats(consumer.consume(env)).collect()}
    assert stats[("by_type", "A")] == 1 and stats[("by_partition", "1")] == 2
    assert stats[("p50_ms", "")] == 2.0 and stats[("received", "")] == 2


def test_latency_over_a_replay_is_stable(spark, write_lines):
    from eventrill.sources import eventlog

    lines = [{"event_id": str(i), "event_type": "Click", "timestamp": 1_700_000_000 + i / 1000} for i in range(2_000)]
    events, rejects = eventlog.replay_event_log(spark, write_lines([*lines, "broken"]))
    row = consumer.latency_percentiles(events).first()
    received = events.agg(F.min("received_at_us"), F.max("received_at_us")).first()
    assert received[0] == received[1] and rejects.count() == 1
    latencies = sorted((received[0] - 1_700_000_000_000_000 - i * 1000) / 1e3 for i in range(2_000))
    assert tuple(row) == (2_000, latencies[1000], latencies[1900], latencies[1980])
    assert consumer.consumer_totals(consumer.consume(events)).first()["eps"] == 0.0
