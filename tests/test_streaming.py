import json
import os

import pytest
from pyspark.sql import functions as F

from eventrill.session import shared_dir
from eventrill.sources import eventlog
from eventrill.streaming import queries as streams
from eventrill.streaming.state import GapAlarms, OffsetCommits, RetryRouter


@pytest.fixture
def feed(tmp_path):
    """Writes numbered JSON-lines files into one directory."""
    folder = tmp_path / "feed"
    folder.mkdir()
    count = iter(range(1000))

    def write(events):
        lines = [json.dumps({"event_id": f"{e.get('timestamp')}", **e}) for e in events]
        n = next(count)
        file = folder / f"{n:04d}.jsonl"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))  # files are taken in this order
        return str(folder)

    return write


def seconds(*at, **more):
    return [{"timestamp": t, **more} for t in at]


def test_closed_windows_and_late_rows(spark, feed):
    feed(seconds(1, 2, 11, 12))
    path = feed(seconds(25))  # moves the watermark to 15
    feed(seconds(26))  # the next batch closes what lies before it
    feed(seconds(3))  # late by then
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "cp")

    def run():
        env = streams.with_watermark(eventlog.read_event_stream(spark, path, files_per_trigger=1), 10)
        return streams.run_to_table(streams.stream_tumbling(env, 10), "t", out, checkpoint)

    got = sorted((r["start_us"] // 10**6, r["count"]) for r in run().collect())
    assert got == [(0, 2)]
    feed(seconds(60))
    got = sorted((r["start_us"] // 10**6, r["count"]) for r in run().collect())
    assert got == [(0, 2), (10, 2), (20, 2)]


def test_sliding_and_sessions(spark, feed):
    path = feed(seconds(1, 2, 8, 14, producer_id="p") + seconds(100, producer_id="q"))
    env = streams.with_watermark(eventlog.read_event_stream(spark, path), 1)
    sliding = streams.run_to_table(streams.stream_sliding(env, 10, 5), "s")
    assert {r["start_us"] // 10**6: r["count"] for r in sliding.collect()} == {-5: 2, 0: 3, 5: 2, 10: 1}
    sessions = streams.run_to_table(streams.stream_sessions(env, 6, ["producer_id"]), "x")
    # a gap equal to the threshold stays in the session
    assert [(r["start_us"] // 10**6, r["end_us"] // 10**6, r["count"]) for r in sessions.collect()] == [(1, 14, 4)]
    whole = streams.run_to_table(streams.stream_sessions(env, 6), "y")
    assert [r["count"] for r in whole.collect()] == [4]
    with pytest.raises(ValueError):
        streams.stream_sliding(env, 5, 10)


def test_dedup_over_batches(spark, feed):
    feed(seconds(1, 2, event_id="a"))
    path = feed(seconds(3, event_id="a") + seconds(4, event_id="b"))
    env = streams.with_watermark(eventlog.read_event_stream(spark, path, 1), 60)
    assert sorted(r["event_id"] for r in streams.run_to_table(streams.stream_dedup(env), "d").collect()) == ["a", "b"]


def test_commits_survive_a_restart(spark, feed):
    checkpoint, commits = shared_dir(spark, "cp"), OffsetCommits(spark, shared_dir(spark, "commits"))
    path = feed([{"timestamp": 1, "partition": 0, "sequence_number": 5}])
    feed([{"timestamp": 2, "partition": 1, "sequence_number": 7}])
    streams.run_batches(eventlog.read_event_stream(spark, path, 1), commits, checkpoint)
    feed([{"timestamp": 3, "partition": 0, "sequence_number": 4}])
    streams.run_batches(eventlog.read_event_stream(spark, path, 1), commits, checkpoint)
    assert {r["partition"]: r["committed"] for r in commits.table.latest().collect()} == {0: 5, 1: 7}
    pending = spark.createDataFrame([(0, 9), (2, 3)], "partition int, pending bigint")
    assert {r["partition"]: r["lag"] for r in commits.lag(pending).collect()} == {0: 4, 2: 4}


def test_gap_alarms_reach_over_batches(spark, feed):
    alarms = GapAlarms(spark, shared_dir(spark, "alarms"), 10)
    feed([{"timestamp": 1, "sequence_number": 1, "producer_id": "p"}])
    path = feed([{"timestamp": 20, "sequence_number": 5, "producer_id": "p"}])
    feed([{"timestamp": 21, "sequence_number": 6, "producer_id": "p"}])
    streams.run_batches(eventlog.read_event_stream(spark, path, 1), alarms, shared_dir(spark, "cp"))
    found = {r["kind"]: (r["start_us"], r["end_us"], r["missing"]) for r in alarms.alarms.all().collect()}
    assert found == {"sequence_gap": (10**6, 20 * 10**6, 3), "rate_gap": (10**6, 20 * 10**6, None)}


def test_a_batch_run_again_changes_nothing(spark):
    router = RetryRouter(spark, shared_dir(spark, "retries"))
    schema = "message_id string, attempt int, ok boolean"
    one = spark.createDataFrame([("a", 1, False), ("b", 1, True), ("c", 1, False)], schema)
    two = spark.createDataFrame([("a", 2, False), ("a", 3, False), ("c", 2, True)], schema)
    router(one, 0)
    router(two, 1)
    router(two, 1)
    status = {(r["batch"], r["message_id"]): (r["status"], r["failures"]) for r in router.outcomes.all().collect()}
    assert status == {
        (0, "a"): ("pending", 1), (0, "b"): ("consumed", 0), (0, "c"): ("pending", 1),
        (1, "a"): ("dlq", 3), (1, "c"): ("consumed", 1),
    }
    assert router.carried.latest().count() == 0


def test_stream_and_batch_agree_on_closed_windows(spark, feed):
    from eventrill.operators.windows import tumbling

    path = feed(seconds(*[i * 0.7 for i in range(100)]))
    env = streams.with_watermark(eventlog.read_event_stream(spark, path), 0)
    stream = streams.run_to_table(streams.stream_tumbling(env, 5), "w")
    batch = tumbling(eventlog.replay_event_log(spark, path)[0], 5).where(F.col("end_us") <= 69_300_000)
    assert stream.count() == 13 and stream.exceptAll(batch.select(stream.columns)).count() == 0


def test_a_late_event_raises_no_alarm(spark, feed):
    alarms = GapAlarms(spark, shared_dir(spark, "alarms"), 1_000)

    def numbered(*numbers):
        return [{"timestamp": n, "sequence_number": n, "producer_id": "p"} for n in numbers]

    feed(numbered(1, 2, 3, 4, 6, 7, 8, 9, 10))
    path = feed(numbered(5))
    feed(numbered(11, 12))
    streams.run_batches(eventlog.read_event_stream(spark, path, 1), alarms, shared_dir(spark, "cp"))
    found = [(r["kind"], r["start_us"], r["end_us"], r["missing"]) for r in alarms.alarms.all().collect()]
    assert found == [("sequence_gap", 4 * 10**6, 6 * 10**6, 1)]
    assert len(alarms.state._batches()) == 2  # older state is removed


def test_newest_outcome_over_all_batches(spark):
    router = RetryRouter(spark, shared_dir(spark, "retries"))
    schema = "message_id string, attempt int, ok boolean"
    router(spark.createDataFrame([("a", 1, False), ("b", 1, True)], schema), 0)
    router(spark.createDataFrame([("a", 2, True), ("c", 1, False)], schema), 1)
    newest = {r["message_id"]: (r["status"], r["failures"]) for r in router.newest().collect()}
    assert newest == {"a": ("consumed", 1), "b": ("consumed", 0), "c": ("pending", 1)}


def test_rejects_of_a_stream_are_counted(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"event_id": "x"}\nnot json\n\n[1]\n')
    stream = eventlog.read_event_stream(spark, str(folder)).writeStream.format("noop")
    query = stream.option("checkpointLocation", shared_dir(spark, "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    seen = [p["observedMetrics"]["lines"] for p in query.recentProgress if p["observedMetrics"]]
    assert (sum(s["read"] for s in seen), sum(s["rejected"] for s in seen)) == (3, 2)
