"""Chained stateful operators: over batches, late rows, restarts, and beside the batch forms."""

import json
import os

import pytest
from pyspark.sql import functions as F

from eventrill.operators import lifecycle as lc
from eventrill.session import shared_dir
from eventrill.sources import tables
from eventrill.streaming import folds
from eventrill.streaming import queries as streams

S = 1_000_000


@pytest.fixture
def feed(spark, tmp_path):
    """A stream of JSON files, one per batch, with columns by schema; ``at`` is in seconds."""

    class Feed:
        def __init__(self, schema):
            self.folder, self.schema, self.n = tmp_path / "feed", f"at double, {schema}", 0
            self.folder.mkdir()

        def add(self, *rows):
            file = self.folder / f"{self.n:04d}.json"
            file.write_text("".join(json.dumps(r) + "\n" for r in rows))
            os.utime(file, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
            self.n += 1

        def stream(self, delay_s):
            rows = spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.folder))
            ts = F.timestamp_micros((F.col("at") * S).cast("bigint"))
            return streams.with_watermark(rows.withColumn("ts", ts), delay_s)

    return Feed


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_depths_over_batches_and_a_restart(spark, feed):
    f = feed("kind string, attempt int, topic string")
    f.add({"at": 1, "kind": "produced"}, {"at": 1.5, "kind": "produced"}, {"at": 2, "kind": "consumed", "attempt": 1})
    f.add({"at": 6, "kind": "retry", "attempt": 1}, {"at": 3.2, "kind": "produced"})  # late, but in time
    f.add({"at": 9, "kind": "dlq", "attempt": 3})
    f.add({"at": 1.1, "kind": "produced"}, {"at": 14})  # too late: not counted
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "cp")

    def run():
        return sorted(tuple(r) for r in streams.run_to_table(folds.stream_depths(f.stream(4), 1), "d", out, checkpoint).collect())

    depths = {1: (2, 0, 0), 2: (1, 0, 0), 3: (2, 0, 0), 4: (2, 0, 0), 5: (2, 0, 0), 6: (1, 1, 0), 7: (1, 1, 0), 8: (1, 1, 0), 9: (1, 0, 1)}
    assert run() == [(t * S, t * S + S, *d) for t, d in depths.items()]
    f.add({"at": 16, "kind": "produced"})
    f.add({"at": 40})
    later = {t: (1, 0, 1) for t in range(10, 16)} | {16: (2, 0, 1)}
    assert run() == [(t * S, t * S + S, *d) for t, d in (depths | later).items()]


def test_depths_per_key_fill_in_chunks(spark, feed, monkeypatch):
    monkeypatch.setattr(folds, "ROWS_AT_ONCE", 7)
    f = feed("kind string, attempt int, topic string")
    f.add({"at": 0, "kind": "produced", "topic": "a"}, {"at": 20, "kind": "produced", "topic": "a"}, {"at": 5, "kind": "produced", "topic": None})
    f.add({"at": 100, "topic": "z"})
    got = sorted_rows(streams.run_to_table(folds.stream_depths(f.stream(0), 1, ["topic"]), "d"))
    expected = [("a", t * S, t * S + S, 1 + (t == 20), 0, 0) for t in range(21)] + [(None, 5 * S, 6 * S, 1, 0, 0)]
    assert got == sorted(expected, key=str)


def test_depths_equal_the_batch_form(spark, feed):
    f = feed("kind string, attempt int, topic string")
    steps = [(i * 7 % 50 + i / 10, ("produced", "consumed", "retry", "dlq")[i % 4], 1 + i % 3) for i in range(200)]
    for k in range(4):
        f.add(*[{"at": a, "kind": kind, "attempt": n} for a, kind, n in steps[k::4]])
    f.add({"at": 500})
    got = streams.run_to_table(folds.stream_depths(f.stream(100), 2), "d")
    log = spark.createDataFrame([(int(a * S), kind, n) for a, kind, n in steps], "ts_us bigint, kind string, attempt int")
    empty = {c: F.lit(None).cast("string") for c in ("producer_id", "consumer_id", "topic", "partition")}
    batch = lc.depth_series(lc.rollup(log.withColumns(empty), 2), 2)
    assert sorted_rows(got) == sorted_rows(batch)


def test_session_line(spark, feed):
    f = feed("x int")
    f.add(*[{"at": a} for a in (1, 2, 10, 11, 12)])  # 8 and 10 apart are more and as much as the gap below
    f.add({"at": 22}, {"at": 9})
    f.add({"at": 60})
    f.add({"at": 200})
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "cp")
    run = lambda: sorted_rows(streams.run_to_table(folds.stream_session_line(f.stream(15), 10), "s", out, checkpoint))
    assert run() == sorted([(1 * S, 22 * S, 7), (60 * S, 60 * S, 1)], key=str)
    f.add({"at": 205}, {"at": 230})
    f.add({"at": 400})
    assert run() == sorted([(1 * S, 22 * S, 7), (60 * S, 60 * S, 1), (200 * S, 205 * S, 2), (230 * S, 230 * S, 1)], key=str)


def test_session_line_is_closed_by_the_watermark_alone(spark, feed):
    f = feed("x int")
    f.add({"at": 1}, {"at": 4})
    f.add({"at": 40})  # opens the next one, which stays open
    assert sorted_rows(streams.run_to_table(folds.stream_session_line(f.stream(5), 5), "s")) == [(1 * S, 4 * S, 2)]


def test_session_line_beside_the_batch_form(spark, feed, make_env):
    from eventrill.operators.windows import sessions

    at = [(i * i * 13 % 997) + i / 7 for i in range(150)]
    f = feed("x int")
    for k in range(5):
        f.add(*[{"at": a} for a in sorted(at)[k::5]])
    f.add({"at": 5_000})
    got = streams.run_to_table(folds.stream_session_line(f.stream(2_000), 9), "s")
    ordered = [round(a * S) for a in at]
    rows = spark.createDataFrame([(int(a * S), i) for i, a in enumerate(at)], "ts_us bigint, ordinal bigint")
    assert len(ordered) == 150 and sorted_rows(got) == sorted_rows(sessions(rows, 9))


def test_a_producer_that_never_comes_back(spark, feed):
    f = feed("producer_id string")
    f.add({"at": 1, "producer_id": "p"}, {"at": 2, "producer_id": "q"}, {"at": 11, "producer_id": "p"})
    f.add({"at": 30, "producer_id": "p"})
    f.add({"at": 29, "producer_id": None})
    f.add({"at": 35, "producer_id": "r"})
    got = sorted_rows(streams.run_to_table(folds.stream_silences(f.stream(3), 10), "x"))
    assert got == sorted([("p", 11 * S, 21 * S, 2), ("q", 2 * S, 12 * S, 1)], key=str)


def test_attempts_of_a_message_in_different_batches(spark, feed):
    f = feed("message_id string, attempt int, ok boolean")
    row = lambda at, m, n, ok: {"at": at, "message_id": m, "attempt": n, "ok": ok}
    f.add(row(1, "a", 1, False), row(1, "b", 1, True), row(1, "c", 1, False), row(2, "d", 1, False))
    f.add(row(6, "a", 2, False), row(8, "c", 2, True), row(6, "a", 2, False))  # one delivered twice
    f.add(row(11, "a", 3, False), row(3, "d", 2, False), row(12, "a", 4, True))  # late; beyond the budget
    f.add(row(100, "z", 1, True))
    got = sorted_rows(streams.run_to_table(folds.stream_retries(f.stream(10), 9), "r"))
    assert got == [("a", "dlq", 3), ("b", "consumed", 0), ("c", "consumed", 1), ("d", "pending", 2)]


def test_retries_of_ids_that_go_up_with_time_are_spread(spark, feed):
    """Removed ids lie side by side in the state store if they are its first key; a look-up steps over all of them."""
    f = feed("message_id string, attempt int, ok boolean")
    f.add({"at": 1, "message_id": "1", "attempt": 1, "ok": False}, {"at": 2, "message_id": None, "attempt": 1, "ok": True})
    f.add({"at": 5, "message_id": "1", "attempt": 2, "ok": True}, {"at": 5, "message_id": "2", "attempt": 1, "ok": False})
    f.add({"at": 100, "message_id": "3", "attempt": 1, "ok": True})
    retries = folds.stream_retries(f.stream(10), 9)
    assert retries.columns == ["message_id", "status", "failures"]
    plan = retries._jdf.queryExecution().analyzed().toString()
    group = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert "xxhash64(message_id" in group.split("Aggregate [")[1].split(",")[0]
    assert sorted_rows(streams.run_to_table(retries, "r")) == sorted([("1", "consumed", 1), ("2", "pending", 1), (None, "consumed", 0)], key=str)


def test_a_part_of_a_stream_is_written_to_more_files_as_it_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 2_000)
    at = F.timestamp_micros(F.lit(1_700_000_000 * S) + F.col("id") * S)
    rows = spark.range(30_000).select(
        F.col("id").alias("event_id"), at.alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(50.0).alias("value"), F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    stream = tables.event_stream(spark, str(tmp_path))
    out, seen = shared_dir(spark, "cp"), []
    streams.run_batches(stream, lambda batch, _: seen.append((batch.count(), batch.rdd.getNumPartitions())), out)
    assert [n for n, _ in seen] == [6_000] * 5  # a batch is still a part
    files = stream_files(stream)
    assert len(files) == 15  # three each, of 2,000 rows; two each before
    assert tables._files_per_batch([27_000_000] * 5) > 2 and tables._files_per_batch([27_000_000, 0]) == 2


def stream_files(stream):
    path = stream._jdf.queryExecution().analyzed().toString().split("FileSource[")[1].split("]")[0]
    folder = path.removeprefix("file:")
    return [x for x in os.listdir(folder) if x.endswith(".parquet")]
