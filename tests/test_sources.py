import json

import pytest
from pyspark.sql import functions as F

from eventrill.functions.payloads import FACTORIES, parse_payload
from eventrill.schema import PAYLOADS
from eventrill.sources import eventlog, synth

LINES = [
    "{}", "NOT JSON", "", "   ", "[1]", "5", '{"timestamp":"abc"}',
    '{"event_id":"a","partition":"2","sequence_number":2.7,"timestamp":1700000000.123456}',
    '{"timestamp":null}', '{"event_id":null,"sequence_number":"2.7"}',
]


def test_lenient_reading(spark, write_lines):
    env, rejects = eventlog.read_event_log(spark, write_lines(LINES))
    rows = env.orderBy("ordinal").collect()
    assert [r["event_id"] for r in rows] == ["", "a", None]
    empty, full, coerced = rows
    assert (empty["event_type"], empty["ts_us"], empty["partition"], empty["sequence_number"]) == ("unknown", 0, 0, 0)
    assert (full["ts_us"], full["partition"], full["sequence_number"]) == (1_700_000_000_123_456, 2, 2)
    assert coerced["sequence_number"] == 2
    assert sorted(r["value"] for r in rejects.collect()) == sorted(
        ["NOT JSON", "[1]", "5", '{"timestamp":"abc"}', '{"timestamp":null}']
    )


def test_the_consumer_has_another_default_type(spark, write_lines):
    env, _ = eventlog.replay_event_log(spark, write_lines(["{}"]))
    row = env.first()
    assert row["event_type"] == "" and row["received_at_us"] > 0


def test_ordinal_is_the_line_order_across_splits_and_files(spark, write_lines):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        paths = [write_lines([{"sequence_number": f * 300 + i} for i in range(300)], f"{f}.jsonl") for f in range(3)]
        env, _ = eventlog.read_event_log(spark, paths)
        assert env.rdd.getNumPartitions() > 5
        rows = env.select("ordinal", "sequence_number").collect()
        assert [r["sequence_number"] for r in sorted(rows, key=lambda r: r["ordinal"])] == list(range(900))
        assert len({r["ordinal"] for r in rows}) == 900
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_and_read_back(spark, tmp_path):
    made = synth.synth_events(spark, 200, rate=7.0, start_us=1_700_000_000_000_001)
    path = str(tmp_path / "log")
    eventlog.write_event_log(made, path)
    back, rejects = eventlog.read_event_log(spark, path)
    assert rejects.count() == 0
    columns = [c for c in eventlog.ENVELOPE_COLUMNS if c not in ("payload", "ordinal")]
    assert back.select(columns).exceptAll(made.select(columns)).count() == 0 and back.count() == 200
    ours = {r["event_id"]: json.loads(r["payload"]) for r in made.collect()}
    assert all(json.loads(r["payload"]) == ours[r["event_id"]] for r in back.collect())
    line = spark.read.text(path).first()[0]
    assert ": " not in line and list(json.loads(line))[:3] == ["event_id", "event_type", "timestamp"]


def test_sse_frames(spark, tmp_path):
    made = synth.synth_events(spark, 20)
    eventlog.write_sse(made.coalesce(1), str(tmp_path / "sse"))
    text = "".join(p.read_text() for p in (tmp_path / "sse").glob("part-*"))
    frames = [f for f in text.split("\n\n") if f]
    assert len(frames) == 20
    assert all(f.startswith("id: ") and f.split("\n")[1].startswith("data: {") for f in frames)
    back, rejects = eventlog.read_sse_capture(spark, str(tmp_path / "sse"))
    assert back.count() == 20 and rejects.count() == 0


def test_synthetic_events_do_not_depend_on_partitioning(spark):
    a, b = (synth.synth_events(spark, 100, slices=s) for s in (1, 7))
    assert a.exceptAll(b).count() == 0
    assert synth.synth_events(spark, 100, seed="1").exceptAll(b).count() == 100


@pytest.mark.parametrize("kind", list(FACTORIES))
def test_typed_payloads(spark, kind):
    made = synth.synth_events(spark, 60, types=[kind], partitions=3)
    rows = parse_payload(made, kind).select("partition", "data", "partition_key").collect()
    assert len(rows) == 60 and {r["partition"] for r in rows} <= {0, 1, 2}
    names = [f.split()[0].strip(",") for f in PAYLOADS[kind].split(", ") if "w:" not in f and "h:" not in f]
    for r in rows:
        data = r["data"].asDict()
        assert set(names) - {"viewport"} <= set(data) and all(v is not None for v in data.values())
        assert r["partition_key"] in (data.get("user_id"), data.get("host"), data.get("sensor_id"))
    if kind == "Purchase":
        assert all(
            round(r["data"]["unit_price_usd"] * r["data"]["quantity"], 2) == pytest.approx(r["data"]["total_usd"])
            for r in rows
        )


def test_round_robin_source(spark):
    made = synth.synth_events(spark, 12, strategy="roundrobin")
    assert {r["count"] for r in made.groupBy("partition").count().collect()} == {3}
    assert made.agg(F.min("sequence_number"), F.max("sequence_number")).first()[:] == (1, 12)
    with pytest.raises(ValueError):
        synth.synth_events(spark, 1, partitions=0)


def test_null_sink(spark):
    eventlog.write_noop(synth.synth_events(spark, 5))


def test_endless_source(spark):
    assert synth.synth_stream(spark, 5, types=["Click"]).isStreaming
