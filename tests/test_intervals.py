"""Points in intervals, gaps and overlaps, sketches, the id index and counts on the way."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from eventrill.operators import consumer, idindex, intervals, sketches
from eventrill.operators.topiclog import content_checksum
from eventrill.plans import catalog
from eventrill.session import shared_dir
from eventrill.sources import eventlog
from eventrill.streaming import progress
from eventrill.streaming import queries as streams


def random_intervals(rng, n):
    """Of very different lengths, negative starts, repeats and empty ones among them."""
    out = [(i, a, a + rng.choice([0, 1, 3, 100, 5_000, 10**7, -5])) for i in range(n) for a in [rng.randrange(-3_000, 20_000)]]
    return out + [(n, 50, 51), (n + 1, 50, 51), (n + 2, -(2**40), 2**40)]


@pytest.fixture
def points_and_spans(spark):
    rng = random.Random(3)
    points = [(rng.randrange(-3_500, 21_000), rng.choice("ab") if rng.random() < 0.95 else None, i) for i in range(300)]
    points += [(50, "a", 300), (51, "a", 301), (None, "a", 302)]
    spans = [(i, rng.choice("ab") if rng.random() < 0.95 else None, a, z) for i, a, z in random_intervals(rng, 120)]
    left = spark.createDataFrame(points, "at bigint, k string, x int").repartition(3)
    return points, spans, left, spark.createDataFrame(spans, "id int, k string, a bigint, z bigint")


@pytest.mark.parametrize("by", [[], ["k"]])
def test_points_in_intervals(spark, points_and_spans, by):
    points, spans, left, right = points_and_spans
    right = right if by else right.drop("k")
    found = intervals.in_intervals(left, right, "at", "a", "z", by)
    assert found.columns == ["at", "k", "x", "id"] + ["a", "z"]
    expected = {
        (x, i) for at, k, x in points for i, other, a, z in spans
        if at is not None and a <= at < z and (not by or (k is not None and k == other))
    }
    assert sorted((r["x"], r["id"]) for r in found.collect()) == sorted(expected) and len(expected) > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.in_intervals(left, right.limit(0), "at", "a", "z", by).count() == 0


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("rows_per_piece", [10, 10**6])
def test_counts_in_intervals(spark, points_and_spans, by, rows_per_piece):
    points, spans, left, right = points_and_spans
    found = intervals.counts_in_intervals(left, right, "at", "a", "z", by, rows_per_piece=rows_per_piece)
    expected = {
        i: sum(at is not None and a <= at < z and (not by or k == other) for at, k, _ in points) for i, other, a, z in spans
    }
    assert {r["id"]: r["count"] for r in found.collect()} == expected and found.count() == len(spans)


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("rows_per_piece", [10, 10**6])
def test_totals_of_the_points_in_intervals(spark, points_and_spans, by, rows_per_piece):
    points, spans, left, right = points_and_spans
    value = {x: None if x % 3 == 0 else (2**58 + x) * (-1 if x % 5 == 0 else 1) for _, _, x in points}  # overflow if added up
    values = spark.createDataFrame(list(value.items()), "x int, v bigint")
    right = right.unionByName(right.where("id < 5")) if by else right.drop("k").unionByName(right.drop("k").where("id < 5"))
    wanted = intervals.Totals("n", "top", {"sum": "v", "places": "x"})
    few = right.where("z - a <= 100")  # in the longest ones, the sum itself does not fit
    found = intervals.in_intervals(left.join(values, "x"), few, "at", "a", "z", by, wanted, rows_per_piece=rows_per_piece)
    assert found.columns == [*right.columns, "n", "sum", "places", "top"]
    expected = []
    for i, other, a, z in spans:
        held = [(at, x) for at, k, x in points if at is not None and a <= at < z and (not by or (k is not None and k == other))]
        known = [value[x] for _, x in held if value[x] is not None]
        if held and z - a <= 100:
            row = (i, len(held), sum(known) if known else None, sum(x for _, x in held), max(at for at, _ in held))
            expected += [row] * (2 if i < 5 else 1)
    got = [(r["id"], r["n"], r["sum"], r["places"], r["top"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str) and len(expected) > 10
    assert intervals.in_intervals(left, right.limit(0), "at", "a", "z", by, intervals.Totals("n", "top")).count() == 0
    with pytest.raises(TypeError):
        intervals.in_intervals(left, right, "at", "a", "z", by, intervals.Totals("n", "top", {"sum": "k"}))


def test_incidents_in_a_crowd_make_no_pairs(spark, tmp_path):
    """A thousand events in each of a thousand incidents: the pairs would be a million rows."""
    n = 1_000
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id"))
    rows = spark.range(2 * n).select(
        F.col("id").alias("event_id"), at.alias("ts"), F.lit(4).cast("bigint").alias("user_id"),
        F.when(F.col("id") < n, "error").otherwise("view").alias("event_type"), F.lit(50.0).alias("value"), F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    found = catalog.QUERIES["events_in_incidents"](spark, str(tmp_path))
    got = {int(r["incident_id"]): (r["events"], r["numbers"]) for r in found.collect()}
    assert got == {i: (2 * n - i, sum(range(i + 1, 2 * n + 1))) for i in range(n)}
    assert _most_rows(found) <= 10 * n


def _most_rows(df):
    """The most rows that a step of a plan that has run gave out."""
    plans, most = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        metric = plan.metrics().get("numOutputRows")
        most = max(most, metric.get().value() if metric.isDefined() else 0)
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStage"):
            plans.append(plan.plan())
        else:
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return most


def test_no_bin_holds_many_copies_of_a_long_interval(spark):
    spans = spark.createDataFrame([(0, 10**12), (5, 6)], "start_us bigint, end_us bigint")
    points = spark.createDataFrame([(5,), (10**12 - 1,), (10**12,)], "ts_us bigint")
    assert sorted(map(tuple, intervals.in_intervals(points, spans).collect())) == [
        (5, 0, 10**12), (5, 5, 6), (10**12 - 1, 0, 10**12)
    ]


def test_faults(spark):
    ranges = spark.createDataFrame(
        [("a", 0, 10), ("a", 10, 20), ("b", 0, 10), ("b", 5, 7), ("b", 12, 15), ("b", 14, 14), ("c", 3, 4), ("b", 6, 13)],
        "k string, start bigint, end bigint",
    )
    found = {(r["k"], r["kind"], r["from"], r["to"]) for r in intervals.faults(ranges, ["k"], rows_per_piece=2).collect()}
    assert found == {("b", "overlap", 5, 7), ("b", "overlap", 6, 10), ("b", "overlap", 12, 13)}
    bounds = spark.createDataFrame([("a", 0, 20), ("b", -1, 16), ("c", 0, 4), ("d", 0, 3)], "k string, lo bigint, hi bigint")
    missing = {tuple(r)[:1] + tuple(r)[2:] for r in intervals.faults(ranges, ["k"], bounds=bounds).where("kind = 'gap'").collect()}
    assert missing == {("b", -1, 0), ("b", 15, 16), ("c", 0, 3), ("d", 0, 3)}
    assert intervals.faults(ranges.limit(0), ["k"]).count() == 0


def test_set_faults(spark):
    expected = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2)], "topic string, partition int")
    held = spark.createDataFrame([("t", 0, "x"), ("t", 0, "x"), ("t", 1, "x"), ("t", 1, "y"), ("t", 9, "y")], "topic string, partition int, member_id string")
    found = sorted(map(tuple, intervals.set_faults(held, expected).collect()))
    assert found == [("shared", "t", 1), ("unassigned", "t", 2), ("unknown", "t", 9)]


def test_sketches_merge_over_any_span(spark):
    n = 20_000
    rows = spark.range(n).select(
        (F.col("id") * 1_000_000).alias("ts_us"), F.pmod(F.col("id") * 7_919, F.lit(n)).cast("double").alias("v"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"),
    )
    stored = sketches.sketch_windows(rows.unionByName(rows.limit(5).withColumn("v", F.lit(None).cast("double"))), "v", 1_000, ["k"])
    assert stored.count() == 40
    whole = sketches.summary(sketches.merged_sketches(stored)).first()
    assert (whole["samples"], whole["min_ms"], whole["max_ms"], whole["mean_ms"]) == (n, 0.0, n - 1.0, (n - 1) / 2)
    for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        assert abs(whole[name] / n - p) <= 3 * sketches.RANK_ERROR[800]
    part = sketches.merged_sketches(stored, ["k"], from_us=2_000 * 10**6, to_us=5_000 * 10**6)
    assert {r["k"]: r["samples"] for r in sketches.summary(part, ["k"]).collect()} == {"a": 1_000, "b": 2_000}
    assert sketches.summary(sketches.merged_sketches(stored.limit(0), ["k"]), ["k"]).count() == 0


def test_ids_of_earlier_runs(spark):
    path = shared_dir(spark, "ids")
    rows = lambda ids: spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "event_id string, ordinal bigint")
    ids = lambda found: sorted(str(r["event_id"]) for r in found.collect())
    index = idindex.IdIndex(spark, path, buckets=4, ids_per_bucket=100)
    assert ids(index.first_seen(rows(["a", "b", "a", None]), 0)) == ["None", "a", "b"]
    many = [f"x{i}" for i in range(500)]
    assert ids(index.first_seen(rows(["b", *many]), 1)) == sorted(many)
    again = idindex.IdIndex(spark, path, buckets=4, ids_per_bucket=100)  # another process
    assert ids(again.first_seen(rows(["b", *many]), 1)) == sorted(many)  # a run that is run again
    assert ids(again.first_seen(rows(["a", "x7", "new", *many]), 2)) == ["new"]
    assert again.known(3).count() == 503 and again.known(1).count() == 2
    assert again.first_seen(rows([]), 3).count() == 0


def test_only_the_buckets_asked_for_are_read(spark):
    index = idindex.IdIndex(spark, shared_dir(spark, "ids"), buckets=16, ids_per_bucket=2_000)
    rows = spark.range(5_000).select(F.concat(F.lit("e"), "id").alias("event_id"), F.col("id").alias("ordinal"))
    index.first_seen(rows, 0)
    new = rows.withColumn("event_id", F.concat(F.lit("n"), "event_id"))
    assert index.maybe_seen(new, 1).count() < 1_000  # of 5,000 new ids few have to be looked up
    assert index.maybe_seen(rows, 1).count() == 5_000  # and none that was seen is missed
    one = index.seen(rows.limit(1), 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    files = one.inputFiles()
    assert one.count() == 1 and len({f.split("bucket=")[1].split("/")[0] for f in files if "/ids/" in f}) <= 16


def test_first_seen_of_a_stream_goes_on_after_a_restart(spark, tmp_path):
    folder, out, checkpoint, path = tmp_path / "feed", shared_dir(spark, "out"), shared_dir(spark, "cp"), shared_dir(spark, "ids")
    folder.mkdir()

    def feed(n, ids):
        (folder / f"{n}.jsonl").write_text("".join(f'{{"event_id": "{i}", "timestamp": {n}}}\n' for i in ids))

    def run():
        stream = eventlog.read_event_stream(spark, str(folder), 1).select("event_id", "ordinal")
        streams.run_batches(stream, idindex.FirstSeen(idindex.IdIndex(spark, path, buckets=4), out), checkpoint)
        return sorted(r["event_id"] for r in spark.read.schema("event_id string").parquet(out).collect())

    feed(1, "aab")
    feed(2, "bc")
    assert run() == ["a", "b", "c"]
    feed(3, "acd")
    assert run() == ["a", "b", "c", "d"]


def test_checksums_of_content(spark):
    bodies = [
        '{"b": {"y": 1, "x": [1, {"q": null, "p": "s"}]}, "a": 1.5}', '{"a":1.5,"b":{"x":[1,{"p":"s","q":null}],"y":1}}',
        '{"a":1.5,"b":{"x":[{"p":"s","q":null},1],"y":1}}', "no json", None,
    ]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, value string")
    sums = [r[0] for r in rows.orderBy("i").select(content_checksum(F.col("value"))).collect()]
    assert sums[0] == sums[1] != sums[2] and sums[3] is not None and sums[4] is None and len(set(sums)) == 4


def test_counts_while_a_batch_runs(spark, make_env):
    env = make_env([{"event_type": t} for t in ("Click", "Click", "PageView", None)])
    seen = Observation("c")
    assert progress.counted_filter(env, ["Click"], observation=seen).count() == 2
    assert seen.get == {"received": 4, "filtered_out": 2, "processed": 2}


def test_progress_of_a_stream_with_late_rows(spark, tmp_path):
    import os

    for n, at in enumerate([[1, 2, 30], [31, 3, 90], [2, 91]]):
        file = tmp_path / f"{n}.jsonl"
        file.write_text("".join(f'{{"event_id": "{a}", "timestamp": {a}, "event_type": "Click"}}\n' for a in at))
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    with progress.ProgressRows(spark) as seen:
        env = streams.with_watermark(eventlog.read_event_stream(spark, str(tmp_path), 1), 5)
        streams.run_to_table(streams.stream_tumbling(progress.counted_filter(env, ["Click"]), 10), "p")
    rows = [tuple(r) for r in seen.table().orderBy("batch").collect()]
    assert [r[:5] for r in rows] == [(0, 3, 3, 0, 3), (1, 3, 3, 0, 3), (2, 2, 2, 0, 2)]
    # a batch drops what is behind the watermark of the batch before
    assert [r[5] for r in rows] == [0, 0, 1]


def test_ordered_statistics(spark):
    rows = [("by_type", "b", 2.0), ("by_type", "a", 2.0), ("by_type", "c", 9.0), ("by_partition", "10", 1.0), ("by_partition", "9", 5.0), ("eps", "", 1.0)]
    stats = spark.createDataFrame(rows, "metric string, key string, value double")
    places = {(r["metric"], r["key"]): r["place"] for r in consumer.ordered_stats(stats).collect()}
    assert places == {("by_type", "c"): 1, ("by_type", "a"): 2, ("by_type", "b"): 3, ("by_partition", "9"): 1, ("by_partition", "10"): 2, ("eps", ""): 1}
