import pytest
from pyspark.sql import functions as F

from eventrill.operators import topiclog as tl

RECORD = "topic string, key string, value string, acks string, ordinal bigint"


@pytest.fixture
def make_log(spark):
    def make(records, partitions=4, strategy="key", log=None, **scan_args):
        rows = [
            (r.get("topic", "t"), r.get("key"), r.get("value", '{"a":1}'), r.get("acks", "leader"), i)
            for i, r in enumerate(records)
        ]
        topics = spark.createDataFrame([("t", partitions), ("u", partitions)], "topic string, num_partitions int")
        return tl.append_log(spark.createDataFrame(rows, RECORD), topics, log, strategy, **scan_args)

    return make


def offsets(log):
    out = {}
    for r in log.collect():
        out.setdefault((r["topic"], r["partition"]), []).append(r["offset"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("rows_per_piece", [7, 10**6])
def test_same_key_same_partition_and_no_holes(make_log, rows_per_piece):
    log = make_log([{"key": f"user-{i % 20}"} for i in range(100)], rows_per_piece=rows_per_piece)
    homes = log.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1")
    assert homes.count() == 0
    assert all(o == list(range(len(o))) for o in offsets(log).values())
    assert sum(map(len, offsets(log).values())) == 100


def test_offsets_follow_arrival(make_log):
    log = make_log([{"key": "a"} for _ in range(30)], rows_per_piece=4).orderBy("offset").collect()
    assert [r["ordinal"] for r in log] == list(range(30))


@pytest.mark.parametrize("rows_per_piece", [3, 10**6])
def test_round_robin(make_log, rows_per_piece):
    log = make_log([{} for _ in range(12)], strategy="roundrobin", rows_per_piece=rows_per_piece)
    assert {k: v for k, v in offsets(log).items()} == {("t", p): [0, 1, 2] for p in range(4)}


def test_records_without_key_go_to_partition_0(make_log):
    assert list(offsets(make_log([{}, {}]))) == [("t", 0)]


def test_a_second_batch_goes_on(make_log):
    first = make_log([{} for _ in range(3)]).cache()
    assert offsets(make_log([{}, {}], log=first)) == {("t", 0): [3, 4]}


def test_unknown_topic_fails(make_log):
    with pytest.raises(Exception, match="unknown topic: nope"):
        make_log([{"topic": "nope"}]).collect()


def test_bad_partitioning_arguments(make_env):
    with pytest.raises(ValueError, match="at least 1"):
        tl.assign_partition(make_env([{}]), "event_id", 0)
    with pytest.raises(ValueError, match="unknown strategy"):
        tl.assign_partition(make_env([{}]), "event_id", 2, "random")


def test_size_and_checksum(make_log):
    rows = make_log([{"key": "abc", "value": '{"a":1,"b":2}'}, {"value": '{"b": 2, "a": 1}'}]).collect()
    assert sorted(r["size_bytes"] for r in rows) == [13 + 3 + 64, 16 + 64]
    assert len({r["checksum"] for r in rows}) == 1


def test_high_watermark_and_isolation(make_log):
    log = make_log([{"acks": "none"}])
    assert tl.watermarks(log).first()["high_watermark"] == 0
    assert tl.read_log(log, isolation="committed").count() == 0
    log = make_log([{"acks": "none"}, {}, {"acks": "none"}])
    mark = tl.watermarks(log).first()
    assert (mark["high_watermark"], mark["end_offset"]) == (2, 3)
    assert tl.read_log(log, isolation="committed").count() == 2
    assert tl.read_log(log).count() == 3
    with pytest.raises(ValueError):
        tl.read_log(log, isolation="dirty")


def test_read_from_an_offset(spark, make_log):
    log = make_log([{} for _ in range(10)])
    starts = spark.createDataFrame([("t", 0, 4)], "topic string, partition int, start bigint")
    assert sorted(r["offset"] for r in tl.read_log(log, starts, 3).collect()) == [4, 5, 6]
    kept = log.where("offset >= 6")  # the start lies before what is left
    assert sorted(r["offset"] for r in tl.read_log(kept, starts, 3).collect()) == [6, 7, 8]


@pytest.mark.parametrize("rows_per_piece", [4, 10**6])
def test_retention(make_log, rows_per_piece):
    log = make_log([{"value": '"' + "x" * (60 + i) + '"'} for i in range(20)])
    kept = tl.apply_retention(log, 500, rows_per_piece=rows_per_piece).collect()
    sizes = [r["size_bytes"] for r in log.orderBy("offset").collect()]
    want, total = [], 0
    for at in range(19, -1, -1):
        total += sizes[at]
        if total > 500:
            break
        want.append(at)
    assert sorted(r["offset"] for r in kept) == sorted(want) and len(want) > 1
    assert [r["offset"] for r in tl.apply_retention(log, 1).collect()] == [19]


def test_compaction(make_log):
    log = make_log([{"key": k} for k in ("a", "b", "a", None, None, "a")], partitions=1)
    assert sorted(r["offset"] for r in tl.compact(log).collect()) == [1, 3, 4, 5]


@pytest.fixture
def members(spark):
    return lambda n: spark.createDataFrame([("t", f"m{i:02d}") for i in range(n)], "topic string, member_id string")


@pytest.fixture
def partitions(spark):
    return lambda n: spark.createDataFrame([("t", n)], "topic string, num_partitions int")


@pytest.mark.parametrize("strategy", ["range", "roundrobin"])
@pytest.mark.parametrize("m", [1, 2, 3, 4, 7])
def test_assignments_are_disjoint_and_cover(partitions, members, strategy, m):
    rows = tl.assign_members(partitions(4), members(m), strategy).collect()
    assert sorted(r["partition"] for r in rows) == [0, 1, 2, 3]


def test_assignment_sizes(partitions, members):
    def sizes(strategy, m):
        rows = tl.assign_members(partitions(4), members(m), strategy).groupBy("member_id").count()
        return [r["count"] for r in rows.orderBy("member_id").collect()]

    assert sizes("range", 3) == [1, 1, 2]
    assert sizes("roundrobin", 3) == [2, 1, 1]
    assert sizes("range", 7) == [1, 1, 1, 1]
    assert tl.assign_members(partitions(4), members(0)).count() == 0


def test_only_active_members(spark, members):
    crashed = spark.createDataFrame([("m01",)], "member_id string")
    left = tl.active_members(members(3), members(3), crashed)
    assert sorted(r["member_id"] for r in left.collect()) == ["m00", "m02"]


def test_poll_to_the_end(spark, make_log, partitions, members):
    log = make_log([{"key": f"k{i}"} for i in range(40)]).cache()
    assigned = tl.assign_members(partitions(4), members(2))
    commits = spark.createDataFrame([], "group_id string, topic string, partition int, committed bigint")
    groups = spark.createDataFrame([("g",)], "group_id string")
    assert tl.total_lag(tl.consumer_lag(log, commits, "g")).first()[0] == 40
    seen = []
    for _ in range(6):
        fetched, new = tl.poll(log, commits, assigned, "g", 5)
        seen += [(r["partition"], r["offset"]) for r in fetched.collect()]
        rows = [tuple(r) for r in tl.commit_offset(commits, new, groups).collect()]
        commits = spark.createDataFrame(rows, commits.schema)
    assert len(seen) == len(set(seen)) == 40
    lag = tl.consumer_lag(log, commits, "g")
    assert tl.total_lag(lag).first()[0] == 0
    assert {r["lag"] for r in tl.lag_by_consumer(lag, assigned).collect()} == {0}


def test_commit_for_an_unknown_group_fails(spark):
    schema = "group_id string, topic string, partition int, committed bigint"
    commits = spark.createDataFrame([("g", "t", 0, 3)], schema)
    groups = spark.createDataFrame([("g",)], "group_id string")
    new = spark.createDataFrame([("h", "t", 0, 5)], schema)
    with pytest.raises(Exception, match="group not registered: h"):
        tl.commit_offset(commits, new, groups).collect()


def test_topic_list(spark, partitions):
    with_u = tl.create_topics(partitions(4), spark.createDataFrame([("a", 2)], "topic string, num_partitions int"))
    assert [r["topic"] for r in tl.list_topics(with_u).collect()] == ["a", "t"]
    with pytest.raises(Exception, match="topic exists: t"):
        tl.create_topics(partitions(4), partitions(2)).collect()
    names = spark.createDataFrame([("t",)], "topic string")
    assert [r["topic"] for r in tl.drop_topics(with_u, names).collect()] == ["a"]
    with pytest.raises(Exception, match="unknown topic: x"):
        tl.drop_topics(with_u, spark.createDataFrame([("x",)], "topic string")).collect()


def test_flat_listing(spark, make_log):
    log = make_log([{"key": "a"}]).withColumn("ts", F.lit(0)).withColumn("record_id", F.lit("r"))
    log = log.withColumn("headers", F.create_map())
    assert tl.flatten_log(log).columns == [
        "offset", "partition", "ts", "key", "value", "headers", "record_id", "checksum"
    ]


def test_partitions_without_records_are_listed(spark):
    log = spark.createDataFrame(
        [("t", 1, 0, "leader", 10), ("t", 1, 1, "none", 10)], "topic string, partition int, offset bigint, acks string, size_bytes bigint"
    )
    topics = spark.createDataFrame([("t", 3), ("u", 1), ("none", 0)], "topic string, num_partitions int")
    stats = {(r["topic"], r["partition"]): tuple(r)[2:] for r in tl.topic_stats(log, topics).collect()}
    assert stats == {("t", 0): (0,) * 5, ("t", 1): (0, 1, 2, 2, 20), ("t", 2): (0,) * 5, ("u", 0): (0,) * 5}
    commits = spark.createDataFrame([("g", "t", 1, 0)], "group_id string, topic string, partition int, committed bigint")
    lag = {(r["topic"], r["partition"]): r["lag"] for r in tl.consumer_lag(log, commits, "g", topics).collect()}
    assert lag == {("t", 0): 0, ("t", 1): 1, ("t", 2): 0, ("u", 0): 0}


def test_compaction_hashes(spark):
    log = spark.createDataFrame([], "topic string, partition int, offset bigint, key string, value string")
    plan = tl.compact(log)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
