"""Every registered query against its SQL on the smallest given tables, and the shape of its plan."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.check_oracles import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_same_rows_as_the_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == ""


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


# What may meet in one task: tables with a row per window, cut or group, and reports' heads.
ROW_SIZED = [
    "event_gaps", "gap_stats", "time_gaps", "duplicates", "sequence_gaps", "sessions_global", "sessions_by_user",
    "append_log", "append_log_rr", "assign_partition_rr", "retention", "compaction", "dedup_first", "fan_out",
    "commit_offsets", "take_accepted", "route_retries", "latency_summary_by_type",
]


@pytest.mark.parametrize("name", ROW_SIZED)
def test_no_row_sized_single_partition(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a window over everything is allowed on piece summaries only: below it is an aggregate
    for chunk in re.split(r"Exchange SinglePartition", plan)[1:]:
        assert re.search(r"HashAggregate|SortAggregate|ObjectHashAggregate|TakeOrdered", chunk.split("Scan parquet")[0]), name


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["count_by_type"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<event_type:string>", plan)
