import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventrill.session import local_session  # noqa: E402

T0_US = 1_700_000_000_000_000
ENV = (
    "event_id string, event_type string, ts_us bigint, partition int, sequence_number bigint, "
    "producer_id string, ordinal bigint"
)


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=4)


@pytest.fixture
def make_env(spark):
    """Envelopes from dicts; seconds in ``at`` are counted from T0."""

    def make(events):
        rows = []
        for i, e in enumerate(events):
            rows.append(
                (
                    e.get("event_id", f"e{i}"),
                    e.get("event_type", "Click"),
                    T0_US + round(e.get("at", 0) * 1_000_000),
                    e.get("partition", i % 4),
                    e.get("sequence_number", i + 1),
                    e.get("producer_id", "test-producer"),
                    e.get("ordinal", i),
                )
            )
        return spark.createDataFrame(rows, ENV)

    return make


@pytest.fixture
def steady(make_env):
    def make(n, rate, start=0.0, kinds=("PageView", "Click", "Purchase")):
        return [
            {"at": start + i / rate, "event_type": kinds[i % len(kinds)], "event_id": f"{start}-{i}"} for i in range(n)
        ]

    return make


@pytest.fixture
def write_lines(tmp_path):
    def write(lines, name="log.jsonl"):
        path = tmp_path / name
        path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")
        return str(path)

    return write
