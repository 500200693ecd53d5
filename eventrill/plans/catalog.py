"""Every registered query with the SQL that must give the same rows.

Queries read the given tables whole. Each is ``(spark, sf_dir) -> DataFrame``; its
SQL is written against the same parquet tables and is independent of the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventrill.functions import payloads, rates
from eventrill.operators import (
    aggregates, anomalies, consumer, idindex, intervals, lifecycle, load, sketches, topiclog, windows,
)
from eventrill.operators.order import OrderedScan
from eventrill.plans.analysis import analysis_report, load_run_report
from eventrill.plans.oracle_views import env_sql, hash_sql, life_log_sql, life_sql, log_sql
from eventrill.session import shared_dir, written
from eventrill.sources import eventlog, synth, tables
from eventrill.streaming import folds, progress
from eventrill.streaming import queries as streams
from eventrill.streaming.state import GapAlarms, OffsetCommits, RetryRouter

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HOUR, DAY = 3_600, 86_400
H_US, D_US = HOUR * 1_000_000, DAY * 1_000_000
TYPES = ("click", "view", "error")
PARTITIONS = (0, 1, 2)
IN_TYPES = "event_type IN ('click', 'view', 'error') AND \"partition\" IN (0, 1, 2)"
EPS = "count / greatest((end_us - start_us) / 1e6, 0.001)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


env = tables.envelope


# -- windows ------------------------------------------------------------------------

def _tumbling_sql(size_us: int) -> str:
    return f"""
      w AS (SELECT unnest(range((SELECT min(ts_us) // {size_us} FROM env), (SELECT max(ts_us) // {size_us} + 1 FROM env)))
              * {size_us} AS start_us),
      c AS (SELECT ts_us // {size_us} * {size_us} AS start_us, count(*) AS n FROM env GROUP BY 1),
      win AS (SELECT start_us, start_us + {size_us} AS end_us, coalesce(n, 0) AS count FROM w LEFT JOIN c USING (start_us))"""


def _sliding_sql(size_us: int, slide_us: int) -> str:
    return f"""
      s AS (SELECT min(ts_us) AS a, max(ts_us) AS z FROM env),
      w AS (SELECT a + k * {slide_us} AS start_us, a + k * {slide_us} + {size_us} AS end_us
            FROM (SELECT a, unnest(range(0, (z - a) // {slide_us} + 1)) AS k FROM s)),
      win AS (SELECT start_us, end_us, count(e.ts_us) AS count
              FROM w LEFT JOIN env e ON e.ts_us >= start_us AND e.ts_us < end_us GROUP BY 1, 2)"""


def _session_sql(gap_us: int, key: str | None = None) -> str:
    by = f"PARTITION BY {key} " if key else ""
    k = f"{key}, " if key else ""
    return f"""
      g AS (SELECT *, ts_us - lag(ts_us) OVER ({by}ORDER BY ts_us, ordinal) AS gap FROM env),
      i AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > {gap_us} THEN 1 ELSE 0 END)
                      OVER ({by}ORDER BY ts_us, ordinal ROWS UNBOUNDED PRECEDING) AS sid FROM g),
      win AS (SELECT {k}min(ts_us) AS start_us, max(ts_us) AS end_us, count(*) AS count FROM i GROUP BY {k}sid)"""


@query("tumbling_counts", env_sql(f", {_tumbling_sql(6 * H_US)} SELECT * FROM win"))
def _(spark, d):
    return windows.tumbling(env(spark, d), 6 * HOUR)


@query("sliding_counts", env_sql(f", {_sliding_sql(12 * H_US, 4 * H_US)} SELECT * FROM win"))
def _(spark, d):
    return windows.sliding(env(spark, d), 12 * HOUR, 4 * HOUR)


@query("sliding_gapped", env_sql(f", {_sliding_sql(H_US, 3 * H_US)} SELECT * FROM win"))
def _(spark, d):
    return windows.sliding(env(spark, d), HOUR, 3 * HOUR)


@query("sessions_global", env_sql(f", {_session_sql(900_000_000)} SELECT * FROM win"))
def _(spark, d):
    return windows.sessions(env(spark, d), 900)


@query("sessions_by_user", env_sql(f", {_session_sql(6 * H_US, 'partition_key')} SELECT * FROM win"))
def _(spark, d):
    return windows.sessions(env(spark, d), 6 * HOUR, ["partition_key"])


@query("throughput_series", env_sql(f", {_tumbling_sql(H_US)} SELECT start_us AS t_us, {EPS} AS eps, count FROM win"))
def _(spark, d):
    return windows.throughput_series(windows.tumbling(env(spark, d), HOUR))


@query("session_throughput", env_sql(f", {_session_sql(900_000_000)} SELECT start_us AS t_us, {EPS} AS eps, count FROM win"))
def _(spark, d):
    return windows.throughput_series(windows.sessions(env(spark, d), 900))


@query(
    "non_empty_windows",
    env_sql(f", {_tumbling_sql(300_000_000)} SELECT * FROM win WHERE count > 0"),
)
def _(spark, d):
    return windows.non_empty(windows.tumbling(env(spark, d), 300))


@query(
    "window_type_distribution",
    env_sql(f"SELECT ts_us // {D_US} * {D_US} AS start_us, event_type, count(*) AS count FROM env GROUP BY 1, 2"),
)
def _(spark, d):
    return windows.type_distribution(env(spark, d), size_s=DAY)


@query(
    "window_partition_distribution",
    env_sql(
        f", {_sliding_sql(12 * H_US, 4 * H_US)} SELECT start_us, \"partition\", count(*) AS count "
        "FROM w JOIN env e ON e.ts_us >= start_us AND e.ts_us < end_us GROUP BY 1, 2"
    ),
)
def _(spark, d):
    return windows.partition_distribution(
        env(spark, d), window_type="sliding", size_s=12 * HOUR, slide_s=4 * HOUR
    )


@query(
    "session_type_distribution",
    env_sql(
        f", {_session_sql(900_000_000)} SELECT min(ts_us) OVER (PARTITION BY sid) AS start_us, event_type "
        "FROM i"
    ).replace("SELECT min(ts_us) OVER", "SELECT start_us, event_type, count(*) AS count FROM (SELECT min(ts_us) OVER")
    + ") GROUP BY 1, 2",
)
def _(spark, d):
    return windows.type_distribution(env(spark, d), window_type="session", gap_s=900)


@query("tail_rate", env_sql(f", {_tumbling_sql(60_000_000)} SELECT start_us, count AS new_rows FROM win"))
def _(spark, d):
    return windows.tail_rate(env(spark, d), 60)


# -- aggregates -----------------------------------------------------------------------

@query("count_by_type", env_sql("SELECT event_type, count(*) AS count FROM env GROUP BY 1"))
def _(spark, d):
    return aggregates.count_by_type(env(spark, d))


@query("count_by_partition", env_sql('SELECT "partition", count(*) AS count FROM env GROUP BY 1'))
def _(spark, d):
    return aggregates.count_by_partition(env(spark, d))


@query("count_by_producer", env_sql("SELECT producer_id, count(*) AS count FROM env GROUP BY 1"))
def _(spark, d):
    return aggregates.count_by_producer(env(spark, d))


@query(
    "top_event_types",
    env_sql("SELECT event_type, count(*) AS count FROM env GROUP BY 1 ORDER BY 2 DESC, min(ts_us) LIMIT 3"),
)
def _(spark, d):
    return aggregates.top_event_types(env(spark, d), 3)


@query(
    "stream_summary",
    env_sql(
        "SELECT count(*) AS total_events, (max(ts_us) - min(ts_us)) / 1e6 AS duration_s, "
        "count(*) / greatest((max(ts_us) - min(ts_us)) / 1e6, 0.001) AS overall_eps FROM env"
    ),
)
def _(spark, d):
    return aggregates.stream_summary(env(spark, d))


_GAPS = ", g AS (SELECT *, lag(ts_us) OVER o AS prev_us, lag(event_id) OVER o AS prev_event FROM env WINDOW o AS (ORDER BY ts_us, ordinal))"


@query(
    "event_gaps",
    env_sql(f"{_GAPS} SELECT event_id, ordinal, prev_event, ts_us - prev_us AS gap_us FROM g"),
)
def _(spark, d):
    rows = env(spark, d).select("event_id", "ts_us", "ordinal")
    return aggregates.with_gap(rows).select("event_id", "ordinal", "prev_event", "gap_us")


@query(
    "gap_stats",
    env_sql(
        f"{_GAPS} SELECT min(ts_us - prev_us) / 1e3 AS min_ms, max(ts_us - prev_us) / 1e3 AS max_ms, "
        "round(sum(ts_us - prev_us) / count(prev_us) / 1e3, 6) AS mean_ms FROM g"
    ),
)
def _(spark, d):
    return aggregates.gap_stats(env(spark, d)).withColumn("mean_ms", F.round("mean_ms", 6))


# -- anomalies --------------------------------------------------------------------------

_RATES = """
  rated AS (SELECT *, {eps} AS eps FROM win WHERE count > 0),
  stats AS (SELECT count(*) AS n, avg(eps) AS mean, stddev_pop(eps) AS std FROM rated),
  flagged AS (SELECT *, abs(eps - mean) / std AS z FROM {rows}, stats WHERE n >= 3 AND std >= 0.001)
  SELECT CASE WHEN eps > mean THEN 'rate_spike' ELSE 'rate_gap' END AS kind,
         CASE WHEN z > {t} * 2 THEN 'high' ELSE 'medium' END AS severity, start_us, end_us,
         round(eps, 6) AS eps, round(z, 6) AS z_score
  FROM flagged WHERE z > {t}"""

_ZIPPED = """(SELECT a.start_us, a.end_us, r.eps FROM
   (SELECT *, row_number() OVER (ORDER BY start_us) AS k FROM win) a JOIN
   (SELECT *, row_number() OVER (ORDER BY start_us) AS k FROM rated) r USING (k))"""


def _rates(windowed: DataFrame, threshold: float, compat: bool = False) -> DataFrame:
    """The detector's rows with its unrounded numbers instead of texts."""
    numbers = anomalies.window_rates(windowed, compat).select(
        "start_us", F.round("eps", 6).alias("eps"), F.round("z_score", 6).alias("z_score")
    )
    found = anomalies.rate_anomalies(windowed, threshold, compat).select("kind", "severity", "start_us", "end_us")
    return found.join(numbers, "start_us")


@query(
    "rate_anomalies",
    env_sql(f", {_tumbling_sql(60_000_000)}, {_RATES.format(eps=EPS, rows='rated', t=3.0)}"),
)
def _(spark, d):
    return _rates(windows.tumbling(env(spark, d), 60), 3.0)


@query(
    "rate_anomalies_compat",
    env_sql(f", {_tumbling_sql(60_000_000)}, {_RATES.format(eps=EPS, rows=_ZIPPED, t=3.0)}"),
)
def _(spark, d):
    return _rates(windows.tumbling(env(spark, d), 60), 3.0, compat=True)


@query(
    "time_gaps",
    env_sql(
        f"{_GAPS} SELECT 'rate_gap' AS kind, CASE WHEN ts_us - prev_us < 3000000000 THEN 'medium' ELSE 'high' END AS severity, "
        "prev_us AS start_us, ts_us AS end_us, prev_event FROM g WHERE ts_us - prev_us > 1000000000"
    ),
)
def _(spark, d):
    found = anomalies.time_gaps(env(spark, d), 1000)
    return found.select("kind", "severity", "start_us", "end_us", F.col("details")["prev_event"].alias("prev_event"))


_DUPES = "SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts_us, ordinal) AS sighting FROM env"


@query(
    "duplicates",
    env_sql(
        "SELECT 'duplicate' AS kind, 'high' AS severity, ts_us AS start_us, ts_us AS end_us, "
        "'Duplicate event_id detected: ' || event_id AS description, event_id, event_type "
        f"FROM ({_DUPES}) WHERE sighting > 1"
    ),
)
def _(spark, d):
    found = anomalies.duplicates(env(spark, d))
    details = [F.col("details")[k].alias(k) for k in ("event_id", "event_type")]
    return found.select("kind", "severity", "start_us", "end_us", "description", *details)


_STEPS = (
    "SELECT *, lag(sequence_number) OVER o AS from_seq, lag(ts_us) OVER o AS from_us FROM {src} "
    "WINDOW o AS (PARTITION BY producer_id ORDER BY sequence_number, ts_us, ordinal)"
)


@query(
    "sequence_gaps",
    env_sql(
        "SELECT 'sequence_gap' AS kind, 'medium' AS severity, from_us AS start_us, ts_us AS end_us, "
        "'Sequence gap of ' || CAST(sequence_number - from_seq - 1 AS VARCHAR) || ' in producer ' || producer_id AS description, "
        "CAST(from_seq AS VARCHAR) AS from_seq, CAST(sequence_number AS VARCHAR) AS to_seq "
        f"FROM ({_STEPS.format(src='env')}) WHERE sequence_number - from_seq > 1"
    ),
)
def _(spark, d):
    found = anomalies.sequence_gaps(env(spark, d))
    details = [F.col("details")[k].alias(k) for k in ("from_seq", "to_seq")]
    return found.select("kind", "severity", "start_us", "end_us", "description", *details)


_ALL_ANOMALIES = f""", {_tumbling_sql(H_US)},
  found AS (
    SELECT 'rate' AS detector, kind, severity, start_us, end_us
    FROM (WITH {_RATES.format(eps=EPS, rows='rated', t=2.0)})
    UNION ALL
    SELECT 'gap', 'rate_gap', CASE WHEN ts_us - prev_us < 3000000000 THEN 'medium' ELSE 'high' END, prev_us, ts_us
    FROM (SELECT ts_us, lag(ts_us) OVER (ORDER BY ts_us, ordinal) AS prev_us FROM env) WHERE ts_us - prev_us > 1000000000
    UNION ALL
    SELECT 'duplicate', 'duplicate', 'high', ts_us, ts_us FROM ({_DUPES}) WHERE sighting > 1
    UNION ALL
    SELECT 'sequence', 'sequence_gap', 'medium', from_us, ts_us FROM ({_STEPS.format(src='env')})
    WHERE sequence_number - from_seq > 1)"""


@query("all_anomalies", env_sql(f"{_ALL_ANOMALIES} SELECT * FROM found"))
def _(spark, d):
    rows = env(spark, d)
    found = anomalies.detect_anomalies(rows, windows.tumbling(rows, HOUR), 2.0, 1000)
    return found.select("detector", "kind", "severity", "start_us", "end_us")


@query(
    "first_anomalies",
    env_sql(
        f"{_ALL_ANOMALIES} SELECT detector, kind, start_us, end_us FROM found "
        "ORDER BY list_position(['rate', 'gap', 'duplicate', 'sequence'], detector), start_us, end_us LIMIT 50"
    ),
)
def _(spark, d):
    rows = env(spark, d)
    found = anomalies.detect_anomalies(rows, windows.tumbling(rows, HOUR), 2.0, 1000)
    return anomalies.first_anomalies(found, 50).select("detector", "kind", "start_us", "end_us")


@query(
    "analysis_report",
    env_sql(
        f"""{_ALL_ANOMALIES}
        SELECT 'summary' AS section, count(*) AS count FROM (SELECT 1)
        UNION ALL SELECT 'top_event_types', least(5, count(DISTINCT event_type)) FROM env
        UNION ALL SELECT 'partition_distribution', count(DISTINCT "partition") FROM env
        UNION ALL SELECT 'producer_distribution', count(DISTINCT producer_id) FROM env
        UNION ALL SELECT 'throughput_series', count(*) FROM win
        UNION ALL SELECT 'gap_stats', 1
        UNION ALL SELECT 'anomalies', count(*) FROM found"""
    ),
)
def _(spark, d):
    report = analysis_report(env(spark, d), window_size_s=HOUR, spike_threshold=2.0, gap_s=1000)
    return report.groupBy("section").agg(F.count("body").alias("count"))


# -- consumer --------------------------------------------------------------------------

_CONSUMED = f"""
  p AS (SELECT *, ({IN_TYPES}) AS passed FROM env),
  c AS (SELECT *, passed AND row_number() OVER (PARTITION BY event_id, passed ORDER BY ordinal) = 1 AS processed FROM p)"""


def _consumed(spark, d):
    return consumer.consume(env(spark, d), TYPES, PARTITIONS)


def _accepted(spark, d):
    return consumer.dedup_first(consumer.filter_events(env(spark, d), TYPES, PARTITIONS))


@query(
    "filter_events",
    env_sql(f"SELECT event_id, event_type, \"partition\", ordinal FROM env WHERE {IN_TYPES} AND amount >= 10"),
)
def _(spark, d):
    kept = consumer.filter_events(env(spark, d), TYPES, PARTITIONS, F.col("amount") >= 10)
    return kept.select("event_id", "event_type", "partition", "ordinal")


@query("dedup_first", env_sql(f", {_CONSUMED} SELECT event_id, ordinal FROM c WHERE processed"))
def _(spark, d):
    return _accepted(spark, d).select("event_id", "ordinal")


@query(
    "drop_processed",
    env_sql(
        "SELECT event_id, ordinal FROM env WHERE event_id NOT IN (SELECT event_id FROM env WHERE amount > 20)"
    ),
)
def _(spark, d):
    rows = env(spark, d)
    return consumer.drop_processed(rows, rows.where(F.col("amount") > 20)).select("event_id", "ordinal")


@query("with_latency", env_sql("SELECT event_id, ordinal, (received_at_us - ts_us) / 1e3 AS latency_ms FROM env"))
def _(spark, d):
    return consumer.with_latency(env(spark, d)).select("event_id", "ordinal", "latency_ms")


@query(
    "consumer_totals",
    env_sql(
        f""", {_CONSUMED} SELECT count(*) AS received, count(*) FILTER (WHERE NOT processed) AS filtered_out,
        count(*) FILTER (WHERE processed) AS processed,
        CASE WHEN max(received_at_us) > min(received_at_us) THEN count(*) FILTER (WHERE processed)
             / greatest((max(received_at_us) - min(received_at_us)) / 1e6, 0.001) ELSE 0.0 END AS eps FROM c"""
    ),
)
def _(spark, d):
    return consumer.consumer_totals(_consumed(spark, d))


_FLOOR = """
  l AS (SELECT received_at_us - ts_us AS us, row_number() OVER (ORDER BY received_at_us - ts_us) - 1 AS i,
               count(*) OVER () AS n FROM {src} WHERE received_at_us >= ts_us{more}),
  q AS (SELECT coalesce(max(n), 0) AS samples,
               coalesce(max(us) FILTER (WHERE i = least(n * 50 // 100, n - 1)) / 1e3, 0) AS p50_ms,
               coalesce(max(us) FILTER (WHERE i = least(n * 95 // 100, n - 1)) / 1e3, 0) AS p95_ms,
               coalesce(max(us) FILTER (WHERE i = least(n * 99 // 100, n - 1)) / 1e3, 0) AS p99_ms FROM l)"""


@query("latency_percentiles_floor", env_sql(f", {_FLOOR.format(src='env', more='')} SELECT * FROM q"))
def _(spark, d):
    return consumer.latency_percentiles(env(spark, d))


@query(
    "consumer_stats",
    env_sql(
        f""", {_CONSUMED}, {_FLOOR.format(src='c', more=' AND processed')},
        t AS (SELECT count(*) AS received, count(*) FILTER (WHERE NOT processed) AS filtered_out,
                     count(*) FILTER (WHERE processed) AS processed,
                     greatest((max(received_at_us) - min(received_at_us)) / 1e6, 0.001) AS elapsed_s FROM c),
        o AS (
        SELECT 'received' AS metric, '' AS key, CAST(received AS DOUBLE) AS value FROM t
        UNION ALL SELECT 'filtered_out', '', filtered_out FROM t
        UNION ALL SELECT 'processed', '', processed FROM t
        UNION ALL SELECT 'eps', '', processed / elapsed_s FROM t
        UNION ALL SELECT 'elapsed_s', '', elapsed_s FROM t
        UNION ALL SELECT 'samples', '', samples FROM q
        UNION ALL SELECT 'p50_ms', '', p50_ms FROM q
        UNION ALL SELECT 'p95_ms', '', p95_ms FROM q
        UNION ALL SELECT 'p99_ms', '', p99_ms FROM q
        UNION ALL SELECT 'by_type', event_type, count(*) FROM c WHERE processed GROUP BY 2
        UNION ALL SELECT 'by_partition', CAST("partition" AS VARCHAR), count(*) FROM c WHERE processed GROUP BY 2)
        SELECT metric, key, CAST(value AS DOUBLE) AS value FROM o"""
    ),
)
def _(spark, d):
    return consumer.consumer_stats(_consumed(spark, d))


_KNOWN = "(SELECT CAST(range AS INTEGER) AS \"partition\" FROM range(0, 6))"


@query(
    "partition_offsets",
    env_sql(
        f'SELECT "partition", greatest(coalesce(m, -1), -1) AS pending FROM {_KNOWN} k FULL JOIN '
        '(SELECT "partition", max(sequence_number) AS m FROM env GROUP BY 1) s USING ("partition")'
    ),
)
def _(spark, d):
    return consumer.partition_offsets(env(spark, d), 6)


@query(
    "commit_offsets",
    env_sql(
        f""", {_CONSUMED}, a AS (SELECT *, row_number() OVER (ORDER BY ordinal) AS rn, count(*) OVER () AS n FROM c WHERE processed),
        s AS (SELECT "partition", max(sequence_number) AS p,
                     max(sequence_number) FILTER (WHERE rn <= n // 100 * 100) AS k FROM a GROUP BY 1)
        SELECT "partition", coalesce(p, -1) AS pending, coalesce(k, -1) AS committed,
               greatest(coalesce(p, -1) - coalesce(k, -1), 0) AS lag
        FROM {_KNOWN} FULL JOIN s USING ("partition")"""
    ),
)
def _(spark, d):
    return consumer.commit_offsets(_accepted(spark, d), 6)


_REPLAY_US = 1_800_000_000_000_000


def _replay_lines(events: DataFrame) -> DataFrame:
    """The events as JSON lines, and for some of them a blank line, a broken one or one without a number."""
    broken = F.concat(F.substring(eventlog.to_json_line(events), 1, 25), F.lit("..."))
    extra = F.array_compact(F.array(
        eventlog.to_json_line(events),
        F.when(F.pmod("ordinal", F.lit(7)) == 0, "  "),
        F.when(F.pmod("ordinal", F.lit(11)) == 0, broken),
        F.when(F.pmod("ordinal", F.lit(13)) == 0, F.lit('{"event_type": "click", "timestamp": null}')),
    ))
    return events.select(F.explode(extra).alias("value"))


def _replayed(spark, d) -> tuple[DataFrame, DataFrame]:
    path = shared_dir(spark, "replay")
    _replay_lines(tables.enveloped(spark, d)).write.text(path)
    return eventlog.replay_event_log(spark, path, _REPLAY_US)


@query(
    "replay_consumer_stats",
    env_sql(
        f"""{_FLOOR.format(src='r', more='').replace("l AS (SELECT", f", r AS (SELECT * REPLACE ({_REPLAY_US} AS received_at_us) FROM base), l AS (SELECT")},
        o AS (
        SELECT 'received' AS metric, '' AS key, count(*) AS value FROM base
        UNION ALL SELECT 'filtered_out', '', 0
        UNION ALL SELECT 'processed', '', count(*) FROM base
        UNION ALL SELECT 'eps', '', 0
        UNION ALL SELECT 'elapsed_s', '', 0.001
        UNION ALL SELECT 'samples', '', samples FROM q
        UNION ALL SELECT 'p50_ms', '', p50_ms FROM q
        UNION ALL SELECT 'p95_ms', '', p95_ms FROM q
        UNION ALL SELECT 'p99_ms', '', p99_ms FROM q
        UNION ALL SELECT 'by_type', event_type, count(*) FROM base GROUP BY 2
        UNION ALL SELECT 'by_partition', CAST("partition" AS VARCHAR), count(*) FROM base GROUP BY 2
        UNION ALL SELECT 'rejects', '', count(*) FILTER (ordinal % 11 = 0) + count(*) FILTER (ordinal % 13 = 0) FROM base)
        SELECT metric, key, CAST(value AS DOUBLE) AS value FROM o"""
    ),
)
def _(spark, d):
    events, rejects = _replayed(spark, d)
    stats = consumer.consumer_stats(consumer.consume(events))
    count = rejects.agg(F.count(F.lit(1)).cast("double").alias("value"))
    return stats.unionByName(count.select(F.lit("rejects").alias("metric"), F.lit("").alias("key"), "value"))


@query(
    "take_accepted",
    env_sql(f", {_CONSUMED} SELECT event_id, ordinal FROM c WHERE processed ORDER BY ordinal LIMIT 250"),
)
def _(spark, d):
    return consumer.take_accepted(_accepted(spark, d).select("event_id", "ordinal"), 250)


# -- topic log -------------------------------------------------------------------------

def _log(spark, d):
    return topiclog.append_log(tables.records(spark, d), tables.topics(spark, d))


def _wider_topics(spark, d):
    """The topics with two partitions more than any record goes to."""
    return tables.topics(spark, d).withColumn("num_partitions", F.col("num_partitions") + 2)


def _stored_log(spark, d):
    """The log as the table it is in use: appended once, then read by several operators."""
    return written(_log(spark, d), "topic-log")


@query(
    "assign_partition_key",
    env_sql(f"SELECT event_id, ordinal, CAST({hash_sql('partition_key')} % 8 AS INTEGER) AS \"partition\" FROM env"),
)
def _(spark, d):
    placed = topiclog.assign_partition(env(spark, d), "partition_key", 8)
    return placed.select("event_id", "ordinal", "partition")


@query(
    "assign_partition_rr",
    env_sql("SELECT event_id, ordinal, CAST((row_number() OVER (ORDER BY ordinal) - 1) % 8 AS INTEGER) AS \"partition\" FROM env"),
)
def _(spark, d):
    rows = env(spark, d).select("event_id", "ordinal", "partition_key")
    placed = topiclog.assign_partition(rows, "partition_key", 8, "roundrobin")
    return placed.select("event_id", "ordinal", "partition")


@query(
    "assign_partition_rr_by_producer",
    env_sql(
        "SELECT event_id, ordinal, CAST((row_number() OVER (PARTITION BY producer_id ORDER BY ordinal) - 1) % 8 AS INTEGER) "
        "AS \"partition\" FROM env"
    ),
)
def _(spark, d):
    rows = env(spark, d).select("event_id", "ordinal", "partition_key", "producer_id")
    placed = topiclog.assign_partition(rows, "partition_key", 8, "roundrobin", ["producer_id"])
    return placed.select("event_id", "ordinal", "partition")


@query("append_log", log_sql('SELECT topic, "partition", "offset", key, value, record_id, acks, size_bytes FROM log'))
def _(spark, d):
    return _log(spark, d).select("topic", "partition", "offset", "key", "value", "record_id", "acks", "size_bytes")


@query(
    "append_log_rr",
    log_sql(
        """, turns AS (SELECT r.*, row_number() OVER (PARTITION BY topic ORDER BY ordinal) - 1 AS k, num_partitions AS n
                       FROM records r JOIN topics USING (topic))
        SELECT topic, record_id, CAST(k % n AS INTEGER) AS "partition", k // n AS "offset" FROM turns"""
    ),
)
def _(spark, d):
    log = topiclog.append_log(tables.records(spark, d), tables.topics(spark, d), strategy="roundrobin")
    return log.select("topic", "record_id", "partition", "offset")


@query(
    "log_checksums",
    log_sql("SELECT topic, count(DISTINCT replace(value, ' ', '')) AS contents FROM log GROUP BY 1"),
)
def _(spark, d):
    # every content has its own checksum, so there are as many checksums as contents
    sums = topiclog.with_checksum(tables.records(spark, d).select("topic", "value"))
    return sums.groupBy("topic").agg(F.countDistinct("checksum").alias("contents"))


@query(
    "flatten_log",
    log_sql('SELECT "offset", "partition", key, value, record_id FROM log'),
)
def _(spark, d):
    return topiclog.flatten_log(_log(spark, d)).select("offset", "partition", "key", "value", "record_id")


_READ = """ SELECT topic, "partition", "offset", record_id FROM (
   SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS r FROM ({rows})) WHERE r <= {n}"""


@query("read_log", log_sql(_READ.format(n=500, rows="SELECT * FROM log")))
def _(spark, d):
    return topiclog.read_log(_log(spark, d)).select("topic", "partition", "offset", "record_id")


@query(
    "read_log_committed",
    log_sql(
        _READ.format(
            n=100,
            rows='SELECT l.* FROM log l JOIN (SELECT topic, "partition", max("offset") FILTER (WHERE acks <> \'none\') + 1 AS hw '
            'FROM log GROUP BY 1, 2) h USING (topic, "partition") LEFT JOIN commits c USING (topic, "partition") '
            'WHERE l."offset" < hw AND l."offset" >= coalesce(c.committed + 1, 0)',
        )
    ),
)
def _(spark, d):
    log = _stored_log(spark, d)
    starts = tables.commits_of(log).withColumn("start", F.col("committed") + 1)
    return topiclog.read_log(log, starts, 100, "committed").select("topic", "partition", "offset", "record_id")


_POLL = (
    'SELECT l.*, a.member_id FROM log l JOIN assigned_range a USING (topic, "partition") '
    'LEFT JOIN commits c USING (topic, "partition") WHERE l."offset" > coalesce(c.committed, -1)'
)


def _assigned(spark, d, strategy="range"):
    return topiclog.assign_members(tables.topics(spark, d), tables.members(spark, d), strategy)


@query("poll", log_sql(_READ.format(n=50, rows=_POLL).replace("record_id FROM (", "record_id, member_id FROM (")))
def _(spark, d):
    log = _stored_log(spark, d)
    fetched, _ = topiclog.poll(log, tables.commits_of(log), _assigned(spark, d), tables.GROUP)
    return fetched.select("topic", "partition", "offset", "record_id", "member_id")


@query(
    "poll_commits",
    log_sql(
        f""", new AS (SELECT topic, "partition", max("offset") AS committed FROM ({_READ.format(n=50, rows=_POLL)}) GROUP BY 1, 2)
        SELECT group_id, topic, "partition", committed FROM commits ANTI JOIN new USING (topic, "partition")
        UNION ALL SELECT 'analytics', topic, "partition", committed FROM new"""
    ),
)
def _(spark, d):
    log = _stored_log(spark, d)
    commits = tables.commits_of(log)
    _, new = topiclog.poll(log, commits, _assigned(spark, d), tables.GROUP)
    return topiclog.commit_offset(commits, new, commits.select("group_id").distinct())


_LAG = """
  part_lag AS (SELECT e.topic, e."partition", end_offset, coalesce(c.committed, -1) AS committed,
                      greatest(end_offset - (coalesce(c.committed, -1) + 1), 0) AS lag
               FROM (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM log GROUP BY 1, 2
                     UNION ALL SELECT topic, num_partitions, 0 FROM topics
                     UNION ALL SELECT topic, num_partitions + 1, 0 FROM topics) e
               LEFT JOIN commits c USING (topic, "partition"))"""


def _part_lag(spark, d):
    log = _stored_log(spark, d)
    return topiclog.consumer_lag(log, tables.commits_of(log), tables.GROUP, _wider_topics(spark, d))


@query("consumer_lag", log_sql(f", {_LAG} SELECT * FROM part_lag"))
def _(spark, d):
    return _part_lag(spark, d)


@query(
    "lag_by_consumer",
    log_sql(
        f', {_LAG} SELECT member_id, CAST(sum(coalesce(lag, 0)) AS BIGINT) AS lag FROM assigned_range '
        'LEFT JOIN part_lag USING (topic, "partition") GROUP BY 1'
    ),
)
def _(spark, d):
    return topiclog.lag_by_consumer(_part_lag(spark, d), _assigned(spark, d))


@query("total_lag", log_sql(f", {_LAG} SELECT CAST(sum(lag) AS BIGINT) AS total_lag FROM part_lag"))
def _(spark, d):
    return topiclog.total_lag(_part_lag(spark, d))


@query(
    "retention",
    log_sql(
        """SELECT topic, "partition", "offset", size_bytes FROM (
             SELECT *, sum(size_bytes) OVER (PARTITION BY topic, "partition" ORDER BY "offset" DESC ROWS UNBOUNDED PRECEDING) AS tail,
                    row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset" DESC) AS r FROM log)
           WHERE tail <= 20000 OR r = 1"""
    ),
)
def _(spark, d):
    kept = topiclog.apply_retention(_stored_log(spark, d), 20_000)
    return kept.select("topic", "partition", "offset", "size_bytes")


@query(
    "compaction",
    log_sql(
        """SELECT topic, "partition", "offset", key FROM (
             SELECT *, row_number() OVER (PARTITION BY topic, "partition", key ORDER BY "offset" DESC) AS r FROM log)
           WHERE r = 1 OR key IS NULL"""
    ),
)
def _(spark, d):
    return topiclog.compact(_log(spark, d)).select("topic", "partition", "offset", "key")


@query(
    "topic_stats",
    log_sql(
        """SELECT topic, "partition", min("offset") AS log_start_offset,
                  coalesce(max("offset") FILTER (WHERE acks <> 'none'), -1) + 1 AS high_watermark,
                  max("offset") + 1 AS end_offset, count(*) AS entries, CAST(sum(size_bytes) AS BIGINT) AS total_bytes
           FROM log GROUP BY 1, 2
           UNION ALL SELECT topic, num_partitions, 0, 0, 0, 0, 0 FROM topics
           UNION ALL SELECT topic, num_partitions + 1, 0, 0, 0, 0, 0 FROM topics"""
    ),
)
def _(spark, d):
    return topiclog.topic_stats(_log(spark, d), _wider_topics(spark, d))


@query(
    "topic_watermarks",
    log_sql(
        """SELECT topic, "partition", coalesce(max("offset") FILTER (WHERE acks <> 'none'), -1) + 1 AS high_watermark,
                  max("offset") + 1 AS end_offset FROM log GROUP BY 1, 2
           UNION ALL SELECT topic, num_partitions, 0, 0 FROM topics UNION ALL SELECT topic, num_partitions + 1, 0, 0 FROM topics"""
    ),
)
def _(spark, d):
    return topiclog.watermarks(_log(spark, d), _wider_topics(spark, d))


@query("list_topics", log_sql("SELECT topic FROM topics"))
def _(spark, d):
    return topiclog.list_topics(tables.topics(spark, d))


@query("assign_members_range", log_sql("SELECT * FROM assigned_range"))
def _(spark, d):
    return _assigned(spark, d)


@query("assign_members_rr", log_sql("SELECT * FROM assigned_rr"))
def _(spark, d):
    return _assigned(spark, d, "roundrobin")


@query(
    "active_members",
    log_sql(
        "SELECT topic, member_id FROM members m WHERE EXISTS (SELECT 1 FROM base b WHERE b.event_type = m.topic "
        "AND 'consumer-' || CAST(b.user_id % 3 AS VARCHAR) = m.member_id) AND member_id NOT IN "
        "(SELECT 'consumer-' || CAST(\"partition\" % 3 AS VARCHAR) FROM base WHERE amount = (SELECT max(amount) FROM base))"
    ),
)
def _(spark, d):
    members = tables.members(spark, d)
    rows = tables.produced(spark, d)
    top = env(spark, d).agg(F.max("amount")).scalar()
    down = env(spark, d).where(F.col("amount") == top)
    crashed = down.select(F.concat(F.lit("consumer-"), F.pmod("partition", F.lit(3)).cast("string")).alias("member_id"))
    connected = members.join(rows.select("topic").distinct(), "topic", "left_semi")
    return topiclog.active_members(members, connected, crashed.distinct())


# -- life cycles --------------------------------------------------------------------------

def _life(spark, d):
    return lifecycle.lifecycle_log(tables.produced(spark, d), tables.attempts(spark, d))


@query(
    "fan_out",
    env_sql(
        ", routes AS (SELECT DISTINCT producer_id, event_type AS topic FROM base WHERE amount > 100) "
        "SELECT e.event_id, e.ordinal, e.producer_id, r.topic FROM env e JOIN routes r USING (producer_id)"
    ),
)
def _(spark, d):
    copies = lifecycle.fan_out(env(spark, d), tables.routes(spark, d))
    return copies.select("event_id", "ordinal", "producer_id", "topic")


@query(
    "route_retries",
    life_sql(
        """SELECT message_id,
             CASE WHEN first_ok IS NOT NULL THEN 'consumed' WHEN failed >= 3 THEN 'dlq' ELSE 'pending' END AS status,
             CAST(coalesce(first_ok - 1, failed) AS BIGINT) AS failures,
             CAST(coalesce(first_ok, failed) AS BIGINT) AS attempts
           FROM routed"""
    ),
)
def _(spark, d):
    return lifecycle.route_retries(tables.attempts(spark, d))


@query("lifecycle_log", life_sql('SELECT ts_us, kind, message_id, producer_id, consumer_id, topic, "partition", attempt FROM lifecycle'))
def _(spark, d):
    return _life(spark, d)


@query(
    "lifecycle_counters",
    life_sql(
        """SELECT count(*) FILTER (WHERE kind = 'produced') AS produced, count(*) FILTER (WHERE kind = 'consumed') AS consumed,
           count(*) FILTER (WHERE kind = 'retry' AND attempt = 1) AS failed, count(*) FILTER (WHERE kind = 'dlq') AS dlq
           FROM lifecycle"""
    ),
)
def _(spark, d):
    return lifecycle.lifecycle_counters(_life(spark, d))


def _rolled(spark, d, every_s: float = 1.0):
    return lifecycle.rollup(_life(spark, d), every_s)


@query(
    "produced_per_second",
    life_sql(
        "SELECT ts_us // 1000000 * 1000000 AS start_us, producer_id, count(*) AS count FROM lifecycle "
        "WHERE kind = 'produced' GROUP BY 1, 2"
    ),
)
def _(spark, d):
    return lifecycle.produced_per_second(_rolled(spark, d))


_OFFSETS = (
    "SELECT consumer_id, start_us, CAST(sum(n) OVER (PARTITION BY consumer_id ORDER BY start_us) AS BIGINT) AS consumer_offset "
    "FROM (SELECT consumer_id, ts_us // {s} * {s} AS start_us, count(*) AS n FROM lifecycle WHERE kind = 'consumed' GROUP BY 1, 2)"
)


@query("consumer_offsets_series", life_sql(_OFFSETS.format(s=1_000_000)))
def _(spark, d):
    return lifecycle.consumer_offsets_series(_rolled(spark, d))


_DEPTHS = """
  spine AS (SELECT unnest(range((SELECT min(ts_us) // {s} FROM lifecycle), (SELECT max(ts_us) // {s} + 1 FROM lifecycle))) * {s} AS start_us),
  per AS (SELECT ts_us // {s} * {s} AS start_us, sum(q) AS q, sum(r) AS r, sum(d) AS d FROM deltas GROUP BY 1),
  depth AS (SELECT start_us, start_us + {s} AS end_us,
                   CAST(sum(coalesce(q, 0)) OVER o AS BIGINT) AS queue_depth,
                   CAST(sum(coalesce(r, 0)) OVER o AS BIGINT) AS retry_depth,
                   CAST(sum(coalesce(d, 0)) OVER o AS BIGINT) AS dlq_depth
            FROM spine LEFT JOIN per USING (start_us) WINDOW o AS (ORDER BY start_us))"""


@query("depth_series", life_sql(f", {_DEPTHS.format(s=60_000_000)} SELECT * FROM depth"))
def _(spark, d):
    return lifecycle.depth_series(_rolled(spark, d, 60), 60)


_LAGS = """
  lags AS (SELECT consumer_id, start_us, CAST(sum(v) OVER (PARTITION BY consumer_id ORDER BY start_us) AS BIGINT) AS lag FROM (
    SELECT a.member_id AS consumer_id, ts_us // {s} * {s} AS start_us, sum(q) AS v
    FROM deltas x JOIN assigned_rr a ON a.topic = x.topic AND a."partition" = x."partition" WHERE q <> 0 GROUP BY 1, 2))"""


@query("consumer_lag_series", life_log_sql(f", {_LAGS.format(s=1_000_000)} SELECT * FROM lags"))
def _(spark, d):
    return lifecycle.consumer_lag_series(_rolled(spark, d), _assigned(spark, d, "roundrobin"))


_SNAPSHOTS = f""", {_DEPTHS.format(s=H_US)},
  consumers AS (SELECT DISTINCT member_id AS consumer_id FROM assigned_rr UNION SELECT DISTINCT consumer_id FROM lifecycle WHERE consumer_id IS NOT NULL),
  every AS (SELECT start_us, consumer_id FROM spine CROSS JOIN consumers),
  took AS (SELECT consumer_id, ts_us // {H_US} * {H_US} AS start_us, count(*) AS n FROM lifecycle WHERE kind = 'consumed' GROUP BY 1, 2),
  moved AS (SELECT a.member_id AS consumer_id, ts_us // {H_US} * {H_US} AS start_us, sum(q) AS n
            FROM deltas x JOIN assigned_rr a ON a.topic = x.topic AND a."partition" = x."partition" GROUP BY 1, 2),
  snap AS (
    SELECT ts_us // {H_US} * {H_US} + {H_US} AS t_us, 'produced' AS metric, producer_id AS id, count(*) AS value
    FROM lifecycle WHERE kind = 'produced' GROUP BY 1, 3
    UNION ALL SELECT start_us + {H_US}, 'consumer_offset', consumer_id, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY consumer_id ORDER BY start_us) AS BIGINT)
    FROM every LEFT JOIN took USING (start_us, consumer_id)
    UNION ALL SELECT end_us, 'queue_depth', '', queue_depth FROM depth
    UNION ALL SELECT end_us, 'retry_depth', '', retry_depth FROM depth
    UNION ALL SELECT end_us, 'dlq_depth', '', dlq_depth FROM depth
    UNION ALL SELECT start_us + {H_US}, 'consumer_lag', consumer_id, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY consumer_id ORDER BY start_us) AS BIGINT)
    FROM every LEFT JOIN moved USING (start_us, consumer_id))"""


def _snapshots(spark, d):
    return lifecycle.metrics_snapshots(_rolled(spark, d, HOUR), _assigned(spark, d, "roundrobin"), HOUR)


@query("metrics_snapshots", life_log_sql(f"{_SNAPSHOTS} SELECT * FROM snap"))
def _(spark, d):
    return _snapshots(spark, d)


@query(
    "recent_snapshots",
    life_log_sql(
        f"{_SNAPSHOTS} SELECT * FROM snap WHERE t_us IN (SELECT DISTINCT t_us FROM snap ORDER BY t_us DESC LIMIT 30)"
    ),
)
def _(spark, d):
    return lifecycle.recent_snapshots(_snapshots(spark, d), 30)


# -- load --------------------------------------------------------------------------------

_ELAPSED = """WITH s AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS z FROM events),
  e AS (SELECT event_id, (epoch_us(ts) - a) / 1e6 AS t, (z - a) / 1e6 AS dur FROM events, s)
  SELECT event_id, round(CAST(greatest({rate}, 0.1) AS DOUBLE), 6) AS rate FROM e"""

_PROFILE_ARGS = {
    "steady": ({"rate": 50}, "50.0"),
    "burst": (
        {"baseline_rate": 50, "burst_rate": 500, "burst_duration_s": 7200, "burst_interval_s": 36000},
        "CASE WHEN t % 43200.0 < 7200 THEN 500.0 ELSE 50.0 END",
    ),
    "ramp_up": ({"start_rate": 0, "end_rate": 100}, "100.0 * least(t / dur, 1.0)"),
    "ramp_down": ({"start_rate": 100, "end_rate": 5}, "100.0 - 95.0 * least(t / dur, 1.0)"),
    "spike": (
        {"baseline_rate": 50, "spike_rate": 1000, "spike_duration_s": 86400},
        "CASE WHEN t >= 0.4 * dur AND t < 0.4 * dur + 86400 THEN 1000.0 ELSE 50.0 END",
    ),
    "sinusoidal": (
        {"min_rate": 10, "max_rate": 200, "period_s": 43200},
        "10 + 190 * ((sin(t * (2 * pi() / 43200)) + 1) / 2)",
    ),
}
_NEEDS_DURATION = ("ramp_up", "ramp_down", "spike")


def _profile_query(kind: str, params: dict) -> Query:
    def run(spark, d):
        rows = tables.load_events(spark, d)
        first, last, _ = windows.bounds(rows)
        elapsed = (F.col("ts_us") - first) / 1e6
        extra = {"duration_s": (last - first) / 1e6} if kind in _NEEDS_DURATION else {}
        rate = rates.load_profile(kind, elapsed, **params, **extra)
        return rows.select(F.col("event_id").cast("bigint").alias("event_id"), F.round(rate, 6).alias("rate"))

    return run


for _kind, (_params, _rate_sql) in _PROFILE_ARGS.items():
    query(f"load_profile_{_kind}", _ELAPSED.format(rate=_rate_sql))(_profile_query(_kind, _params))


def _run_profiles() -> dict[str, rates.Profile]:
    duration = F.col("duration_s")
    return {
        "error": rates.steady(0.001),
        "click": rates.ramp_up(0, 10, duration),
        "view": rates.sinusoidal(1, 5, 86_400 * 7),
        "purchase": rates.burst(1, 20, 7_200, 36_000),
        "signup": rates.spike(1, 50, duration, 86_400),
    }


@query(
    "rate_conformance",
    """WITH r AS (SELECT event_type AS pattern, count(*) AS total_events, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS dur
                  FROM events GROUP BY 1),
    m AS (SELECT pattern, CASE pattern
            WHEN 'error' THEN 0.1
            WHEN 'click' THEN 0.1 + 9.9 * 9.9 / (2 * 10)
            WHEN 'view' THEN 3 + 2 * (1 - cos(2 * pi() / 604800 * dur)) / (2 * pi() / 604800 * dur)
            WHEN 'purchase' THEN 1 + 19 * (floor(dur / 43200) * 7200 + least(dur % 43200.0::DOUBLE, 7200)) / dur
            WHEN 'signup' THEN 1 + 49 * least(greatest(0.6::DOUBLE * dur, 0), 86400) / dur END AS target
          FROM r)
    SELECT pattern, total_events, dur AS duration_s, total_events / greatest(dur, 0.001) AS actual_eps,
           round(target, 6) AS target_eps,
           round(total_events / greatest(dur, 0.001) * 100 / greatest(target, 0.001), 6) AS conformance_pct
    FROM r JOIN m USING (pattern)""",
)
def _(spark, d):
    runs = load.rate_conformance(tables.load_events(spark, d), _run_profiles())
    return runs.withColumn("target_eps", F.round("target_eps", 6)).withColumn(
        "conformance_pct", F.round("conformance_pct", 6)
    )


@query(
    "load_report",
    "SELECT count(DISTINCT event_type) AS total_patterns, count(*) AS total_events FROM events",
)
def _(spark, d):
    return load.load_report(load.rate_conformance(tables.load_events(spark, d), _run_profiles()))


@query(
    "throughput_points",
    f"""WITH f AS (SELECT event_type AS pattern, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY event_type) AS t FROM events),
    c AS (SELECT pattern, t // {H_US} * {H_US} + {H_US} AS t_us, count(*) AS n FROM f GROUP BY 1, 2)
    SELECT pattern, t_us, n / 3600.0::DOUBLE AS eps, CAST(sum(n) OVER (PARTITION BY pattern ORDER BY t_us) AS BIGINT) AS total FROM c""",
)
def _(spark, d):
    return load.throughput_points(tables.load_events(spark, d), HOUR)


@query(
    "load_run_report",
    f"""WITH f AS (SELECT event_type AS pattern, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY event_type) AS t FROM events)
    SELECT 'totals' AS section, 1::BIGINT AS count
    UNION ALL SELECT 'patterns', count(DISTINCT pattern) FROM f
    UNION ALL SELECT 'throughput_series', count(*) FROM (SELECT DISTINCT pattern, t // {H_US} FROM f)""",
)
def _(spark, d):
    report = load_run_report(tables.load_events(spark, d), _run_profiles(), "amount", HOUR)
    return report.groupBy("section").agg(F.count("body").alias("count"))


_SUMMARY = """count(ms) AS samples, round(avg(ms), 6) AS mean_ms, round(quantile_cont(ms, 0.5), 6) AS p50_ms,
  round(quantile_cont(ms, 0.95), 6) AS p95_ms, round(quantile_cont(ms, 0.99), 6) AS p99_ms,
  round(quantile_cont(ms, 0.999), 6) AS p999_ms, min(ms) AS min_ms, max(ms) AS max_ms"""


def _rounded(df: DataFrame) -> DataFrame:
    return reduce(lambda x, c: x.withColumn(c, F.round(c, 6)), ["mean_ms", *load.PERCENTILES], df)


@query("latency_summary", env_sql(f", l AS (SELECT (received_at_us - ts_us) / 1e3 AS ms FROM env) SELECT {_SUMMARY} FROM l"))
def _(spark, d):
    return _rounded(load.latency_summary(consumer.with_latency(env(spark, d)), "latency_ms"))


@query(
    "latency_summary_by_type",
    env_sql(f", l AS (SELECT event_type, (received_at_us - ts_us) / 1e3 AS ms FROM env) SELECT event_type, {_SUMMARY} FROM l GROUP BY 1"),
)
def _(spark, d):
    return _rounded(load.latency_summary(consumer.with_latency(env(spark, d)), "latency_ms", ["event_type"]))


# -- sources, payloads --------------------------------------------------------------------

@query(
    "parse_payload",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k "
    "FROM events WHERE event_type = 'purchase'",
)
def _(spark, d):
    parsed = payloads.parse_payload(env(spark, d), "purchase", "k int")
    return parsed.select("event_id", "data.k")


def _synthetic(spark, d):
    """One synthetic event per given one, at the same time."""
    return synth.events_from(tables.raw_events(spark, d).withColumn("_us", F.unix_micros("ts")), "event_id", "_us")


def _slot(text: str, slot: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {4 * slot + 1}, 4) AS INTEGER)"


def _whole(text: str, slot: int, low: int, high: int) -> str:
    return f"CAST({low} + floor(({_slot(text, slot)} + 0.5::DOUBLE) / 65536 * {high - low + 1}) AS INTEGER)"


_S, _P = "'0:' || event_id", "'0:' || event_id || ':payload'"
_NAMES = list(payloads.FACTORIES)
_SYNTH = f"""WITH t AS (
    SELECT event_id, epoch_us(ts) AS ts_us, {_NAMES}[{_slot(_S + " || ':type'", 0)} % {len(_NAMES)} + 1] AS event_type FROM events),
  y AS (SELECT *, CASE
      WHEN event_type IN ('PageView', 'Click', 'Purchase') THEN printf('user_%04d', {_whole(_P, 0, 1, 200)})
      WHEN event_type = 'SensorReading' THEN 'sensor-' || chr(65 + {_whole(_P, 0, 0, 3)}) || printf('%02d', {_whole(_P, 1, 1, 5)})
      ELSE printf('node-%02d', {_whole(_P, 0, 1, 8)}) || '.prod' END AS partition_key FROM t)"""


@query(
    "synth_events",
    f"""{_SYNTH} SELECT md5({_S} || ':id') AS event_id, event_type, ts_us, partition_key,
        CAST({hash_sql('partition_key')} % 4 AS INTEGER) AS "partition", event_id + 1 AS sequence_number FROM y""",
)
def _(spark, d):
    made = _synthetic(spark, d)
    return made.select("event_id", "event_type", "ts_us", "partition_key", "partition", "sequence_number")


@query(
    "synth_purchases",
    f"""{_SYNTH} SELECT md5({_S} || ':id') AS event_id, 'ord-' || substr(md5({_S} || ':token'), 9, 10) AS order_id,
        {payloads.PRODUCTS}[{_slot(_P, 3)} % 5 + 1] AS product_id, {_whole(_P, 1, 1, 5)} AS quantity,
        {_whole(_P, 2, 999, 29999)} / 100.0::DOUBLE AS unit_price_usd,
        {_whole(_P, 2, 999, 29999)} * {_whole(_P, 1, 1, 5)} / 100.0::DOUBLE AS total_usd
        FROM y WHERE event_type = 'Purchase'""",
)
def _(spark, d):
    parsed = payloads.parse_payload(_synthetic(spark, d), "Purchase")
    fields = ("order_id", "product_id", "quantity", "unit_price_usd", "total_usd")
    return parsed.select("event_id", *[f"data.{f}" for f in fields])


_ROUND_TRIP = env_sql(
    """SELECT event_id, event_type, ts_us, partition_key, "partition", sequence_number, producer_id, '1.0' AS schema_version,
       event_type AS topic, 4::INTEGER AS num_partitions, replace(payload, ' ', '') AS payload FROM base"""
)


def _trip(events: DataFrame) -> DataFrame:
    fields = ["event_id", "event_type", "ts_us", "partition_key", "partition", "sequence_number", "producer_id"]
    body = F.replace("payload", F.lit(" "), F.lit("")).alias("payload")
    return events.select(*fields, "metadata.schema_version", "metadata.topic", "metadata.num_partitions", body)


@query("event_log_round_trip", _ROUND_TRIP)
def _(spark, d):
    path = shared_dir(spark, "event-log")
    eventlog.write_event_log(tables.enveloped(spark, d), path)
    return _trip(eventlog.read_event_log(spark, path)[0])


@query("sse_round_trip", _ROUND_TRIP)
def _(spark, d):
    path = shared_dir(spark, "sse")
    eventlog.write_sse(tables.enveloped(spark, d), path)
    return _trip(eventlog.read_sse_capture(spark, path)[0])


# -- streams: several micro-batches, bounded --------------------------------------------------------

LATE = HOUR / 2


def _windows(size: int, by: str, src: str = "base") -> str:
    return f"""SELECT ts_us // {size} * {size} AS start_us, ts_us // {size} * {size} + {size} AS end_us, {by}, count(*) AS count
        FROM {src} GROUP BY 1, 2, 3"""


def _bounded_stream(spark, d):
    """Several micro-batches, late events among them, and an end that closes every window."""
    events = tables.event_stream(spark, d, late_s=LATE, closing_s=4 * DAY)
    return streams.with_watermark(events, HOUR)


@query("stream_tumbling", env_sql(_windows(D_US, "event_type")))
def _(spark, d):
    return streams.run_to_table(streams.stream_tumbling(_bounded_stream(spark, d), DAY, ["event_type"]), "tumbling")


@query(
    "stream_sliding",
    env_sql(
        f", x AS (SELECT (ts_us // {6 * H_US} - k.i) * {6 * H_US} AS s, ts_us FROM base, (SELECT unnest([0, 1]) AS i) k) "
        f"SELECT s AS start_us, s + {12 * H_US} AS end_us, count(*) AS count FROM x GROUP BY s"
    ),
)
def _(spark, d):
    return streams.run_to_table(streams.stream_sliding(_bounded_stream(spark, d), 12 * HOUR, 6 * HOUR), "sliding")


@query(
    "stream_sessions",
    env_sql(f", {_session_sql(6 * H_US, 'partition_key').replace('FROM env', 'FROM base')} SELECT * FROM win"),
)
def _(spark, d):
    sessions = streams.stream_sessions(_bounded_stream(spark, d), 6 * HOUR, ["partition_key"])
    return streams.run_to_table(sessions, "sessions")


@query("stream_dedup", env_sql("SELECT DISTINCT event_id, event_type FROM env"))
def _(spark, d):
    events = streams.with_watermark(tables.redelivered_stream(spark, d), HOUR)
    return streams.run_to_table(streams.stream_dedup(events).select("event_id", "event_type"), "dedup")


@query(
    "stream_metrics",
    life_sql(
        ", f AS (SELECT * FROM lifecycle WHERE kind = 'produced' OR attempt = 1) "
        + _windows(H_US, "kind", "f")
    ),
)
def _(spark, d):
    steps = streams.with_watermark(tables.lifecycle_stream(spark, d, late_s=LATE, closing_s=4 * DAY), HOUR)
    return streams.run_to_table(streams.stream_metrics(steps, HOUR), "metrics")


@query("stream_commits", env_sql('SELECT "partition", max(sequence_number) AS committed FROM base GROUP BY 1'))
def _(spark, d):
    commits = OffsetCommits(spark, shared_dir(spark, "commits"))
    streams.run_batches(tables.event_stream(spark, d, late_s=LATE), commits, shared_dir(spark, "commits-checkpoint"))
    return commits.table.latest()


@query(
    "stream_gap_alarms",
    env_sql(
        f""", s AS ({_STEPS.format(src='base')})
        SELECT producer_id, 'sequence_gap' AS kind, from_us AS start_us, ts_us AS end_us, sequence_number - from_seq - 1 AS missing
        FROM s WHERE sequence_number - from_seq > 1
        UNION ALL SELECT producer_id, 'rate_gap', from_us, ts_us, NULL FROM s WHERE ts_us - from_us > {H_US}"""
    ),
)
def _(spark, d):
    alarms = GapAlarms(spark, shared_dir(spark, "alarms"), HOUR)
    streams.run_batches(tables.event_stream(spark, d), alarms, shared_dir(spark, "alarms-checkpoint"))
    return alarms.alarms.all().drop("batch")


@query(
    "stream_route_retries",
    life_sql(
        """SELECT message_id, CASE WHEN first_ok IS NOT NULL THEN 'consumed' WHEN failed >= 3 THEN 'dlq' ELSE 'pending' END AS status,
           CAST(coalesce(first_ok - 1, failed) AS BIGINT) AS failures FROM routed"""
    ),
)
def _(spark, d):
    router = RetryRouter(spark, shared_dir(spark, "retries"))
    streams.run_batches(tables.attempt_stream(spark, d), router, shared_dir(spark, "retries-checkpoint"))
    return router.newest()


@query("stream_depths", life_sql(f", {_DEPTHS.format(s=H_US)} SELECT * FROM depth"))
def _(spark, d):
    steps = tables.whole_lifecycle_stream(spark, d, late_s=LATE, closing_s=4 * DAY)
    return streams.run_to_table(folds.stream_depths(streams.with_watermark(steps, HOUR), HOUR), "depths")


@query(
    "stream_session_line",
    env_sql(f", {_session_sql(H_US // 4).replace('FROM env', 'FROM base')} SELECT * FROM win"),
)
def _(spark, d):
    return streams.run_to_table(folds.stream_session_line(_bounded_stream(spark, d), HOUR / 4), "session-line")


@query(
    "stream_silences",
    env_sql(
        f""", {_session_sql(2 * H_US, 'producer_id').replace('FROM env', 'FROM base')}
        SELECT producer_id, end_us AS last_us, end_us + {2 * H_US} AS raised_us, count AS events FROM win"""
    ),
)
def _(spark, d):
    return streams.run_to_table(folds.stream_silences(_bounded_stream(spark, d), 2 * HOUR), "silences")


@query("stream_retries_apart", ORACLES["stream_route_retries"])
def _(spark, d):
    attempts = tables.attempts_apart(spark, d, apart_s=4 * DAY, late_s=LATE, closing_s=30 * DAY)
    return streams.run_to_table(folds.stream_retries(streams.with_watermark(attempts, HOUR), 5 * DAY), "retries")


# -- keyed scans with heavy groups cut into pieces, as they are from a million rows on ---------------

PIECE = {"rows_per_piece": 500}


@query("sessions_by_user_in_pieces", ORACLES["sessions_by_user"])
def _(spark, d):
    return windows.sessions(env(spark, d), 6 * HOUR, ["partition_key"], rows_per_piece=20)


@query("sequence_gaps_in_pieces", ORACLES["sequence_gaps"])
def _(spark, d):
    found = anomalies.sequence_gaps(env(spark, d), **PIECE)
    details = [F.col("details")[k].alias(k) for k in ("from_seq", "to_seq")]
    return found.select("kind", "severity", "start_us", "end_us", "description", *details)


@query("append_log_in_pieces", ORACLES["append_log"])
def _(spark, d):
    log = topiclog.append_log(tables.records(spark, d), tables.topics(spark, d), **PIECE)
    return log.select("topic", "partition", "offset", "key", "value", "record_id", "acks", "size_bytes")


@query("retention_in_pieces", ORACLES["retention"])
def _(spark, d):
    kept = topiclog.apply_retention(_stored_log(spark, d), 20_000, **PIECE)
    return kept.select("topic", "partition", "offset", "size_bytes")


@query("latency_summary_by_type_in_pieces", ORACLES["latency_summary_by_type"])
def _(spark, d):
    return _rounded(load.latency_summary(consumer.with_latency(env(spark, d)), "latency_ms", ["event_type"], **PIECE))


# -- topics created and removed, order of time ------------------------------------------------------

@query("time_order", env_sql("SELECT event_id, ts_us, row_number() OVER (ORDER BY ts_us, ordinal) AS place FROM base"))
def _(spark, d):
    # a total order asks for ranks; sorting alone has no result that could be compared
    rows = OrderedScan(tables.enveloped(spark, d).select("event_id", "ts_us", "ordinal"), [], ["ts_us", "ordinal"])
    return rows.rank("place").result().select("event_id", "ts_us", "place")


@query(
    "topic_table",
    log_sql("SELECT topic || '-new' AS topic, num_partitions FROM topics UNION ALL SELECT * FROM topics WHERE topic <> 'error'"),
)
def _(spark, d):
    known = tables.topics(spark, d)
    new = known.withColumn("topic", F.concat("topic", F.lit("-new")))
    return topiclog.drop_topics(topiclog.create_topics(known, new), known.where(F.col("topic") == "error").select("topic"))


# -- points in intervals, gaps and overlaps ---------------------------------------------------------

# an incident begins with an error and lasts as many seconds as its amount squared: seconds to days
_INCIDENTS = """
  incidents AS (SELECT event_id AS incident_id, "partition", ts_us AS start_us, ts_us + 1 + CAST(floor(amount * amount) AS BIGINT) * 1000000 AS end_us
                FROM base WHERE event_type = 'error')"""


def _incidents(spark, d):
    lasts = 1 + F.floor(F.col("amount") * F.col("amount")).cast("bigint") * 1_000_000
    errors = tables.enveloped(spark, d).where("event_type = 'error'")
    return errors.select(
        F.col("event_id").alias("incident_id"), "partition", F.col("ts_us").alias("start_us"), (F.col("ts_us") + lasts).alias("end_us")
    )


@query(
    "events_in_incidents",
    env_sql(
        f""", {_INCIDENTS}
        SELECT incident_id, i."partition", count(*) AS events, CAST(sum(sequence_number) AS BIGINT) AS numbers, max(ts_us) AS last_us
        FROM incidents i JOIN base b ON b."partition" = i."partition" AND ts_us >= start_us AND ts_us < end_us GROUP BY 1, 2"""
    ),
)
def _(spark, d):
    events = tables.enveloped(spark, d).select("partition", "ts_us", "sequence_number")
    wanted = intervals.Totals("events", "last_us", {"numbers": "sequence_number"})
    found = intervals.in_intervals(events, _incidents(spark, d), by=["partition"], totals=wanted)
    # an incident that was recorded twice has an interval each time
    return found.groupBy("incident_id", "partition").agg(
        F.sum("events").alias("events"), F.sum("numbers").alias("numbers"), F.max("last_us").alias("last_us")
    )


@query(
    "counts_in_incidents",
    env_sql(
        f""", {_INCIDENTS}
        SELECT incident_id, start_us, end_us, count(ts_us) AS count
        FROM incidents i LEFT JOIN base b ON ts_us >= start_us AND ts_us < end_us GROUP BY 1, 2, 3"""
    ),
)
def _(spark, d):
    return intervals.counts_in_intervals(tables.enveloped(spark, d).select("ts_us"), _incidents(spark, d).drop("partition"))


@query(
    "events_in_session_lines",
    env_sql(
        f""", {_session_sql(6 * H_US, 'partition_key').replace('FROM env', 'FROM base')}
        SELECT partition_key, start_us, end_us, count AS events FROM win"""
    ),
)
def _(spark, d):
    # a session line holds its last event, so as an interval it ends a microsecond later
    events = tables.enveloped(spark, d).select("partition_key", "ts_us", "ordinal")
    lines = windows.sessions(events, 6 * HOUR, ["partition_key"]).withColumn("_end", F.col("end_us") + 1).drop("count")
    held = intervals.counts_in_intervals(events, lines, end="_end", by=["partition_key"], **PIECE)
    return held.select("partition_key", "start_us", "end_us", F.col("count").alias("events"))


# of the segments of a partition's log, every seventh is lost and every fifth written ten records too far
_SEGMENTS = """, ends AS (SELECT topic, "partition", max("offset") + 1 AS hi FROM log GROUP BY 1, 2),
  cut AS (SELECT topic, "partition", hi, unnest(range(0, (hi + 19) // 20)) AS k FROM ends),
  segments AS (SELECT topic, "partition", k * 20 AS a, least(hi, k * 20 + 20) + CASE WHEN k % 5 = 2 THEN 10 ELSE 0 END AS z FROM cut WHERE k % 7 <> 3),
  marked AS (SELECT * FROM segments UNION ALL SELECT topic, "partition", 0, 0 FROM ends UNION ALL SELECT topic, "partition", hi, hi FROM ends),
  swept AS (SELECT *, max(z) OVER (PARTITION BY topic, "partition" ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM marked)"""


@query(
    "segment_faults",
    log_sql(
        f"""{_SEGMENTS} SELECT topic, "partition", 'gap' AS kind, far AS "from", a AS "to" FROM swept WHERE a > far
        UNION ALL SELECT topic, "partition", 'overlap', a, least(z, far) FROM swept WHERE a < least(z, far)"""
    ),
)
def _(spark, d):
    ends = _log(spark, d).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("hi"))
    k = F.col("k")
    cut = ends.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("hi") - 1, F.lit(20)))))
    end = F.least("hi", k * 20 + 20) + F.when(k % 5 == 2, 10).otherwise(0)
    segments = cut.where(k % 7 != 3).select("topic", "partition", (k * 20).alias("start"), end.alias("end"))
    bounds = ends.withColumn("lo", F.lit(0).cast("bigint"))
    return intervals.faults(segments, ["topic", "partition"], bounds=bounds, rows_per_piece=50)


@query(
    "assignment_faults",
    log_sql(
        """, expected AS (SELECT t.topic, CAST(p.i AS INTEGER) AS "partition" FROM topics t JOIN (SELECT range AS i FROM range(0, 64)) p ON p.i < t.num_partitions),
        held AS (SELECT topic, "partition", member_id FROM assigned_rr WHERE member_id <> 'consumer-1' OR "partition" <> 1
                 UNION SELECT topic, "partition", 'extra' FROM assigned_rr WHERE "partition" = 0
                 UNION SELECT topic, 99, 'extra' FROM topics),
        parts AS (SELECT DISTINCT topic, "partition" FROM held)
        SELECT 'unassigned' AS kind, * FROM (SELECT * FROM expected EXCEPT SELECT * FROM parts)
        UNION ALL SELECT 'unknown', * FROM (SELECT * FROM parts EXCEPT SELECT * FROM expected)
        UNION ALL SELECT 'shared', topic, "partition" FROM held GROUP BY topic, "partition" HAVING count(DISTINCT member_id) > 1"""
    ),
)
def _(spark, d):
    # an assignment with faults: one member's partition 1 is lost, partition 0 is given twice, and one is made up
    known, given = tables.topics(spark, d), _assigned(spark, d, "roundrobin").select("topic", "partition", "member_id")
    expected = known.select("topic", F.explode(F.sequence(F.lit(0), F.col("num_partitions") - 1)).alias("partition"))
    extra = F.lit("extra").alias("member_id")
    held = given.where("member_id <> 'consumer-1' OR partition <> 1")
    held = held.unionByName(given.where("partition = 0").select("topic", "partition", extra))
    held = held.unionByName(known.select("topic", F.lit(99).alias("partition"), extra))
    return intervals.set_faults(held, expected)


# -- stored sketches, ids of earlier runs, checksums, counts on the way -----------------------------------

_HALF = "(SELECT min(ts_us) // {w} * {w} + 60 * {w} FROM env)"


@query(
    "latency_sketches",
    env_sql(
        f""", l AS (SELECT event_type, ts_us, (received_at_us - ts_us) / 1e3 AS v FROM env),
        p AS (SELECT unnest(['p50_ms', 'p95_ms', 'p99_ms', 'p999_ms']) AS percentile),
        s AS (SELECT 'all' AS span, * FROM l UNION ALL SELECT 'first', * FROM l WHERE ts_us < {_HALF.format(w=6 * H_US)})
        SELECT span, event_type, percentile, count(*) AS samples, min(v) AS min_ms, max(v) AS max_ms, TRUE AS within
        FROM s, p GROUP BY 1, 2, 3"""
    ),
)
def _(spark, d):
    samples = consumer.with_latency(env(spark, d)).select("event_type", "ts_us", "latency_ms")
    stored = written(sketches.sketch_windows(samples, "latency_ms", 6 * HOUR, ["event_type"]), "sketches")
    first = windows.bounds(samples)[0] // (6 * H_US) * (6 * H_US) + 60 * 6 * H_US
    names = list(load.PERCENTILES)
    ask = lambda span, to_us: sketches.summary(
        sketches.merged_sketches(stored, ["event_type"], to_us=to_us), ["event_type"]
    ).select(
        F.lit(span).alias("span"), F.lit(to_us).cast("bigint").alias("to_us"), F.col("event_type").alias("of"), "samples", "min_ms", "max_ms",
        F.inline(F.array(*[
            F.struct(F.lit(n).alias("percentile"), F.lit(load.PERCENTILES[n] / 100).alias("rank"), F.col(n).alias("value")) for n in names
        ])),
    )
    asked = ask("all", None).unionByName(ask("first", first))
    # the exact ranks that each answer may claim, against the rank asked for; three times the error of 99 in 100
    held = samples.join(F.broadcast(asked), (F.col("event_type") == F.col("of")) & F.coalesce(F.col("ts_us") < F.col("to_us"), F.lit(True)))
    ranks = held.groupBy("span", "event_type", "percentile", "rank", "samples", "min_ms", "max_ms").agg(
        (F.count_if(F.col("latency_ms") < F.col("value")) / F.col("samples")).alias("below"),
        (F.count_if(F.col("latency_ms") <= F.col("value")) / F.col("samples")).alias("upto"),
    )
    error = 3 * sketches.RANK_ERROR[sketches.SKETCH_K]
    within = (F.col("below") - error <= F.col("rank")) & (F.col("rank") <= F.col("upto") + error)
    return ranks.select("span", "event_type", "percentile", "samples", "min_ms", "max_ms", within.alias("within"))


_SPLIT = "(SELECT min(ts_us) + (max(ts_us) - min(ts_us)) * 3 // 5 FROM base)"


@query(
    "first_seen_over_runs",
    env_sql(
        f"SELECT event_id, min(CASE WHEN ts_us < {_SPLIT} THEN 0 ELSE 1 END) AS run, min(ordinal) AS ordinal FROM base GROUP BY event_id"
    ),
)
def _(spark, d):
    # the first run sees three fifths of the time; the second one reads everything again
    events = tables.enveloped(spark, d)
    lo, hi, _ = windows.bounds(events)
    path = shared_dir(spark, "id-index")
    runs = [events.where(F.col("ts_us") < lo + (hi - lo) * 3 // 5), env(spark, d)]
    found = [
        idindex.IdIndex(spark, path, buckets=8, ids_per_bucket=4_000).first_seen(rows.select("event_id", "ordinal"), n)
        .select("event_id", F.lit(n).alias("run"), "ordinal") for n, rows in enumerate(runs)
    ]
    return found[0].unionByName(found[1])


@query("stream_first_seen", env_sql("SELECT event_id, min(ts_us) AS ts_us FROM env GROUP BY 1"))
def _(spark, d):
    # without a watermark: an id is remembered for good
    out = shared_dir(spark, "first-seen")
    seen = idindex.FirstSeen(idindex.IdIndex(spark, shared_dir(spark, "id-index"), buckets=8), out)
    arrivals = tables.redelivered_stream(spark, d).select("event_id", "ts_us", F.col("ts_us").alias("ordinal"))
    streams.run_batches(arrivals, seen, shared_dir(spark, "first-seen-checkpoint"))
    return spark.read.schema("event_id string, ts_us bigint").parquet(out).select("event_id", "ts_us")


@query(
    "content_checksums",
    env_sql(
        """, c AS (SELECT event_id, '{"a":{"list":[1,{"x":"é \\"","y":null}],"z":true},"k":' || replace(payload, ' ', '') || ',"kind":"' || event_type || '"}' AS body FROM base)
        SELECT event_id, CAST('0x' || substr(md5(body), 1, 15) AS BIGINT) AS checksum, TRUE AS same FROM c"""
    ),
)
def _(spark, d):
    # the same content, with its keys in two orders and with other spaces
    rows = tables.enveloped(spark, d)
    kind = F.concat(F.lit('"kind": "'), "event_type", F.lit('"'))
    one = F.concat(F.lit('{"k": '), "payload", F.lit(', "a": {"z": true, "list": [1, {"y": null, "x": "é \\""}]}, '), kind, F.lit("}"))
    two = F.concat(F.lit("{"), kind, F.lit(',"a" : {"list":[ 1,{"x":"\\u00e9 \\"","y":null}],"z":true},\n"k":'), "payload", F.lit("}"))
    sums = [topiclog.content_checksum(body) for body in (one, two)]
    return rows.select("event_id", sums[0].alias("checksum"), (sums[0] == sums[1]).alias("same"))


@query(
    "stream_progress",
    env_sql(
        f""", s AS (SELECT min(ts_us) AS lo, greatest(1, (max(ts_us) - min(ts_us) + 5) // 5) AS width FROM base),
        b AS (SELECT *, least(4, (ts_us - lo + CASE WHEN sequence_number % 10 = 0 THEN {H_US // 2} ELSE 0 END) // width) AS batch FROM base, s)
        SELECT batch, count(*) AS rows, count(*) AS received, count(*) FILTER (WHERE NOT ({IN_TYPES})) AS filtered_out,
               count(*) FILTER (WHERE {IN_TYPES}) AS processed, 0 AS late FROM b GROUP BY 1"""
    ),
)
def _(spark, d):
    with progress.ProgressRows(spark) as seen:
        rows = streams.with_watermark(tables.event_stream(spark, d, late_s=LATE), HOUR)
        streams.run_to_table(streams.stream_tumbling(progress.counted_filter(rows, TYPES, PARTITIONS), DAY), "progress")
    return seen.table().withColumn("late", F.col("late").cast("int"))


@query(
    "observed_totals",
    env_sql(f"SELECT count(*) AS received, count(*) FILTER (WHERE NOT ({IN_TYPES})) AS filtered_out, count(*) FILTER (WHERE {IN_TYPES}) AS processed, count(DISTINCT event_id) FILTER (WHERE {IN_TYPES}) AS ids FROM env"),
)
def _(spark, d):
    # one job gives the rows and the counts of what was read for them
    counts = Observation("consumer")
    ids = progress.counted_filter(env(spark, d), TYPES, PARTITIONS, counts).select("event_id").distinct()
    n = written(ids, "ids").count()
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in {**counts.get, "ids": n}.items()])


@query(
    "ordered_stats",
    env_sql(
        f""", {_CONSUMED}, k AS (
          SELECT 'by_type' AS metric, event_type AS key, count(*) AS n FROM c WHERE processed GROUP BY 2
          UNION ALL SELECT 'by_partition', CAST("partition" AS VARCHAR), count(*) FROM c WHERE processed GROUP BY 2)
        SELECT metric, key, CAST(n AS DOUBLE) AS value,
               CAST(row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'by_type' THEN -n ELSE CAST(key AS BIGINT) END, key) AS INTEGER) AS place
        FROM k""".replace("CAST(key AS BIGINT)", "TRY_CAST(key AS BIGINT)")
    ),
)
def _(spark, d):
    return consumer.ordered_stats(consumer.consumer_stats(_consumed(spark, d))).where("metric LIKE 'by%'")


# -- texts and rounded numbers of the reports ------------------------------------------------------------

def _two(x: str) -> str:
    """A number to two decimals by its exact value."""
    return f"CAST(printf('%.2f', {x}) AS DOUBLE)"


_RATE_ROWS = f"""
  SELECT CASE WHEN eps > mean THEN 'rate_spike' ELSE 'rate_gap' END AS kind, CASE WHEN z > {{t}} * 2 THEN 'high' ELSE 'medium' END AS severity,
         start_us, end_us, printf('Rate %.1f eps deviates %.1fσ from mean %.1f eps', eps, z, mean) AS description,
         {_two('eps')} AS rate_eps, {_two('mean')} AS mean_eps, {_two('z')} AS z_score
  FROM (SELECT *, abs(eps - mean) / std AS z FROM (SELECT *, {EPS} AS eps FROM win WHERE count > 0),
        (SELECT count(*) AS n, avg({EPS}) AS mean, stddev_pop({EPS}) AS std FROM win WHERE count > 0) WHERE n >= 3 AND std >= 0.001) WHERE z > {{t}}"""


@query("rate_descriptions", env_sql(f", {_tumbling_sql(60_000_000)} {_RATE_ROWS.format(t=2.0)}"))
def _(spark, d):
    found = anomalies.rate_anomalies(windows.tumbling(env(spark, d), 60), 2.0)
    details = [F.col("details")[k].cast("double").alias(k) for k in ("rate_eps", "mean_eps", "z_score")]
    return found.select("kind", "severity", "start_us", "end_us", "description", *details)


_GAP_ROWS = f"""
  SELECT prev_us AS start_us, ts_us AS end_us, printf('Event gap of %.1fs between events', (ts_us - prev_us) / 1e6) AS description,
         {_two('(ts_us - prev_us) / 1e6')} AS gap_s, prev_event
  FROM (SELECT ts_us, lag(ts_us) OVER o AS prev_us, lag(event_id) OVER o AS prev_event FROM env WINDOW o AS (ORDER BY ts_us, ordinal))
  WHERE ts_us - prev_us > {{gap}}"""


@query("gap_descriptions", env_sql(_GAP_ROWS.format(gap=300_000_000)))
def _(spark, d):
    found = anomalies.time_gaps(env(spark, d), 300)
    details = [F.col("details")["gap_s"].cast("double").alias("gap_s"), F.col("details")["prev_event"].alias("prev_event")]
    return found.select("start_us", "end_us", "description", *details)


def _report_section(spark, d, section: str, schema: str) -> DataFrame:
    """A section of the analysis report, read back from its JSON."""
    report = analysis_report(env(spark, d), window_size_s=HOUR, spike_threshold=2.0, gap_s=1000)
    return report.where(F.col("section") == section).select(F.from_json("body", schema).alias("r")).select("r.*")


@query(
    "report_summary",
    env_sql(
        f"""{_ALL_ANOMALIES}
        SELECT count(*) AS total_events, {_two('(max(ts_us) - min(ts_us)) / 1e6')} AS duration_s,
               {_two('count(*) / greatest((max(ts_us) - min(ts_us)) / 1e6, 0.001)')} AS overall_throughput_eps,
               (SELECT count(*) FROM win) AS num_windows, (SELECT count(*) FROM found) AS num_anomalies,
               'tumbling' AS window_type, CAST({HOUR} AS DOUBLE) AS window_size_s FROM env"""
    ),
)
def _(spark, d):
    return _report_section(
        spark, d, "summary",
        "total_events bigint, duration_s double, overall_throughput_eps double, num_windows bigint, num_anomalies bigint, "
        "window_type string, window_size_s double",
    )


@query(
    "report_throughput",
    env_sql(f", {_tumbling_sql(H_US)} SELECT {_two('start_us / 1e6')} AS t, {_two(EPS)} AS eps, count FROM win"),
)
def _(spark, d):
    return _report_section(spark, d, "throughput_series", "t double, eps double, count bigint")


@query(
    "report_anomalies",
    env_sql(
        f""", {_tumbling_sql(H_US)}, f AS (
        SELECT kind, severity, description, start_us, end_us FROM ({_RATE_ROWS.format(t=2.0)})
        UNION ALL SELECT 'rate_gap', CASE WHEN end_us - start_us < 3000000000 THEN 'medium' ELSE 'high' END, description, start_us, end_us
        FROM ({_GAP_ROWS.format(gap=1_000_000_000)})
        UNION ALL SELECT 'duplicate', 'high', 'Duplicate event_id detected: ' || event_id, ts_us, ts_us FROM ({_DUPES}) WHERE sighting > 1
        UNION ALL SELECT 'sequence_gap', 'medium', 'Sequence gap of ' || CAST(sequence_number - from_seq - 1 AS VARCHAR) || ' in producer ' || producer_id, from_us, ts_us
        FROM ({_STEPS.format(src='env')}) WHERE sequence_number - from_seq > 1)
        SELECT kind, severity, description, {_two('start_us / 1e6')} AS window_start, {_two('end_us / 1e6')} AS window_end FROM f"""
    ),
)
def _(spark, d):
    return _report_section(
        spark, d, "anomalies", "kind string, severity string, description string, window_start double, window_end double"
    )


_AMOUNTS = _SUMMARY.replace("(ms", "(value")


@query(
    "load_report_patterns",
    f"""WITH c AS ({ORACLES["rate_conformance"]}), l AS (SELECT event_type AS pattern, {_AMOUNTS} FROM events GROUP BY 1)
    SELECT pattern, total_events, round(duration_s, 6) AS duration_s, round(actual_eps, 6) AS actual_eps, target_eps, conformance_pct,
           samples, mean_ms, p50_ms, p95_ms, p99_ms, p999_ms, min_ms, max_ms
    FROM c JOIN l USING (pattern)""",
)
def _(spark, d):
    report = load_run_report(tables.load_events(spark, d), _run_profiles(), "amount", HOUR)
    numbers = ["mean_ms", *load.PERCENTILES, "min_ms", "max_ms"]
    latency = ", ".join(["samples: bigint", *[f"{c}: double" for c in numbers]])
    rates = ["duration_s", "actual_eps", "target_eps", "conformance_pct"]
    schema = "pattern string, total_events bigint, " + ", ".join(f"{c} double" for c in rates) + f", latency struct<{latency}>"
    rows = report.where("section = 'patterns'").select(F.from_json("body", schema).alias("r")).select("r.*")
    return rows.select(
        "pattern", "total_events", *[F.round(c, 6).alias(c) for c in rates], "latency.samples",
        *[F.round(f"latency.{c}", 6).alias(c) if c[1] != "i" and c != "max_ms" else F.col(f"latency.{c}") for c in numbers],
    )


@query(
    "load_report_series",
    f"""WITH f AS (SELECT event_type AS pattern, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY event_type) AS t FROM events),
    n AS (SELECT pattern, t // {H_US} AS k, count(*) AS n FROM f GROUP BY 1, 2)
    SELECT pattern, (k + 1) * {H_US} AS t_us, round(n / {HOUR}, 6) AS eps, CAST(sum(n) OVER (PARTITION BY pattern ORDER BY k) AS BIGINT) AS total FROM n""",
)
def _(spark, d):
    report = load_run_report(tables.load_events(spark, d), _run_profiles(), "amount", HOUR)
    rows = report.where("section = 'throughput_series'").select(F.from_json("body", "pattern string, t_us bigint, eps double, total bigint").alias("r"))
    return rows.select("r.pattern", "r.t_us", F.round("r.eps", 6).alias("eps"), "r.total")


@query(
    "stream_gap_alarms_late",
    env_sql(
        f""", w AS (SELECT min(ts_us) AS lo, greatest(1, (max(ts_us) - min(ts_us) + 5) // 5) AS width FROM base),
        b AS (SELECT *, least(4, (ts_us - lo + CASE WHEN sequence_number % 10 = 0 THEN {round(LATE * 1e6)} ELSE 0 END) // width) AS batch FROM base, w),
        seen AS (SELECT *, max(sequence_number) OVER (PARTITION BY producer_id ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM b),
        fresh AS (SELECT * FROM seen WHERE upto IS NULL OR sequence_number > upto),
        s AS ({_STEPS.format(src='fresh')})
        SELECT producer_id, 'sequence_gap' AS kind, from_us AS start_us, ts_us AS end_us, sequence_number - from_seq - 1 AS missing
        FROM s WHERE sequence_number - from_seq > 1
        UNION ALL SELECT producer_id, 'rate_gap', from_us, ts_us, NULL FROM s WHERE ts_us - from_us > {H_US}"""
    ),
)
def _(spark, d):
    # events that come a batch late raise no alarm, and those before them report the gap they left
    alarms = GapAlarms(spark, shared_dir(spark, "alarms"), HOUR)
    streams.run_batches(tables.event_stream(spark, d, late_s=LATE), alarms, shared_dir(spark, "alarms-checkpoint"))
    return alarms.alarms.all().drop("batch")
