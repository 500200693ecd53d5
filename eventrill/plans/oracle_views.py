"""The derived tables of ``sources.tables`` once more, as SQL common table expressions."""

from __future__ import annotations

# key hash: the first 32 bits of the MD5
def hash_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


BASE = """
base AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, epoch_us(ts) AS ts_us,
         printf('user_%04d', user_id) AS partition_key,
         CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id + 1 AS sequence_number,
         'producer-' || CAST(user_id % 10 AS VARCHAR) AS producer_id,
         props AS payload, value AS amount,
         epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) - 5000 AS received_at_us,
         event_id * 2 AS ordinal, user_id
  FROM events)"""

ENV = BASE + """,
env AS (
  SELECT * FROM base
  UNION ALL
  SELECT event_id, event_type, ts_us + 1000000, partition_key, "partition", sequence_number,
         producer_id, payload, amount, received_at_us, ordinal + 1, user_id
  FROM base WHERE event_type = 'error')"""

TOPICS = """,
topics AS (
  SELECT event_type AS topic, CAST(max(user_id % 4) + 1 AS INTEGER) AS num_partitions FROM base GROUP BY 1),
members AS (
  SELECT DISTINCT event_type AS topic, 'consumer-' || CAST(user_id % 3 AS VARCHAR) AS member_id FROM base)"""

RECORDS = ENV + TOPICS + """,
records AS (
  SELECT event_type AS topic, CASE WHEN amount < 50 THEN partition_key END AS key, payload AS value,
         event_id || '-' || CAST(ordinal AS VARCHAR) AS record_id,
         CASE WHEN amount < 5 THEN 'none' ELSE 'leader' END AS acks, ordinal
  FROM env)"""

LOG = RECORDS + f""",
placed AS (
  SELECT r.*, CASE WHEN key IS NULL THEN 0
                   ELSE CAST({hash_sql('key')} % num_partitions AS INTEGER) END AS "partition"
  FROM records r JOIN topics USING (topic)),
log AS (
  SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY ordinal) - 1 AS "offset",
         CAST(length(value) + length(coalesce(key, '')) + 64 AS BIGINT) AS size_bytes
  FROM placed),
commits AS (
  SELECT 'analytics' AS group_id, topic, "partition", count(*) FILTER (WHERE acks = 'none') - 1 AS committed
  FROM log WHERE topic <> 'signup' GROUP BY topic, "partition")"""

ASSIGNED = """,
ranked AS (
  SELECT topic, member_id, row_number() OVER (PARTITION BY topic ORDER BY member_id) - 1 AS m,
         count(*) OVER (PARTITION BY topic) AS n
  FROM members),
spread AS (
  SELECT t.topic, CAST(p.i AS INTEGER) AS "partition", t.num_partitions,
         (SELECT count(*) FROM members x WHERE x.topic = t.topic) AS n
  FROM topics t JOIN (SELECT range AS i FROM range(0, 64)) p ON p.i < t.num_partitions),
assigned_range AS (
  SELECT s.topic, s."partition", r.member_id FROM spread s JOIN ranked r
    ON r.topic = s.topic AND r.m = least(s."partition" // greatest(1, s.num_partitions // s.n), s.n - 1)),
assigned_rr AS (
  SELECT s.topic, s."partition", r.member_id FROM spread s JOIN ranked r
    ON r.topic = s.topic AND r.m = s."partition" % s.n)"""

ATTEMPTS = f""",
attempts AS (
  SELECT event_id AS message_id, 'consumer-' || CAST("partition" % 3 AS VARCHAR) AS consumer_id,
         event_type AS topic, "partition", CAST(k.a AS INTEGER) AS attempt,
         {hash_sql("event_id || ':' || CAST(k.a AS VARCHAR)")} % 100 >= 30 AS ok,
         ts_us + k.a * 1000000 AS ts_us
  FROM base, (SELECT unnest([1, 2, 3]) AS a) k),
routed AS (
  SELECT message_id, min(attempt) FILTER (WHERE ok) AS first_ok, count(*) FILTER (WHERE NOT ok) AS failed
  FROM attempts GROUP BY message_id),
lifecycle AS (
  SELECT ts_us, 'produced' AS kind, event_id AS message_id, producer_id, NULL AS consumer_id,
         event_type AS topic, "partition", NULL AS attempt
  FROM base
  UNION ALL
  SELECT a.ts_us, CASE WHEN ok THEN 'consumed' ELSE 'retry' END, message_id, NULL, consumer_id,
         topic, "partition", attempt
  FROM attempts a JOIN routed r USING (message_id) WHERE r.first_ok IS NULL OR a.attempt <= r.first_ok
  UNION ALL
  SELECT a.ts_us + 1000000, 'dlq', message_id, NULL, consumer_id, topic, "partition", attempt
  FROM attempts a JOIN routed r USING (message_id) WHERE r.first_ok IS NULL AND a.attempt = 3),
deltas AS (
  SELECT *, CASE WHEN kind = 'produced' THEN 1 WHEN kind IN ('consumed', 'retry') AND attempt = 1 THEN -1 ELSE 0 END AS q,
         CASE WHEN kind = 'retry' AND attempt = 1 THEN 1
              WHEN kind = 'dlq' OR (kind = 'consumed' AND attempt > 1) THEN -1 ELSE 0 END AS r,
         CASE WHEN kind = 'dlq' THEN 1 ELSE 0 END AS d
  FROM lifecycle)"""


def env_sql(body: str) -> str:
    return f"WITH {ENV.strip()} {body}"


def log_sql(body: str) -> str:
    return f"WITH {LOG.strip()}{ASSIGNED} {body}"


def life_sql(body: str) -> str:
    return f"WITH {BASE.strip()}{ATTEMPTS} {body}"


def life_log_sql(body: str) -> str:
    return f"WITH {BASE.strip()}{TOPICS}{ASSIGNED}{ATTEMPTS} {body}"
