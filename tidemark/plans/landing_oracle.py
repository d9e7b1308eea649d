"""DuckDB SQL of the queries over landing tables and running states."""

from __future__ import annotations

from tidemark.plans.oracle import _LANDING as LANDING_COLUMNS
from tidemark.plans.oracle import BATCH_TIME

_WEEK = "least(day(ts) // 7, 4)"

#: the message is built as text and parsed as JSON; a message without lines gives no row
LAND_THEN_UNPACK = """
WITH whole AS (
  SELECT event_id, event_type, '{"case":{"id":' || json_extract_string(props, '$.k') || '},"kind":"' || event_type ||
         '","amount":' || user_id || ',"lines":[' || CASE event_id % 3 WHEN 0 THEN ''
           WHEN 1 THEN '{"code":"a","n":1}'
           ELSE '{"code":"a","n":1},{"n":2},{"code":"b","n":' || event_id % 7 || '}' END || ']}' AS doc
  FROM events
), message AS (
  SELECT event_id, event_type, CASE WHEN event_id % 11 = 3 THEN left(doc, length(doc) - 2)
    WHEN event_id % 13 = 5 THEN replace(doc, '"amount":', '"amount":"much","was":')
    WHEN event_id % 17 = 6 THEN replace(doc, '"id":', '"number":')
    WHEN event_id % 19 = 7 THEN replace(doc, '"lines":', '"rows":')
    WHEN event_id % 23 = 8 THEN NULL ELSE doc END AS doc
  FROM whole
), judged AS (
  SELECT *, CASE WHEN doc IS NULL THEN 'no message' WHEN NOT json_valid(doc) THEN 'does not fit the schema'
    WHEN json_type(doc, '$.amount') NOT IN ('UBIGINT', 'BIGINT') THEN 'does not fit the schema'
    WHEN json_type(doc, '$.lines') IS NULL THEN 'missing lines' END AS bad FROM message
), line AS (
  SELECT *, unnest(range(CAST(json_array_length(doc, '$.lines') AS BIGINT))) AS position FROM judged WHERE bad IS NULL
), typed AS (
  SELECT event_type, event_id, position, doc, CAST(json_extract_string(doc, '$.case.id') AS BIGINT) AS case_id,
         json_extract_string(doc, '$.kind') AS kind, CAST(json_extract_string(doc, '$.amount') AS BIGINT) AS amount,
         json_extract_string(doc, '$.lines[' || position || '].code') AS code,
         CAST(json_extract_string(doc, '$.lines[' || position || '].n') AS INTEGER) AS n
  FROM line
)
SELECT event_type AS kafka_topic, event_id AS kafka_offset, CAST(position AS INTEGER) AS position,
       case_id, kind, amount, code, n, NULL AS melding, NULL AS reason
FROM typed WHERE case_id IS NOT NULL AND code IS NOT NULL
UNION ALL
SELECT event_type, event_id, CAST(position AS INTEGER), NULL, NULL, NULL, NULL, NULL, doc,
       CASE WHEN case_id IS NULL THEN 'missing case_id' ELSE 'missing code' END
FROM typed WHERE case_id IS NULL OR code IS NULL
UNION ALL
SELECT event_type, event_id, NULL, NULL, NULL, NULL, NULL, NULL, doc, bad FROM judged WHERE bad IS NOT NULL
"""

_REPLAYED = f"""
SELECT {{spec}} AS spec, {LANDING_COLUMNS}, {BATCH_TIME} AS lastet_dato
FROM (SELECT * REPLACE ({{offset}} AS event_id) FROM events
      WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00')
"""
REPLAY_KEYLESS = (_REPLAYED.format(spec="'keyless'", offset="event_id") + "UNION ALL"
                  + _REPLAYED.format(spec="'keyed'", offset="CASE WHEN event_id % 50 <> 0 THEN event_id END"))

LATE_DUPLICATES = f"""
SELECT props AS melding, event_type AS kafka_topic, event_id AS kafka_offset,
       CAST(user_id % 4 AS INTEGER) AS kafka_partition, {BATCH_TIME} AS lastet_dato
FROM (SELECT *, {_WEEK} AS file FROM events)
WHERE (file = 4 OR file = 3 AND event_id % 2 = 0 OR file = 1 AND event_id % 3 = 0)
  AND (file = 4 OR event_id % 7 = 2)
"""

GAP_STATE_MERGE = """
SELECT event_type, event_id AS gap_from, nxt AS gap_to, nxt - event_id - 1 AS missing, ts FROM (
  SELECT event_type, event_id, ts, LEAD(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS nxt
  FROM events WHERE event_id % 11 <> 3)
WHERE nxt - event_id > 1 AND event_id > 1000
"""

DISTINCT_SEVEN_DAYS = """
SELECT event_type, COUNT(DISTINCT user_id) AS n_users FROM events
WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY event_type
"""

VALIDITY_JOIN_ROWS = """
SELECT event_id, person, decision_day, o_orderkey, off_id, gyldig_fra_dato, gyldig_til_dato
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS person,
             DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER) AS decision_day FROM events)
JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 7 ELSE o_custkey END AS off_id,
             CAST(o_orderdate AS DATE) AS gyldig_fra_dato,
             CASE WHEN o_orderkey % 500 = 1 THEN DATE '9999-12-31'
                  ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) END AS gyldig_til_dato FROM orders)
ON person = off_id AND decision_day BETWEEN gyldig_fra_dato AND gyldig_til_dato
"""

_SLICES = "(VALUES (TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-10'), (TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-15')) s(a, b)"

LATE_MESSAGES = f"""
SELECT event_type AS kafka_topic, event_id + 1000000 AS kafka_offset, epoch_us(ts) // 1000 AS kafka_timestamp,
       CAST(user_id % 4 AS INTEGER) AS kafka_partition, epoch_us(a) // 1000 AS start_ms, epoch_us(b) // 1000 AS stop_ms
FROM events JOIN {_SLICES} ON ts >= a AND ts < b
WHERE event_id % 9 = 4 AND event_type IN ('click', 'view', 'purchase')
"""

BINARY_PAYLOAD = """
SELECT event_type AS kafka_topic, event_id AS kafka_offset, 'binary' AS payload_type, hex(encode(props)) AS payload FROM events
"""

ORACLE_SQL: dict[str, str] = {
    "land_then_unpack": LAND_THEN_UNPACK,
    "replay_keyless": REPLAY_KEYLESS,
    "distinct_seven_days": DISTINCT_SEVEN_DAYS,
    "validity_join_rows": VALIDITY_JOIN_ROWS,
    "late_messages": LATE_MESSAGES,
    "binary_payload": BINARY_PAYLOAD,
    "gap_state_merge": GAP_STATE_MERGE,
    "late_duplicates": LATE_DUPLICATES,
}
