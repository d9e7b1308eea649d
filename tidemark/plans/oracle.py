"""DuckDB SQL for each registered query (the correctness oracle).

Written straight from the reference semantics (LEAD windows, NOT IN, UNPIVOT,
LEFT JOIN ... IS NULL), not from the Spark plans, so a match checks the
scale-out rewrites too.  Column names equal the Spark result's.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
BATCH_TIME = "TIMESTAMP '2024-01-31 00:00:00'"
REPLAY_TIME = "TIMESTAMP '2024-01-31 01:00:00'"


def _jv(doc: str, path: str) -> str:
    """JSON_VALUE: scalar text, NULL for objects and arrays."""
    return (f"CASE WHEN json_type({doc}, '{path}') IN ('OBJECT', 'ARRAY') THEN NULL "
            f"ELSE json_extract_string({doc}, '{path}') END")


def _ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def _oslo(ms: str) -> str:
    return f"timezone('Europe/Oslo', timezone('UTC', make_timestamp({ms} * 1000)))"


def _belgrade_day(ts: str) -> str:
    return f"CAST(timezone('Europe/Belgrade', timezone('UTC', {ts})) AS DATE)"


def _gap_sql(select_from: str, offset: str, by: str, outer: str, min_gap: int = 1,
             extra_cols: str = "") -> str:
    return f"""
SELECT COUNT(*) AS gap_count FROM (
  SELECT {offset}{extra_cols}, LEAD({offset}) OVER (PARTITION BY {by} ORDER BY {offset}) AS nxt
  FROM {select_from}
) t
WHERE nxt - {offset} > {min_gap}{outer}
"""


GAP_COUNT = _gap_sql("events", "event_id", "event_type", " AND event_id > 1000")
GAP_COUNT_TYPED = _gap_sql("events WHERE event_type = 'click'", "event_id", "event_type",
                           " AND event_id > 1000")
GAP_COUNT_SINCE = _gap_sql("events", "event_id", "event_type",
                           " AND ts > TIMESTAMP '2024-01-15 00:00:00'", extra_cols=", ts")
GAP_COUNT_PARTITIONED = _gap_sql(
    "lineitem WHERE l_shipdate > TIMESTAMP '1996-04-16 00:00:00'", "l_orderkey",
    "l_suppkey, l_linenumber", "", min_gap=900)

GAP_LIST = """
SELECT event_type, event_id AS gap_from, nxt AS gap_to, nxt - event_id - 1 AS missing FROM (
  SELECT event_type, event_id, LEAD(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS nxt
  FROM events
) t WHERE nxt - event_id > 1
"""

RECENT_COUNT = f"""
SELECT COUNT(*) FILTER (WHERE ts >= {AS_OF} - INTERVAL 1 DAY) AS n_1d,
       COUNT(*) FILTER (WHERE ts >= {AS_OF} - INTERVAL 7 DAY) AS n_7d,
       COUNT(*) FILTER (WHERE ts > {AS_OF} - INTERVAL 8 DAY) AS n_8d_excl
FROM events
"""

RECENT_DAYS = f"""
SELECT COUNT(*) AS n_recent_days FROM events
WHERE CAST(ts AS DATE) >= CAST({AS_OF} AS DATE) - 7
"""

TYPED_COUNTS = f"""
SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE event_type = 'click') AS n_click,
       COUNT(*) FILTER (WHERE event_type = 'view') AS n_view,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchase
FROM events WHERE ts >= {AS_OF} - INTERVAL 7 DAY
"""

DISTINCT_COUNT = f"""
SELECT COUNT(DISTINCT user_id) AS n_distinct_users FROM events
WHERE ts >= {AS_OF} - INTERVAL 1 DAY
"""

JSON_VALUE = f"""
SELECT event_id, {_jv('props', '$.k')} AS k, {_jv('props', '$.missing')} AS missing FROM events
"""

#: the same documents, parsed as JSON
_SHAPES = """(SELECT event_id, replace(CASE event_id % 10 WHEN 0 THEN '{"k":{"a":#}}' WHEN 1 THEN '{"k":[#]}'
    WHEN 2 THEN '{"k":null}' WHEN 3 THEN '{"k":"#"}' WHEN 4 THEN '{"k":#' WHEN 5 THEN '{"k":{"a":1,"a":#}}'
    WHEN 6 THEN '{"a.b":"#","a":{"b":"y"},"k":"{#}"}' WHEN 7 THEN '{"z":1,"z":2,"k":#}'
    WHEN 8 THEN '{"k":{"a":#},"x":"{\\"a\\":#}","z":1,"z":2}' ELSE '{"k":"[#]","z":1,"z":2}' END,
    '#', CAST(event_id AS VARCHAR)) AS doc FROM events)"""


def _if_json(value: str) -> str:
    return f"CASE WHEN json_valid(doc) THEN {value} END"


JSON_SHAPES = f"""
SELECT event_id, {_if_json(_jv('doc', '$.k'))} AS k, {_if_json(_jv('doc', '$."a.b"'))} AS dotted,
       {_if_json(_jv('doc', '$.a.b'))} AS nested
FROM {_SHAPES}
"""

TEXT_DECISION_DAY = f"""
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(CAST({_belgrade_day("date_trunc('millisecond', ts)")} AS DATE) AS VARCHAR) END AS decision_day
FROM events
"""

CHANGED_MINUTES = """
SELECT COUNT(*) FILTER (WHERE date_trunc('minute', ts) <> date_trunc('minute', ts + to_seconds(event_id % 50))) AS n_changed,
       COUNT(*) FILTER (WHERE event_id % 50 <> 0) AS n_touched
FROM events
"""

GAP_COUNT_COPIES = """
WITH ev AS (SELECT event_id, event_type FROM events WHERE event_id % 11 <> 3),
copies AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 5 = 0
           UNION ALL SELECT * FROM ev WHERE event_id % 7 = 0)
SELECT COUNT(*) AS gap_count FROM (
  SELECT event_id, LEAD(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS nxt FROM copies)
WHERE nxt - event_id > 1
"""

LOCAL_DECISION_DAY = f"SELECT event_id, {_belgrade_day('ts')} AS decision_day FROM events"

UNIX_MS_LOCAL = f"""
SELECT event_id, {_ms('ts')} AS kafka_timestamp, {_oslo(_ms('ts'))} AS kafka_mottatt_dato FROM events
"""

MESSAGE_HASH = "SELECT event_id, sha256(props) AS kafka_hash FROM events"

IDENTITY_DIM = """
  SELECT CAST(c_custkey AS VARCHAR) AS off_id, c_nationkey AS skjermet_kode,
         DATE '2024-01-01' + CAST(c_custkey % 20 AS INTEGER) AS gyldig_fra_dato,
         DATE '2024-01-01' + CAST(c_custkey % 20 + c_custkey % 7 AS INTEGER) AS gyldig_til_dato
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_nationkey,
         DATE '2024-01-01' + CAST(c_custkey % 5 + 20 AS INTEGER),
         DATE '2024-01-01' + CAST(c_custkey % 5 + 30 AS INTEGER)
  FROM customer
"""


def _validity(person: str) -> str:
    """Pairs of a recent message and a protected interval of its person around its day."""
    return f"""
WITH message AS (
  SELECT {person} AS off_id, {_belgrade_day('ts')} AS decision_day FROM events WHERE ts >= {AS_OF} - INTERVAL 7 DAY
), span AS (
  SELECT * FROM ({IDENTITY_DIM}) WHERE skjermet_kode IN (6, 7)
)
SELECT COUNT(*) AS n_rows FROM message JOIN span USING (off_id)
WHERE gyldig_fra_dato <= decision_day AND gyldig_til_dato >= decision_day
"""


VALIDITY_JOIN_COUNT = _validity(_jv("props", "$.k"))

UNMATCHED_MESSAGES = f"""
WITH message AS (SELECT {_jv('props', '$.k')} AS case_ref FROM events WHERE date_diff('day', CAST(ts AS DATE), CAST({AS_OF} AS DATE)) <= 7)
SELECT COUNT(*) AS n_unmatched FROM message WHERE NOT EXISTS (
  SELECT 1 FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND CAST(c_custkey AS VARCHAR) = case_ref)
"""

NEW_CODES = """
SELECT p_partkey AS code FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49 AND l_partkey IS NOT NULL
"""

NEW_CODES_NOT_IN = """
SELECT DISTINCT p_partkey AS code FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)
"""

NEW_CODES_NOT_IN_NULL = """
SELECT DISTINCT p_partkey AS code FROM part
WHERE p_partkey NOT IN (SELECT CASE WHEN l_quantity > 49 THEN l_partkey END FROM lineitem)
"""

PATCHED_ROWS = """
SELECT COUNT(*) AS n_patched
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE date_trunc('minute', o.o_orderdate) <> date_trunc('minute', l.l_shipdate)
  AND l.l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'
"""

UNPIVOT_DISTINCT = """
WITH wide AS (
  SELECT strftime(l_shipdate, '%Y%m') AS periode, l_returnflag AS flag, l_linestatus AS status,
         l_suppkey, NULLIF(l_tax, 0) AS tax, NULLIF(l_discount, 0) AS discount,
         NULLIF(l_quantity, 0) AS quantity
  FROM lineitem
)
SELECT periode, flag, status, code,
       COUNT(DISTINCT CASE WHEN amount IS NOT NULL THEN l_suppkey END) AS n_suppliers
FROM (
  SELECT * FROM wide
  UNPIVOT (amount FOR code IN (tax AS 'TAX', discount AS 'DISCOUNT', quantity AS 'QUANTITY'))
) u
GROUP BY periode, flag, status, code
"""

STAR_DISTINCT = """
SELECT strftime(l.l_shipdate, '%Y%m') AS periode, c.c_mktsegment AS segment,
       o.o_orderstatus AS status, COUNT(DISTINCT o.o_custkey) AS n_customers
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_orderstatus IN ('F', 'O')
JOIN customer c ON o.o_custkey = c.c_custkey
  AND c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY strftime(l.l_shipdate, '%Y%m'), c.c_mktsegment, o.o_orderstatus
"""

_RECON = """
WITH all_rows AS (
  SELECT strftime(l_shipdate, '%Y%m') AS periode, l_returnflag AS flag, l_linestatus AS status,
         COUNT(DISTINCT l_suppkey) AS n_suppliers
  FROM lineitem GROUP BY 1, 2, 3
), discounted AS (
  SELECT strftime(l_shipdate, '%Y%m') AS periode, l_returnflag AS flag,
         COUNT(DISTINCT l_suppkey) AS n_suppliers_right
  FROM lineitem WHERE l_discount > 0.05 GROUP BY 1, 2
), compared AS (
  SELECT a.*, d.n_suppliers_right, a.n_suppliers - d.n_suppliers_right AS diff
  FROM all_rows a LEFT JOIN discounted d ON a.periode = d.periode AND a.flag = d.flag
)
SELECT * FROM compared WHERE diff > 0
"""

RECONCILE_DIFF = _RECON
RECONCILE_FIRST = (f"SELECT * FROM ({_RECON}) r WHERE periode = '199806' "
                   "ORDER BY diff DESC, periode, flag, status LIMIT 1")

INTERVAL_SLICE = f"""
SELECT props AS kafka_message, event_type AS kafka_topic, event_id AS kafka_offset,
       {_ms('ts')} AS kafka_timestamp, CAST(user_id % 4 AS INTEGER) AS kafka_partition
FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'
"""

TABLE_SCAN = "SELECT n_nationkey, n_name FROM nation"
TABLE_SCAN_ALL = "SELECT * FROM nation"
TABLE_COPY = "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"
CSV_ROUNDTRIP = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey,
       CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '"' || c_name || '", he said'
         WHEN 3 THEN c_name || chr(10) || 'second; line' WHEN 4 THEN '  ' || c_name || ' ' WHEN 5 THEN 'C:\\' || c_name || '\\'
         WHEN 6 THEN ',,' || c_name || chr(13) || chr(10) WHEN 7 THEN 'Å' || chr(9) || '""' ELSE c_name END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment
FROM customer
"""

_LANDING = f"""props AS melding, event_type AS kafka_topic, event_id AS kafka_offset,
       {_oslo(_ms('ts'))} AS kafka_mottatt_dato,
       CAST(user_id % 4 AS INTEGER) AS kafka_partition"""

INGEST_MAP = f"""
SELECT {_LANDING}, {BATCH_TIME} AS lastet_dato,
       {_jv('props', '$.k')} AS ytelse_type, 'EVENTS' AS type_stonad
FROM events
"""

SKIP_DUPLICATES = """
WITH message AS (
  SELECT event_type AS kafka_topic, CAST(user_id % 4 AS INTEGER) AS kafka_partition,
         CASE WHEN event_id % 97 <> 0 THEN event_id END AS kafka_offset, props AS melding, ts FROM events
)
SELECT * EXCLUDE (ts) FROM message WHERE kafka_offset IS NOT NULL AND ts >= TIMESTAMP '2024-01-20 00:00:00'
UNION ALL
SELECT * EXCLUDE (ts) FROM message WHERE kafka_offset IS NULL AND ts >= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL
SELECT * EXCLUDE (ts) FROM message WHERE kafka_offset IS NULL AND ts >= TIMESTAMP '2024-01-28 00:00:00'
"""

FAN_IN_INGEST = f"""
SELECT props AS melding, event_type AS kafka_topic, event_id AS kafka_offset,
       CAST(user_id % 4 AS INTEGER) AS kafka_partition, {BATCH_TIME} AS lastet_dato,
       CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'VIEW'
                       WHEN 'purchase' THEN 'PURCHASE' END AS type_stonad
FROM events WHERE event_type IN ('click', 'view', 'purchase')
"""

REPLAY_IDEMPOTENT = f"""
SELECT {_LANDING},
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN {BATCH_TIME} ELSE {REPLAY_TIME} END
         AS lastet_dato
FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
"""

STREAM_INGEST = INGEST_MAP

_RUNS = """
SELECT o_orderpriority AS dag_id, COUNT(*) AS success_count FROM orders
WHERE o_orderstatus = 'F'
  AND o_orderdate >= TIMESTAMP '1996-01-01 10:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 10:00:00'
GROUP BY o_orderpriority
"""
RUN_SUCCESS_COUNTS = _RUNS
RUN_SUCCESS_REPORT = f"""
SELECT string_agg('DAG ID: ' || dag_id || ', Success Count: ' || CAST(success_count AS VARCHAR),
                  chr(10) ORDER BY dag_id) AS report
FROM ({_RUNS}) r
"""

_DAYS = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"
PREV_PERIOD = f"SELECT d, strftime(d - INTERVAL 1 MONTH, '%Y%m') AS prev_period FROM {_DAYS} t"
PREV_MONTH_END = (f"SELECT d, strftime(last_day(d - INTERVAL 1 MONTH), '%Y%m%d') AS prev_month_end "
                  f"FROM {_DAYS} t")
_TYPE = """CASE WHEN day(d) = 1 AND month(d) = 1 THEN 'A'
            WHEN day(d) = 1 AND month(d) = 4 THEN 'K'
            WHEN day(d) = 1 AND month(d) = 7 THEN 'H'
            WHEN day(d) = 1 AND month(d) = 10 THEN 'S' END"""
PERIOD_TYPE = f"SELECT d, {_TYPE} AS period_type FROM {_DAYS} t"
PERIOD_WINDOW = f"""
WITH x AS (
  SELECT d, {_TYPE} AS typ, strftime(d - INTERVAL 1 MONTH, '%Y%m') AS tom FROM {_DAYS} t
), y AS (
  SELECT d, typ, tom,
         CASE typ WHEN 'A' THEN strftime(d - INTERVAL 12 MONTH, '%Y%m')
                  WHEN 'S' THEN strftime(d - INTERVAL 9 MONTH, '%Y%m')
                  WHEN 'H' THEN strftime(d - INTERVAL 6 MONTH, '%Y%m')
                  WHEN 'K' THEN strftime(d - INTERVAL 3 MONTH, '%Y%m') END AS fom
  FROM x
)
SELECT d, fom AS periode_fom, tom AS periode_tom,
       strftime(d + 1, '%Y%m%d') AS max_vedtaksdato,
       CASE typ WHEN 'A' THEN 'A' || fom WHEN 'S' THEN 'S' || tom
                WHEN 'H' THEN 'H' || fom WHEN 'K' THEN 'K' || fom END AS periode_label
FROM y
"""
DAILY_WINDOW = f"""
SELECT d, strftime(d - INTERVAL 4 MONTH, '%Y%m') AS periode_fom,
       strftime(d + INTERVAL 14 MONTH, '%Y%m') AS periode_tom,
       strftime(d + 1, '%Y%m%d') AS max_vedtaksdato, 'D' AS periode_type
FROM {_DAYS} t
"""
WEEK_CYCLE = f"""
SELECT d, CAST(weekofyear(d) AS INTEGER) AS week,
       ['Ada', 'Bjorn', 'Cato', 'Dina'][((weekofyear(d) - 1) % 4) + 1] AS on_duty
FROM {_DAYS} t
"""

BLANK_DEFAULT = """
WITH s AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN ''
              WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
              ELSE CAST(c_nationkey AS VARCHAR) END AS setting,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN ''
              ELSE '1998' || lpad(CAST(c_nationkey % 12 + 1 AS VARCHAR), 2, '0') END AS period_setting,
         c_nationkey % 2 AS flag_setting
  FROM customer
)
SELECT c_custkey, setting,
       CASE WHEN setting IS NULL OR setting = '' THEN 1 ELSE CAST(setting AS INTEGER) END AS value,
       CASE WHEN period_setting = '' THEN '202312' ELSE period_setting END AS periode,
       CASE WHEN period_setting = '' THEN 1 ELSE CAST(flag_setting AS INTEGER) END AS gyldig_flagg
FROM s
"""

PERIOD_FILTER = """
SELECT l_orderkey, l_linenumber, l_shipdate, 1 AS gyldig_flagg FROM lineitem
WHERE strftime(l_shipdate, '%Y%m') BETWEEN '199801' AND '199806'
  AND CAST(l_shipdate AS DATE) <= DATE '1998-06-15'
"""

PERIOD_REFRESH = """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y%m') END AS periode FROM orders
)
SELECT * FROM o WHERE periode IS DISTINCT FROM '199806'
UNION ALL
SELECT * REPLACE ('X' AS o_orderstatus) FROM o
WHERE periode = '199806' AND o_orderkey % 3 <> 0 OR o_orderkey % 101 = 0
"""

_DAILY_PARTS = [
    ("events_1d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY)"),
    ("click_1d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY AND event_type = 'click')"),
    ("view_1d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY AND event_type = 'view')"),
    ("purchase_1d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY AND event_type = 'purchase')"),
    ("signup_1d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY AND event_type = 'signup')"),
    ("error_1d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY AND event_type = 'error')"),
    ("users_1d", "COUNT(DISTINCT user_id) FILTER (WHERE ts >= {a} - INTERVAL 1 DAY)"),
    ("events_7d", "COUNT(*) FILTER (WHERE ts >= {a} - INTERVAL 7 DAY)"),
]
DAILY_REPORT = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS pos, '{name}' AS metric, {expr.format(a=AS_OF)} AS value FROM events"
    for i, (name, expr) in enumerate(_DAILY_PARTS))

_DAILY_LABELS = {
    "events_1d": "Messages received, last day",
    "click_1d": "Click messages",
    "view_1d": "View messages",
    "purchase_1d": "Purchase messages",
    "signup_1d": "Signup messages",
    "error_1d": "Error messages",
    "users_1d": "Distinct users",
    "events_7d": "Messages received over the last seven days, all types and topics together",
}

def _line(label: str, value: str) -> str:
    """Label, dots up to 60 characters (none for a longer label), value."""
    return f"{label} || repeat('.', greatest(60 - length({label}), 0)) || CAST({value} AS VARCHAR)"


REPORT_LINES = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS pos, '{name}' AS metric, "
    f"{_line(repr(_DAILY_LABELS[name]), expr.format(a=AS_OF))} AS line "
    f"FROM events"
    for i, (name, expr) in enumerate(_DAILY_PARTS))

_JOINED = " || '/' || ".join(f"CAST({expr.format(a=AS_OF)} AS VARCHAR)" for name, expr in _DAILY_PARTS
                              if name in ("click_1d", "view_1d", "purchase_1d"))

DAILY_REPORT_TEXT = f"""
SELECT 'Daily report, messages read since 2024-01-30 00:00:00' || chr(10) || 'On duty this week: Ada' || chr(10)
       || string_agg(line, chr(10) ORDER BY pos) AS text
FROM (SELECT pos, line FROM ({REPORT_LINES}) r
      UNION ALL
      SELECT 99, {_line("'Messages by type (click/view/purchase)'", _JOINED)} FROM events) r
"""

GAP_ALERT = f"""
WITH g AS (
  SELECT 'events' AS name, ({GAP_COUNT}) AS n
  UNION ALL SELECT 'events click', ({GAP_COUNT_TYPED})
  UNION ALL SELECT 'events since 15.01', ({GAP_COUNT_SINCE})
  UNION ALL SELECT 'lineitem by supplier', ({GAP_COUNT_PARTITIONED})
)
SELECT CASE WHEN COUNT(*) FILTER (WHERE n > 0) = 0 THEN 'No gaps found in any topic.'
            ELSE 'Gaps found in: ' || string_agg(name, ', ' ORDER BY name) FILTER (WHERE n > 0)
                 || '. Check the offsets by hand to find them.' END AS alert
FROM g
"""

WEEKLY_REPORT = f"""
SELECT 1 AS pos, 'validity_by_payload_key' AS metric, ({VALIDITY_JOIN_COUNT}) AS value
UNION ALL SELECT 2, 'validity_by_user', ({_validity('CAST(user_id AS VARCHAR)')})
UNION ALL SELECT 3, 'unmatched_messages', ({UNMATCHED_MESSAGES})
UNION ALL SELECT 4, 'new_part_codes', (SELECT COUNT(*) FROM ({NEW_CODES}) x)
UNION ALL SELECT 5, 'new_supplier_codes', (
  SELECT COUNT(*) FROM (SELECT l_suppkey FROM lineitem EXCEPT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))
UNION ALL SELECT 6, 'new_part_codes_not_in', (SELECT COUNT(*) FROM ({NEW_CODES_NOT_IN}) x)
UNION ALL SELECT 7, 'patched_rows', ({PATCHED_ROWS})
"""

_WEEKLY_LABELS = {
    "validity_by_payload_key": "Protected persons by payload key, not unpacked",
    "validity_by_user": "Protected persons by user, not unpacked",
    "unmatched_messages": "Messages not unpacked",
    "new_part_codes": "New part codes",
    "new_supplier_codes": "New supplier codes",
    "new_part_codes_not_in": "New part codes (NOT IN)",
    "patched_rows": "Rows changed after creation",
}
_WEEKLY_LABEL_CASE = "CASE metric " + " ".join(
    f"WHEN '{m}' THEN '{t}'" for m, t in _WEEKLY_LABELS.items()) + " ELSE metric END"
WEEKLY_REPORT_TEXT = f"""
SELECT 'Weekly report, messages read since 2024-01-24 00:00:00' || chr(10)
       || string_agg({_line("label", "value")}, chr(10) ORDER BY pos) AS text
FROM (SELECT pos, {_WEEKLY_LABEL_CASE} AS label, value FROM ({WEEKLY_REPORT}) x) w
"""

WEEKLY_NEW_CODES = f"""
SELECT 'new_part_codes' AS metric, CAST(COLUMNS(*) AS VARCHAR) AS code FROM ({NEW_CODES}) a
UNION ALL
SELECT 'new_supplier_codes', CAST(l_suppkey AS VARCHAR)
FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) b
UNION ALL
SELECT 'new_part_codes_not_in', CAST(COLUMNS(*) AS VARCHAR) FROM ({NEW_CODES_NOT_IN}) c
"""

MONTHLY_RECONCILIATION = """
WITH wide AS (
  SELECT strftime(l_shipdate, '%Y%m') AS periode, l_returnflag AS flag, l_suppkey,
         CASE WHEN l_tax < 0.08 THEN NULLIF(l_tax, 0) END AS tax,
         CASE WHEN l_discount < 0.10 AND l_returnflag = 'N' THEN NULLIF(l_discount, 0) END AS discount
  FROM lineitem WHERE l_linestatus = 'O'
), wide_counts AS (
  SELECT periode, flag, code, COUNT(DISTINCT l_suppkey) AS n_distinct_wide
  FROM (SELECT * FROM wide UNPIVOT (amount FOR code IN (tax AS 'TAX', discount AS 'DISCOUNT'))) u
  GROUP BY periode, flag, code
), star AS (
  SELECT strftime(l_shipdate, '%Y%m') AS periode, l_returnflag AS flag, c_mktsegment AS segment, l_suppkey,
         NULLIF(l_tax, 0) AS tax, NULLIF(l_discount, 0) AS discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
), fact_counts AS (
  SELECT periode, flag, segment, code, COUNT(DISTINCT l_suppkey) AS n_distinct
  FROM (SELECT * FROM star UNPIVOT (amount FOR code IN (tax AS 'TAX', discount AS 'DISCOUNT'))) u
  GROUP BY periode, flag, segment, code
), compared AS (
  SELECT f.*, w.n_distinct_wide, f.n_distinct - w.n_distinct_wide AS diff_n_distinct
  FROM fact_counts f LEFT JOIN wide_counts w USING (periode, flag, code)
)
SELECT periode, flag, segment, code, n_distinct, COALESCE(n_distinct_wide, 0) AS n_distinct_wide,
       n_distinct_wide IS NULL AS missing
FROM compared WHERE diff_n_distinct > 0 OR diff_n_distinct IS NULL
"""

ORACLE_SQL: dict[str, str] = {
    "gap_count": GAP_COUNT,
    "gap_count_typed": GAP_COUNT_TYPED,
    "gap_count_since": GAP_COUNT_SINCE,
    "gap_count_partitioned": GAP_COUNT_PARTITIONED,
    "gap_list": GAP_LIST,
    "recent_count": RECENT_COUNT,
    "recent_days": RECENT_DAYS,
    "typed_counts": TYPED_COUNTS,
    "distinct_count": DISTINCT_COUNT,
    "json_value": JSON_VALUE,
    "json_shapes": JSON_SHAPES,
    "text_decision_day": TEXT_DECISION_DAY,
    "changed_minutes": CHANGED_MINUTES,
    "gap_count_copies": GAP_COUNT_COPIES,
    "local_decision_day": LOCAL_DECISION_DAY,
    "unix_ms_local": UNIX_MS_LOCAL,
    "message_hash": MESSAGE_HASH,
    "validity_join_count": VALIDITY_JOIN_COUNT,
    "unmatched_messages": UNMATCHED_MESSAGES,
    "new_codes": NEW_CODES,
    "new_codes_not_in": NEW_CODES_NOT_IN,
    "new_codes_not_in_null": NEW_CODES_NOT_IN_NULL,
    "patched_rows": PATCHED_ROWS,
    "unpivot_distinct": UNPIVOT_DISTINCT,
    "star_distinct": STAR_DISTINCT,
    "reconcile_diff": RECONCILE_DIFF,
    "reconcile_first": RECONCILE_FIRST,
    "interval_slice": INTERVAL_SLICE,
    "table_scan": TABLE_SCAN,
    "table_scan_all": TABLE_SCAN_ALL,
    "table_copy": TABLE_COPY,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "ingest_map": INGEST_MAP,
    "skip_duplicates": SKIP_DUPLICATES,
    "fan_in_ingest": FAN_IN_INGEST,
    "replay_idempotent": REPLAY_IDEMPOTENT,
    "stream_ingest": STREAM_INGEST,
    "run_success_counts": RUN_SUCCESS_COUNTS,
    "run_success_report": RUN_SUCCESS_REPORT,
    "prev_period": PREV_PERIOD,
    "prev_month_end": PREV_MONTH_END,
    "period_type": PERIOD_TYPE,
    "period_window": PERIOD_WINDOW,
    "daily_window": DAILY_WINDOW,
    "week_cycle": WEEK_CYCLE,
    "blank_default": BLANK_DEFAULT,
    "period_filter": PERIOD_FILTER,
    "period_refresh": PERIOD_REFRESH,
    "daily_report": DAILY_REPORT,
    "report_lines": REPORT_LINES,
    "daily_report_text": DAILY_REPORT_TEXT,
    "gap_alert": GAP_ALERT,
    "weekly_report": WEEKLY_REPORT,
    "weekly_report_text": WEEKLY_REPORT_TEXT,
    "weekly_new_codes": WEEKLY_NEW_CODES,
    "monthly_reconciliation": MONTHLY_RECONCILIATION,
}

from tidemark.plans.landing_oracle import ORACLE_SQL as _LANDING_SQL  # noqa: E402

ORACLE_SQL |= _LANDING_SQL
