"""SQL twins of `relay.plans.topics`, for the check engine."""

from __future__ import annotations

EVENTS = """
messages AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key,
         CASE event_id % 20
           WHEN 0 THEN 'not json'
           WHEN 1 THEN concat('{"event_id":', event_id, ',"status":null,"value":', v, '}')
           WHEN 2 THEN concat('{"event_id":', event_id, ',"value":', v, '}')
           WHEN 3 THEN concat('{"event_id":', event_id, ',"status":5,"value":', v, '}')
           WHEN 4 THEN concat('[', event_id, ']')
           ELSE concat('{"event_id":', event_id, ',"user_id":', user_id, ',"status":"', event_type,
                       '","value":', v, ',"props":', props, '}')
         END AS value
  FROM (SELECT *, CAST(value AS DECIMAL(12,2)) AS v FROM events))"""

ORDERS = """
messages AS (
  SELECT 'orders' AS topic, CAST(o_custkey % 4 AS INTEGER) AS "partition", o_orderkey AS "offset",
         CAST(o_orderkey AS VARCHAR) AS key,
         concat('{"order":{"id":', o_orderkey, ',"status":"', o_orderstatus, '","urgent":',
                CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END,
                ',"payment":{"amount":', CAST(o_totalprice AS DECIMAL(12,2)), '}},"tags":',
                CASE o_orderkey % 3 WHEN 0 THEN '[]' WHEN 1 THEN concat('["', o_orderstatus, '"]')
                  ELSE concat('["', o_orderstatus, '","', o_orderpriority, '"]') END,
                ',"lines":[{"kind":"', o_orderstatus, '","qty":', o_orderkey % 7,
                '},{"kind":"', o_orderpriority, '","qty":', o_orderkey % 5, '}]}') AS value
  FROM orders)"""

KEYED = """
messages AS (
  SELECT 'customers' AS topic, CAST(o_custkey % 4 AS INTEGER) AS "partition", o_orderkey AS "offset",
         CASE WHEN o_orderkey % 10 <> 7 THEN CAST(o_custkey AS VARCHAR) END AS key,
         concat('{"customer":', o_custkey, ',"order":', o_orderkey,
                CASE WHEN o_orderkey % 5 = 0 THEN ',"status":null'
                     WHEN o_orderkey % 3 <> 0 THEN concat(',"status":"', o_orderstatus, '"')
                     ELSE '' END,
                CASE WHEN o_orderkey % 4 = 0
                     THEN concat(',"amount":', CAST(o_totalprice AS DECIMAL(12,2))) ELSE '' END,
                '}') AS value
  FROM orders)"""

DOCUMENTS = """
messages AS (
  SELECT 'documents' AS topic, CAST(doc_id % 4 AS INTEGER) AS "partition",
         CAST(doc_id AS BIGINT) AS "offset", CAST(doc_id AS VARCHAR) AS key, lang, text
  FROM documents)"""

PARSED = """
parsed AS (
  SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM messages),
objects AS (
  SELECT *, CASE WHEN json_type(j) = 'OBJECT' THEN j END AS o FROM parsed)"""

STATUS = """CAST(CASE event_id % 10 WHEN 0 THEN 503 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 408
  WHEN 4 THEN 422 WHEN 5 THEN 0 WHEN 6 THEN 302 ELSE 200 END AS INTEGER)"""

ERROR_TYPE = """CASE WHEN status_code BETWEEN 200 AND 299 THEN 'NONE'
  WHEN status_code BETWEEN 400 AND 499 THEN 'SINK_4XX_ERROR'
  WHEN status_code BETWEEN 500 AND 599 THEN 'SINK_5XX_ERROR' ELSE 'SINK_UNKNOWN_ERROR' END"""

RETRYABLE = "(status_code BETWEEN 500 AND 599 OR status_code IN (429, 408))"
DEAD = """(status_code = 0 OR status_code BETWEEN 400 AND 428 OR status_code BETWEEN 430 AND 599)"""


def action(retried: str = "retried") -> str:
    """Routing with the default ranges; no range fails the job."""
    return (f"CASE WHEN NOT {retried} AND (status_code = 0 OR {RETRYABLE}) THEN 'RETRY' "
            f"WHEN {DEAD} THEN 'DLQ' ELSE 'IGNORE' END")


OUTCOMES = f"""
outcomes AS (
  SELECT *, {ERROR_TYPE} AS error_type FROM (
    SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
           CAST(user_id AS VARCHAR) AS key, event_type AS value, event_type AS sink,
           {STATUS} AS status_code, event_id % 3 = 0 AS retried,
           concat('error ', event_id) AS error_message, value / 100 AS latency_s, ts
    FROM events))"""

ATTEMPTS = """
attempts AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         CAST(a AS INTEGER) AS attempt, (event_id + a) % 4 = 0 AS ok
  FROM events, range(1, 4) AS t(a))"""

LEDGER = f"""
ledger AS (
  SELECT *, {ERROR_TYPE} AS error_type FROM (
    SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
           concat('events-', user_id % 4, '-', event_id // 100) AS batch_id,
           CASE event_id % 20 WHEN 0 THEN 'reject' WHEN 1 THEN 'invalid' WHEN 2 THEN 'invalid'
             WHEN 3 THEN 'dropped' WHEN 4 THEN 'dropped' ELSE 'sent' END AS stage,
           CASE event_id % 20 WHEN 1 THEN 'status is text' WHEN 2 THEN 'has status' END AS reason,
           event_type AS sink, {STATUS} AS status_code, event_id % 3 = 0 AS retried,
           value / 100 AS latency_s, (event_id // 100) % 7 <> 5 AS done
    FROM events))"""

RESPONSES = """
responses AS (
  SELECT o_orderkey AS k, concat('orders/', o_orderkey) AS request_id, o_orderkey % 10 AS kind,
         o_orderstatus, o_orderkey % 9 AS extra
  FROM orders),
entries AS (
  SELECT request_id, e.pos AS pos, e.seq AS seq, e.success AS success, e.error AS error,
         e.retryable AS retryable
  FROM responses, LATERAL (VALUES
    (0, 0, TRUE, '', FALSE),
    (1, 1, o_orderstatus = 'F', concat('bad ', k), k % 4 = 0),
    (2, 2, FALSE, '', FALSE),
    (3, extra, FALSE, '', FALSE),
    (4, 3, FALSE, '', TRUE),
    (5, 3, TRUE, '', FALSE)) AS e(pos, seq, success, error, retryable)
  WHERE kind < 8),
slots AS (
  SELECT request_id, CAST(s AS INTEGER) AS seq FROM responses, range(0, 7) AS t(s) WHERE kind < 8),
results AS (
  SELECT s.request_id, s.seq, coalesce(e.success, FALSE) AS success,
         coalesce(e.error, 'the answer has no entry for this message') AS error,
         coalesce(e.retryable, TRUE) AS is_retryable
  FROM slots s LEFT JOIN (
    SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY request_id, seq ORDER BY pos DESC) = 1
  ) e ON s.request_id = e.request_id AND s.seq = e.seq)"""

# Passed records of topic `events`, cut into batches of 10 per partition.
PASSED = "json_type(o, '$.status') = 'VARCHAR' AND CAST(o->>'$.value' AS DOUBLE) > 5"


def chunks(size: int = 10, passed: str = PASSED, span: int = 65_536) -> str:
    """Members of batches of `size`, every `span` offsets cut by themselves."""
    group = f'topic, "partition", "offset" // {span}'
    return f"""{EVENTS}, {PARSED},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY "offset") - 1 AS rn
  FROM objects WHERE {passed}),
members AS (
  SELECT topic, "partition", "offset", key, value, o,
         CAST("offset" // {span} * {span} + rn // {size} AS BIGINT) AS chunk_no,
         CAST(rn % {size} AS INTEGER) AS seq,
         min("offset") OVER (PARTITION BY {group}, rn // {size}) AS first_offset,
         concat(topic, '-', "partition", '-', min("offset") OVER (PARTITION BY {group}, rn // {size}))
           AS batch_id
  FROM numbered)"""


def sql(parts: list[str] | tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select
