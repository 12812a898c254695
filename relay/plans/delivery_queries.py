"""Batches, requests, delivery, responses, routing and retries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from relay.functions import predicates as p
from relay.functions import status
from relay.operators import batching, delivery, responses, routing
from relay.plans import topics
from relay.plans.registry import query
from relay.plans.topics_sql import (
    ATTEMPTS,
    EVENTS,
    OUTCOMES,
    RESPONSES,
    RETRYABLE,
    action,
    chunks,
    sql,
)
from relay.session import stage

POS = ["topic", "partition", "offset"]
POS_SQL = 'topic, "partition", "offset"'


# --- batches and request bodies ---------------------------------------------------

def passed_messages(spark, sf):
    """Messages of topic `events` with a status text and a value over 5."""
    messages = topics.objects(topics.event_messages(spark, sf))
    condition = p.text("status").isNotNull() & p.gt("value", 5)
    return messages.filter(p.truthy(condition)).drop("message")


SPAN = 65_536


def members(spark, sf, size=10, max_size=0):
    return batching.split_max(batching.chunk(passed_messages(spark, sf), size, SPAN), max_size)


# One span covers all offsets: only the last batch of a partition is short.
@query("chunk", sql([chunks(span=1_000_000_000)], f"""
SELECT {POS_SQL}, chunk_no, seq, first_offset, batch_id FROM members"""))
def chunk(spark, sf):
    return batching.chunk(passed_messages(spark, sf), 10).select(
        *POS, "chunk_no", "seq", "first_offset", "batch_id")


@query("chunk_by_span", sql([chunks(span=700)], f"""
SELECT {POS_SQL}, chunk_no, seq, first_offset, batch_id FROM members"""))
def chunk_by_span(spark, sf):
    return batching.chunk(passed_messages(spark, sf), 10, span=700).select(
        *POS, "chunk_no", "seq", "first_offset", "batch_id")


BODY_SQL = """
SELECT topic, "partition", batch_id, min("offset") AS first_offset,
       CAST(count(*) AS INTEGER) AS size,
       concat('[', string_agg(value, ',' ORDER BY seq), ']') AS body
FROM members GROUP BY topic, "partition", batch_id"""


@query("batch_body", sql([chunks()], BODY_SQL))
def batch_body(spark, sf):
    return batching.batch_body(members(spark, sf)).drop("request_id")


@query("batch_body_with_seq", sql([chunks()], """
SELECT batch_id, seq AS seq, CAST(o->>'$.event_id' AS BIGINT) AS event_id,
       o->>'$.status' AS status, CAST(o->>'$.props.k' AS BIGINT) AS k FROM members"""))
def batch_body_with_seq(spark, sf):
    bodies = batching.batch_body_with_seq(members(spark, sf))
    entries = F.from_json(
        "body", "array<struct<_relay_seq int, event_id bigint, status string, props struct<k bigint>>>")
    return bodies.select("batch_id", F.inline(entries)).select(
        "batch_id", F.col("_relay_seq").alias("seq"), "event_id", "status", F.col("props.k").alias("k"))


@query("split_max", sql([chunks()], """
SELECT concat(batch_id, '/', seq // 4) AS request_id, CAST(count(*) AS INTEGER) AS size,
       concat('[', string_agg(value, ',' ORDER BY seq), ']') AS body
FROM members GROUP BY batch_id, seq // 4"""))
def split_max(spark, sf):
    return batching.batch_body(members(spark, sf, max_size=4)).select("request_id", "size", "body")


@query("individual_requests", sql([chunks()], """
SELECT concat(topic, '-', "partition", '-', "offset") AS request_id, value AS body FROM members"""))
def individual_requests(spark, sf):
    return batching.build_requests(members(spark, sf), "individual").select("request_id", "body")


# --- delivery -----------------------------------------------------------------------

class SampleTransport:
    """Answers from the request alone, the same on every replay."""

    def __call__(self, request):
        kind = request["first_offset"] % 4
        if kind == 3:
            raise ConnectionError("refused")
        return (200, 503, 404)[kind], json.dumps({"size": request["size"]})


KIND = "CAST(CASE first_offset % 4 WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 404 ELSE 0 END AS INTEGER)"
BATCHES = """
batches AS (SELECT topic, "partition", batch_id, min("offset") AS first_offset,
  CAST(count(*) AS INTEGER) AS size FROM members GROUP BY topic, "partition", batch_id)"""


@query("deliver", sql([chunks(), BATCHES], f"""
SELECT batch_id, {KIND} AS status_code,
       CASE WHEN first_offset % 4 <> 3 THEN concat('{{"size": ', size, '}}') END AS response_body,
       CASE WHEN first_offset % 4 = 3 THEN 'refused' END AS error FROM batches"""))
def deliver(spark, sf):
    requests = batching.batch_body(members(spark, sf))
    return delivery.deliver(requests, SampleTransport(), concurrency=4).select(
        "batch_id", "status_code", "response_body", "error")


class CountingTransport:
    """Numbers the requests of each partition in the order they arrive."""

    def open(self):
        self.seen = {}

    def __call__(self, request):
        number = self.seen.get(request["partition"], 0)
        self.seen[request["partition"]] = number + 1
        return 200, str(number)


@query("ordered_deliver", sql([chunks(), BATCHES], """
SELECT batch_id, CAST(row_number() OVER (PARTITION BY topic, "partition" ORDER BY first_offset) - 1
       AS BIGINT) AS arrival FROM batches"""))
def ordered_deliver(spark, sf):
    requests = batching.batch_body(members(spark, sf))
    return delivery.ordered_deliver(requests, CountingTransport()).select(
        "batch_id", F.col("response_body").cast("bigint").alias("arrival"))


@query("expand_batch_failure", sql([chunks(), BATCHES], f"""
SELECT m.topic, m."partition", m."offset", status_code,
       CASE WHEN status_code = 0 THEN 'refused' ELSE 'the sink refused the request' END AS error_message,
       CASE status_code WHEN 404 THEN 'SINK_4XX_ERROR' WHEN 503 THEN 'SINK_5XX_ERROR'
            ELSE 'SINK_UNKNOWN_ERROR' END AS error_type, FALSE AS retried
FROM members m JOIN (SELECT batch_id, {KIND} AS status_code FROM batches) b ON m.batch_id = b.batch_id
WHERE status_code <> 200"""))
def expand_batch_failure(spark, sf):
    rows = members(spark, sf)
    outcomes = stage(delivery.deliver(batching.batch_body(rows), SampleTransport(), 4), "outcomes")
    return delivery.expand_batch_failure(outcomes, rows).select(
        *POS, "status_code", "error_message", "error_type", "retried")


# --- responses ------------------------------------------------------------------------

@query("parse_batch_response", sql([RESPONSES], """
SELECT request_id, seq, success, error, is_retryable, FALSE AS parse_error FROM results
UNION ALL
SELECT request_id, CAST(s AS INTEGER), FALSE, 'batch response cannot be parsed', TRUE, TRUE
FROM responses, range(0, 7) AS t(s) WHERE kind >= 8"""))
def parse_batch_response(spark, sf):
    return responses.parse_batch_response(topics.batch_responses(spark, sf))


def response_members(spark, sf):
    """Seven messages per order, the members of its response."""
    return topics.table(spark, sf, "orders").select(
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("request_id"),
        F.col("o_orderkey").alias("order"), F.explode(F.expr("sequence(0, 6)")).alias("seq"))


@query("responses_to_failures", sql([RESPONSES], """
SELECT request_id, CAST(s AS INTEGER) AS seq, CAST(0 AS INTEGER) AS status_code,
       'batch response cannot be parsed' AS error_message, 'SINK_UNKNOWN_ERROR' AS error_type
FROM responses, range(0, 7) AS t(s) WHERE kind >= 8
UNION ALL
SELECT request_id, seq, CAST(CASE WHEN is_retryable THEN 500 ELSE 422 END AS INTEGER) AS status_code,
       error AS error_message,
       CASE WHEN is_retryable THEN 'SINK_5XX_ERROR' ELSE 'SINK_4XX_ERROR' END AS error_type
FROM results WHERE NOT success"""))
def responses_to_failures(spark, sf):
    results = responses.parse_batch_response(topics.batch_responses(spark, sf))
    return responses.responses_to_failures(results, response_members(spark, sf)).select(
        "request_id", "seq", "status_code", "error_message", "error_type")


@query("response_failures", sql([RESPONSES], """
SELECT request_id, seq, status_code, error_message FROM (
  SELECT r.request_id, t.s AS seq, r.code AS status_code,
         CASE r.code WHEN 0 THEN CASE WHEN r.k % 11 = 3 THEN 'timed out'
           ELSE 'batch response cannot be parsed' END
           ELSE 'the whole batch was refused' END AS error_message
  FROM (SELECT *, CAST(CASE WHEN k % 11 = 3 THEN 0 WHEN k % 11 = 5 THEN 502 WHEN kind >= 8 THEN 0
               ELSE 200 END AS INTEGER) AS code FROM responses) r,
       (SELECT CAST(s AS INTEGER) AS s FROM range(0, 7) AS x(s)) t WHERE r.code <> 200
  UNION ALL
  SELECT s.request_id, s.seq, CAST(CASE WHEN is_retryable THEN 500 ELSE 422 END AS INTEGER), error
  FROM results s JOIN responses r ON s.request_id = r.request_id
  WHERE NOT success AND k % 11 NOT IN (3, 5))"""))
def response_failures(spark, sf):
    key = F.element_at(F.split("request_id", "/"), 2).cast("bigint")
    outcomes = topics.batch_responses(spark, sf).withColumns({
        "status_code": F.when(key % 11 == 3, 0).when(key % 11 == 5, 502).otherwise(200),
        "error": F.when(key % 11 == 3, "timed out")})
    return responses.response_failures(outcomes, response_members(spark, sf)).select(
        "request_id", "seq", "status_code", "error_message")


# --- status and routing -----------------------------------------------------------------

def _check(select):
    return sql([OUTCOMES], select)


@query("in_ranges", _check(f"""
SELECT {POS_SQL}, status_code = 429 OR status_code BETWEEN 500 AND 599 AS busy,
       FALSE AS never FROM outcomes"""))
def in_ranges(spark, sf):
    return topics.outcomes(spark, sf).select(
        *POS, status.in_ranges("status_code", "500-599, 429").alias("busy"),
        status.in_ranges("status_code", "").alias("never"))


# Each sink retries codes of its own: a base range and overlapping ones by its customers' events.
@query("in_ranges_table", _check(f"""
SELECT {POS_SQL}, EXISTS (
  SELECT 1 FROM (SELECT DISTINCT event_type, 400 + user_id % 7 * 20 AS s, 415 + user_id % 7 * 20 AS e FROM events
                 WHERE event_id % 5 = 0 AND user_id % 7 < length(event_type)) r
  WHERE r.event_type = outcomes.sink AND outcomes.status_code BETWEEN r.s AND r.e) AS in_range
FROM outcomes"""))
def in_ranges_table(spark, sf):
    ranges = topics.table(spark, sf, "events").filter(
        "event_id % 5 = 0 AND user_id % 7 < length(event_type)").select(
        F.col("event_type").alias("sink"), (400 + F.col("user_id") % 7 * 20).alias("start"),
        (415 + F.col("user_id") % 7 * 20).alias("end")).distinct()
    return routing.in_ranges_table(topics.outcomes(spark, sf), ranges).select(*POS, "in_range")


@query("error_type", _check(f"SELECT {POS_SQL}, status_code, error_type FROM outcomes"))
def error_type(spark, sf):
    return topics.outcomes(spark, sf).select(
        *POS, "status_code", status.error_type("status_code").alias("error_type"))


FAILED = "NOT status_code BETWEEN 200 AND 299"


def failures(spark, sf):
    """Failed messages of topic `events` with type and retry flag."""
    rows = topics.outcomes(spark, sf).filter(~status.is_success("status_code"))
    return rows.withColumn("error_type", status.error_type("status_code"))


@query("route", _check(f"SELECT {POS_SQL}, {action()} AS action FROM outcomes WHERE {FAILED}"))
def route(spark, sf):
    return routing.with_action(failures(spark, sf)).select(*POS, "action")


@query("route_with_fail", _check(f"""
SELECT {POS_SQL}, CASE WHEN status_code = 422 THEN 'FAIL'
  WHEN NOT retried AND (status_code = 0 OR {RETRYABLE}) THEN 'RETRY'
  WHEN status_code BETWEEN 400 AND 499 THEN 'DLQ' ELSE 'IGNORE' END AS action
FROM outcomes WHERE {FAILED}"""))
def route_with_fail(spark, sf):
    ranges = routing.RouteRanges(dlq="400-499", fail=[(422, 422)])
    return routing.with_action(failures(spark, sf), ranges).select(*POS, "action")


@query("backoff_ms", """
SELECT event_id, CAST(least(10000, 100 * pow(2.0, greatest(event_id % 12, 1) - 1)) AS BIGINT) AS delay_ms,
       CAST(floor(least(500, 100 * pow(1.5, greatest(event_id % 12, 1) - 1))) AS BIGINT) AS short_ms
FROM events""")
def backoff_ms(spark, sf):
    attempt = F.col("event_id") % 12
    return topics.table(spark, sf, "events").select(
        "event_id", status.backoff_ms(attempt).alias("delay_ms"),
        status.backoff_ms(attempt, 100, 500, 1.5).alias("short_ms"))


@query("to_dlq", _check(f"""
SELECT key, value, CAST(CAST("partition" AS VARCHAR) AS VARCHAR) AS original_partition,
       CAST("offset" AS VARCHAR) AS original_offset, topic AS original_topic, error_type,
       CAST(status_code AS VARCHAR) AS error_status_code, error_message
FROM outcomes WHERE {FAILED}"""))
def to_dlq(spark, sf):
    letters = routing.to_dlq(failures(spark, sf))
    names = ["original_topic", "original_partition", "original_offset", "error_type",
             "error_status_code", "error_message"]
    return letters.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        *[F.map_from_entries("headers")[n].cast("string").alias(n) for n in names])


@query("retry_schedule", _check(f"""
SELECT {POS_SQL}, CAST(a AS INTEGER) AS attempt,
       CAST(CASE a WHEN 1 THEN 100 WHEN 2 THEN 200 WHEN 3 THEN 400 ELSE 500 END AS BIGINT) AS delay_ms,
       CAST(CASE a WHEN 1 THEN 100 WHEN 2 THEN 300 WHEN 3 THEN 700 WHEN 4 THEN 1200 ELSE 1700 END
            AS BIGINT) AS elapsed_ms
FROM outcomes, range(1, 6) AS t(a) WHERE {FAILED}"""))
def retry_schedule(spark, sf):
    return routing.retry_schedule(failures(spark, sf), 5, 100, 500).select(
        *POS, "attempt", "delay_ms", "elapsed_ms")


class FlakyTransport:
    """Succeeds or fails by offset and the number of the try."""

    def open(self):
        self.tries = {}

    def __call__(self, message):
        offset = message["offset"]
        self.tries[offset] = self.tries.get(offset, 0) + 1
        return (200 if (offset + self.tries[offset]) % 4 == 0 else 503), None


def no_wait(seconds: float) -> None:
    """Retry delays are left out where only the result counts."""


FIRST_OK = 'CAST(CASE WHEN 4 - "offset" % 4 <= 3 THEN 4 - "offset" % 4 END AS INTEGER)'


@query("retry", _check(f"""
SELECT {POS_SQL}, {FIRST_OK} IS NOT NULL AS delivered, coalesce({FIRST_OK}, 3) AS tries,
       status_code, TRUE AS retried
FROM outcomes WHERE {FAILED} AND {action()} = 'RETRY'"""))
def retry(spark, sf):
    rows = routing.with_action(failures(spark, sf)).filter(F.col("action") == status.RETRY)
    return delivery.retry(rows, FlakyTransport(), 3, sleep=no_wait).select(
        *POS, "delivered", F.size("attempts").alias("tries"), "status_code", "retried")


@query("resolve_attempts", sql([OUTCOMES, ATTEMPTS], f"""
SELECT o.topic, o."partition", o."offset", a.delivered_at, coalesce(a.delivered_at, a.last) AS tries,
       CASE WHEN a.delivered_at IS NOT NULL THEN 'DELIVERED' ELSE {action('TRUE')} END AS disposition
FROM outcomes o LEFT JOIN (
  SELECT {POS_SQL}, min(attempt) FILTER (WHERE ok) AS delivered_at, max(attempt) AS last
  FROM attempts GROUP BY ALL) a
ON o."offset" = a."offset" AND o."partition" = a."partition"
WHERE {FAILED} AND {action()} = 'RETRY'"""))
def resolve_attempts(spark, sf):
    rows = routing.with_action(failures(spark, sf)).filter(F.col("action") == status.RETRY)
    return routing.resolve_attempts(rows, topics.attempts(spark, sf)).select(
        *POS, "delivered_at", "tries", "disposition")


@query("handle_failures", _check(f"""
SELECT {action()} AS action, error_type, count(*) AS messages FROM outcomes WHERE {FAILED}
GROUP BY 1, 2"""))
def handle_failures(spark, sf):
    halves = routing.handle_failures(failures(spark, sf))
    counted = [rows.groupBy("action", "error_type").agg(F.count("*").alias("messages"))
               for rows in halves.values()]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


@query("fail_on", _check(f"SELECT {POS_SQL}, {action()} AS action FROM outcomes WHERE {FAILED}"))
def fail_on(spark, sf):
    return routing.fail_on(routing.with_action(failures(spark, sf))).select(*POS, "action")


@query("batch_error", sql([EVENTS], f"""
SELECT {POS_SQL}, 'DEFAULT_ERROR' AS error_type, CAST(0 AS INTEGER) AS status_code,
       'sink is gone' AS error_message, FALSE AS retried FROM messages"""))
def batch_error(spark, sf):
    return delivery.batch_error(topics.event_messages(spark, sf), "sink is gone").select(
        *POS, "error_type", "status_code", "error_message", "retried")


GRPC_NAMES = ["OK", "InvalidArgument", "NotFound", "AlreadyExists", "PermissionDenied",
              "Unavailable", "DeadlineExceeded", "ResourceExhausted", "Aborted", "Internal"]


@query("classify_grpc", """
SELECT event_id, event_id % 10 = 0 AS success,
       CASE WHEN event_id % 10 = 0 THEN 'NONE' WHEN event_id % 10 < 5 THEN 'SINK_4XX_ERROR'
            ELSE 'SINK_5XX_ERROR' END AS error_type,
       CAST(CASE WHEN event_id % 10 = 0 THEN 200 WHEN event_id % 10 < 5 THEN 400
            WHEN event_id % 10 < 9 THEN 503 ELSE 500 END AS INTEGER) AS status_code FROM events""")
def classify_grpc(spark, sf):
    name = F.element_at(F.array(*map(F.lit, GRPC_NAMES)), (F.col("event_id") % 10 + 1).cast("int"))
    return topics.table(spark, sf, "events").select(
        "event_id", status.classify_grpc(name).alias("c")).select("event_id", "c.*")


@query("classify_store_error", """
SELECT event_id, CASE WHEN event_id % 6 IN (0, 1, 3, 5) THEN 'SINK_4XX_ERROR' ELSE 'SINK_5XX_ERROR' END
         AS error_type,
       CAST(CASE WHEN event_id % 6 IN (0, 1, 3, 5) THEN 409 ELSE 500 END AS INTEGER) AS status_code,
       event_id % 6 IN (0, 1, 3, 5) AS retried FROM events""")
def classify_store_error(spark, sf):
    kind = F.col("event_id") % 6
    code = F.when(kind == 0, 11000).when(kind == 2, 133).when(kind == 3, 13).when(kind == 4, 6)
    text = F.when(kind == 1, "violates unique constraint").when(kind == 5, "SQLSTATE 23505").otherwise("x")
    return topics.table(spark, sf, "events").select(
        "event_id", status.classify_store_error(code, text, [13]).alias("c")).select("event_id", "c.*")
