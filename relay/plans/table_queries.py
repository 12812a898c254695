"""Keyed tables, the ledger, metrics and the breaker."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from relay.functions import status
from relay.functions.keys import build_key, hash_field, ttl_expiry
from relay.operators import breaker, ledger, metrics, routing, tables
from relay.plans import topics
from relay.plans.registry import CHECKS, query
from relay.plans.topics_sql import ATTEMPTS, EVENTS, KEYED, LEDGER, OUTCOMES, PARSED, action, sql
from relay.session import shared_dir, stage
from relay.streaming.keyed import KeyedTable
from relay.streaming.stores import Stores

POS = ["topic", "partition", "offset"]
POS_SQL = 'topic, "partition", "offset"'
TYPES = {"customer": "bigint", "order": "bigint", "status": "string", "amount": "double"}


def _keyed(spark, sf):
    return topics.objects(topics.keyed_messages(spark, sf))


# --- keyed tables ---------------------------------------------------------------------

@query("split_bad_json", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, CASE WHEN o IS NULL THEN 'DESERIALIZATION_ERROR' END AS error_type FROM objects"""))
def split_bad_json(spark, sf):
    good, bad = tables.split_bad_json(topics.event_messages(spark, sf))
    return good.select(*POS, F.lit(None).cast("string").alias("error_type")).unionByName(
        bad.select(*POS, "error_type"))


@query("json_to_columns", sql([KEYED], f"""
SELECT {POS_SQL}, CAST(CAST(value AS JSON)->>'$.amount' AS DOUBLE) AS amount,
       CAST(value AS JSON)->>'$.customer' AS customer,
       CAST(value AS JSON)->>'$.order' AS "order", CAST(value AS JSON)->>'$.status' AS status
FROM messages"""))
def json_to_columns(spark, sf):
    # The engines print whole decimals differently (7 and 7.0): compare amounts as numbers.
    rows = tables.json_to_columns(_keyed(spark, sf), ["amount", "customer", "order", "status"])
    return rows.withColumn("amount", F.col("amount").cast("double"))


@query("json_to_rows", sql([KEYED], f"""
SELECT {POS_SQL}, name, CASE WHEN name <> 'amount' THEN v END AS value,
       CASE WHEN name = 'amount' THEN CAST(v AS DOUBLE) END AS amount
FROM (SELECT *, CAST(value AS JSON)->>('$.' || name) AS v
      FROM messages, (VALUES ('amount'), ('customer'), ('order'), ('status')) AS names(name))
WHERE v IS NOT NULL"""))
def json_to_rows(spark, sf):
    rows = tables.json_to_rows(_keyed(spark, sf)).filter("value IS NOT NULL")
    amount = F.col("name") == "amount"
    return rows.select(*POS, "name", F.when(~amount, F.col("value")).alias("value"),
                       F.when(amount, F.col("value").cast("double")).alias("amount"))


@query("json_to_typed_columns", sql([KEYED], f"""
SELECT {POS_SQL}, CAST(CAST(value AS JSON)->>'$.amount' AS DOUBLE) AS amount,
       CAST(CAST(value AS JSON)->>'$.customer' AS BIGINT) AS customer FROM messages"""))
def json_to_typed_columns(spark, sf):
    return tables.json_to_columns(_keyed(spark, sf), {"customer": "bigint", "amount": "double"})


INSERT_SQL = sql([KEYED], f"""
SELECT {POS_SQL}, customer, CASE WHEN won THEN 'inserted' ELSE 'duplicate' END AS half,
       CAST(CASE WHEN NOT won THEN 409 END AS INTEGER) AS status_code
FROM (
  SELECT *, row_number() OVER (PARTITION BY customer ORDER BY "partition", "offset") = 1
         AND customer NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS won
  FROM (SELECT *, CAST(CAST(value AS JSON)->>'$.customer' AS BIGINT) AS customer FROM messages))""")


@query("keyed_insert", INSERT_SQL)
def keyed_insert(spark, sf):
    rows = tables.json_to_columns(_keyed(spark, sf), TYPES)
    stored = topics.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("customer"))
    inserted, duplicates = tables.keyed_insert(rows, ["customer"], stored)
    return inserted.select(*POS, "customer", F.lit("inserted").alias("half"),
                           F.lit(None).cast("int").alias("status_code")).unionByName(
        duplicates.select(*POS, "customer", F.lit("duplicate").alias("half"), "status_code"))


LAST = """
flat AS (
  SELECT "partition", "offset", CAST(j->>'$.customer' AS BIGINT) AS customer,
         CAST(j->>'$.order' AS BIGINT) AS "order", json_exists(j, '$.status') AS has_status,
         j->>'$.status' AS status, json_exists(j, '$.amount') AS has_amount,
         CAST(j->>'$.amount' AS DOUBLE) AS amount
  FROM (SELECT *, CAST(value AS JSON) AS j FROM messages)),
latest AS (
  SELECT customer, arg_max("order", "offset") AS "order",
         coalesce(bool_or(has_status), FALSE) AS has_status,
         arg_max(coalesce(status, '<null>'), "offset") FILTER (WHERE has_status) AS status,
         coalesce(bool_or(has_amount), FALSE) AS has_amount,
         arg_max(amount, "offset") FILTER (WHERE has_amount) AS amount
  FROM flat GROUP BY customer)"""


@query("keyed_upsert", sql([KEYED, LAST], """
SELECT coalesce(l.customer, c.c_custkey) AS customer, l."order" AS "order",
       CASE WHEN l.has_status THEN nullif(l.status, '<null>') ELSE c.c_mktsegment END AS status,
       CASE WHEN l.has_amount THEN l.amount ELSE c.c_acctbal END AS amount
FROM latest l FULL OUTER JOIN customer c ON l.customer = c.c_custkey"""))
def keyed_upsert(spark, sf):
    target = topics.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer"), F.lit(None).cast("bigint").alias("order"),
        F.col("c_mktsegment").alias("status"), F.col("c_acctbal").alias("amount"))
    return tables.keyed_upsert(target, _keyed(spark, sf), ["customer"], TYPES)


@query("keyed_upsert_without_keys", sql([KEYED], """
SELECT CAST(CAST(value AS JSON)->>'$.customer' AS BIGINT) AS customer,
       CAST(CAST(value AS JSON)->>'$.order' AS BIGINT) AS "order" FROM messages
UNION ALL SELECT c_custkey, NULL FROM customer"""))
def keyed_upsert_without_keys(spark, sf):
    target = topics.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer"), F.lit(None).cast("bigint").alias("order"))
    return tables.keyed_upsert(target, _keyed(spark, sf), None,
                               {"customer": "bigint", "order": "bigint"})


def _cut(rows, count=4):
    """Rows in order of offsets, in parts, with their numbers."""
    last = rows.agg(F.max("offset")).first()[0] or 0
    for number in range(count):
        low, high = last * number // count, last * (number + 1) // count
        yield number, rows.filter((F.col("offset") > low) & (F.col("offset") <= high) if number
                                  else F.col("offset") <= high)


def _micro_batches(messages, count=4):
    """Messages cut into parts that are each parsed for themselves: the last offset is found
    without parsing."""
    for number, part in _cut(messages, count):
        yield number, topics.objects(part)


def _stored_table(spark, name, keys, target):
    table = KeyedTable(Stores(spark, f"{shared_dir(spark)}/relay-{name}-{uuid.uuid4().hex}"), name, keys, TYPES,
                       buckets=16, deltas=2, keep=8)
    table.load(target)
    return table


# The same result as merging all messages at once, from four micro-batches and a replay.
@query("keyed_sink_merge", CHECKS["keyed_upsert"])
def keyed_sink_merge(spark, sf):
    table = _stored_table(spark, "merge", ["customer"], topics.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer"), F.lit(None).cast("bigint").alias("order"),
        F.col("c_mktsegment").alias("status"), F.col("c_acctbal").alias("amount")))
    for number, part in _micro_batches(topics.keyed_messages(spark, sf)):
        table.upsert(part, number)
        table.upsert(part, number)
    return table.read().select("customer", "order", "status", "amount")


@query("keyed_sink_insert", INSERT_SQL)
def keyed_sink_insert(spark, sf):
    table = _stored_table(spark, "insert", ["customer"], topics.table(spark, sf, "customer").filter(
        "c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer"), *[
            F.lit(None).cast(t).alias(n) for n, t in TYPES.items() if n != "customer"]))
    halves = []
    for number, part in _micro_batches(topics.keyed_messages(spark, sf)):
        refused = table.insert(part, number)
        customer = F.expr("CAST(get_json_object(CAST(value AS STRING), '$.customer') AS BIGINT)")
        halves.append(refused.select(*POS, customer.alias("customer"), F.lit("duplicate").alias("half"), "status_code"))
    # In this topic an order is its own offset and customers have partitions.
    inserted = table.read().filter(F.col("order").isNotNull()).select(
        F.lit("customers").alias("topic"), (F.col("customer") % 4).cast("int").alias("partition"),
        F.col("order").alias("offset"), "customer", F.lit("inserted").alias("half"),
        F.lit(None).cast("int").alias("status_code"))
    return reduce(lambda a, b: a.unionByName(b), halves, inserted)


KEY = """CASE WHEN "offset" % 2 = 0 THEN concat('customer:', CAST(value AS JSON)->>'$.customer')
  ELSE coalesce(key, concat('relay:', "offset")) END"""


@query("build_key", sql([KEYED], f"""
SELECT {POS_SQL}, coalesce(key, concat('relay:', "offset")) AS own,
       concat('customer:', CAST(value AS JSON)->>'$.customer', ':') AS filled,
       concat('status:', coalesce(CAST(value AS JSON)->>'$.status', '')) AS status_key
FROM messages"""))
def build_key_(spark, sf):
    return _keyed(spark, sf).select(
        *POS, build_key().alias("own"), build_key("customer:%s:", "customer").alias("filled"),
        build_key("status:%s", "status").alias("status_key"))


@query("materialize_keyvalue", sql([KEYED], """
SELECT concat('c', CAST(value AS JSON)->>'$.customer') AS store_key, arg_max(value, "offset") AS value
FROM messages GROUP BY 1"""))
def materialize_keyvalue(spark, sf):
    return tables.materialize_keyvalue(_keyed(spark, sf), build_key("c%s", "customer")).select(
        "store_key", "value")


@query("materialize_hash", sql([KEYED], """
SELECT concat('c', CAST(value AS JSON)->>'$.customer') AS store_key,
       coalesce(CAST(value AS JSON)->>'$.status', '$.status') AS field,
       arg_max(value, "offset") AS value FROM messages GROUP BY 1, 2"""))
def materialize_hash(spark, sf):
    return tables.materialize_hash(_keyed(spark, sf), build_key("c%s", "customer"),
                                   hash_field("$.status"))


@query("materialize_list", sql([KEYED], """
SELECT concat('c', CAST(value AS JSON)->>'$.customer') AS store_key,
       row_number() OVER (PARTITION BY CAST(value AS JSON)->>'$.customer'
                          ORDER BY "partition" DESC, "offset" DESC) - 1 AS index, value
FROM messages"""))
def materialize_list(spark, sf):
    return tables.materialize_list(_keyed(spark, sf), build_key("c%s", "customer"))


@query("ttl_expiry", """
SELECT event_id, strftime(ts + INTERVAL 3600 SECOND, '%Y-%m-%d %H:%M:%S') AS expires_at,
       NULL::VARCHAR AS never, ts + INTERVAL 3600 SECOND > TIMESTAMP '2024-01-15 00:00:00' AS alive
FROM events""")
def ttl_expiry_(spark, sf):
    def text(column):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")

    expires = ttl_expiry("ts", "EX", 3600)
    return topics.table(spark, sf, "events").select(
        "event_id", text(expires).alias("expires_at"), text(ttl_expiry("ts")).alias("never"),
        (expires > F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).alias("alive"))


@query("materialize_alive", """
SELECT concat('u', user_id) AS store_key, arg_max(value, event_id) AS value FROM (
  SELECT user_id, event_id, concat('v', event_id) AS value, ts FROM events)
GROUP BY user_id HAVING max(ts) + INTERVAL 3600 SECOND > TIMESTAMP '2024-01-30 22:00:00'""")
def materialize_alive(spark, sf):
    messages = topics.table(spark, sf, "events").select(
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("value"), "user_id", "ts")
    entries = tables.materialize_keyvalue(
        messages, F.concat(F.lit("u"), F.col("user_id").cast("string")), ttl_expiry("ts", "EX", 3600))
    return tables.alive(entries, F.lit("2024-01-30 22:00:00").cast("timestamp_ntz")).select(
        "store_key", "value")


@query("write_table", sql([EVENTS], f"SELECT {POS_SQL}, value FROM messages"))
def write_table(spark, sf):
    path = f"{shared_dir(spark)}/relay-table-{uuid.uuid4().hex}"
    messages = topics.event_messages(spark, sf).withColumn("value", F.col("value").cast("string"))
    tables.write_table(messages.select(*POS, "value"), path, partition_by=["partition"])
    return spark.read.parquet(path).select(*POS, "value")


# --- ledger ---------------------------------------------------------------------------

def registered(spark, sf):
    """Offsets that wait for their batch."""
    sent = topics.ledger(spark, sf).filter(F.col("stage") == "sent")
    return sent.select(*POS, "batch_id", F.lit(False).alias("committable"))


def done_batches(spark, sf):
    """Batch ids reported as finished, among them unknown ones."""
    known = topics.ledger(spark, sf).filter("done").select("batch_id")
    return known.distinct().unionByName(
        known.select(F.concat(F.lit("unknown-"), "batch_id").alias("batch_id")).distinct())


def tracked(spark, sf):
    """Ledger with finished batches and skipped records marked."""
    marked = ledger.mark_done(registered(spark, sf), done_batches(spark, sf))
    skipped = topics.ledger(spark, sf).filter(F.col("stage") != "sent")
    return ledger.mark_immediate(marked, skipped)


TRACKED = f"""
tracked AS (SELECT {POS_SQL}, batch_id, stage <> 'sent' OR done AS committable FROM ledger),
gaps AS (SELECT topic, "partition", min("offset") AS gap FROM tracked WHERE NOT committable GROUP BY ALL),
next AS (
  SELECT t.topic, t."partition", max("offset") + 1 AS next_offset
  FROM tracked t LEFT JOIN gaps g ON t.topic = g.topic AND t."partition" = g."partition"
  WHERE gap IS NULL OR "offset" < gap GROUP BY t.topic, t."partition")"""


@query("mark_done", sql([LEDGER], f"""
SELECT {POS_SQL}, batch_id, done AS committable FROM ledger WHERE stage = 'sent'"""))
def mark_done(spark, sf):
    return ledger.mark_done(registered(spark, sf), done_batches(spark, sf))


@query("mark_immediate", sql([LEDGER, TRACKED], f"SELECT {POS_SQL}, committable FROM tracked"))
def mark_immediate(spark, sf):
    return tracked(spark, sf).select(*POS, "committable")


@query("committable_offsets", sql([LEDGER, TRACKED], """
SELECT topic, "partition", next_offset FROM next"""))
def committable_offsets(spark, sf):
    return ledger.committable_offsets(tracked(spark, sf))


ISLANDS = """
opened AS (
  SELECT *, count(*) FILTER (WHERE NOT committable) OVER (
    PARTITION BY topic, "partition" ORDER BY "offset") AS opened FROM tracked)"""


@query("ledger_intervals", sql([LEDGER, TRACKED, ISLANDS], """
SELECT topic, "partition", committable, min("offset") AS "first", max("offset") + 1 AS next
FROM opened GROUP BY topic, "partition", committable, opened"""))
def ledger_intervals(spark, sf):
    return ledger.intervals(tracked(spark, sf), width=1000)


# Four micro-batches one after the other, of which only the intervals are kept.
@query("commit_by_intervals", sql([LEDGER, TRACKED], """
SELECT topic, "partition", next_offset FROM next"""))
def commit_by_intervals(spark, sf):
    known = None
    for number, part in _cut(tracked(spark, sf)):
        known = stage(ledger.intervals(part, known), f"intervals-{number}")
    return ledger.committed(known)


@query("prune", sql([LEDGER, TRACKED], """
SELECT t.topic, t."partition", t."offset", t.committable
FROM tracked t LEFT JOIN next n ON t.topic = n.topic AND t."partition" = n."partition"
WHERE next_offset IS NULL OR t."offset" >= next_offset"""))
def prune(spark, sf):
    rows = tracked(spark, sf)
    return ledger.prune(rows, ledger.committable_offsets(rows)).select(*POS, "committable")


@query("commit_report", sql([LEDGER, TRACKED], """
SELECT n.topic, n."partition", CAST(CASE WHEN n."partition" > 0 THEN n."partition" * 300 END AS BIGINT)
  AS previous_offset, n.next_offset
FROM next n WHERE n."partition" = 0 OR n.next_offset > n."partition" * 300"""))
def commit_report(spark, sf):
    previous = topics.ledger(spark, sf).filter("partition > 0").select("topic", "partition").distinct()
    previous = previous.withColumn("next_offset", (F.col("partition") * 300).cast("bigint"))
    return ledger.commit_report(previous, ledger.committable_offsets(tracked(spark, sf)))


# --- metrics ---------------------------------------------------------------------------

def metric_ledger(spark, sf):
    """Ledger with error types, first actions and final dispositions."""
    failed = ~status.is_success("status_code")
    sent = F.col("stage") == "sent"
    ranges = routing.RouteRanges()
    rows = topics.ledger(spark, sf).withColumns({
        "error_type": status.error_type("status_code"), "failed": failed,
        "action": F.when(sent & failed, ranges.action())})
    again = ranges.action("status_code", F.lit(True))
    return rows.withColumn("disposition", F.when(F.col("action") == status.RETRY, again).otherwise(
        F.col("action")))


METRIC = f"""
metric AS (
  SELECT *, CASE WHEN action = 'RETRY' THEN {action('TRUE')} ELSE action END AS disposition FROM (
    SELECT *, NOT status_code BETWEEN 200 AND 299 AS failed,
           CASE WHEN stage = 'sent' AND NOT status_code BETWEEN 200 AND 299 THEN {action()} END AS action
    FROM ledger))"""


def _metric(select):
    return sql([LEDGER, METRIC], select)


@query("metric_consumed", _metric("""
SELECT topic, "partition", count(*) AS messages, count(*) FILTER (WHERE stage = 'sent') AS passed
FROM metric GROUP BY topic, "partition\""""))
def metric_consumed(spark, sf):
    return metrics.consumed(metric_ledger(spark, sf))


@query("metric_filtered", _metric("""
SELECT topic, count(*) AS messages FROM metric WHERE stage = 'dropped' GROUP BY topic"""))
def metric_filtered(spark, sf):
    return metrics.filtered(metric_ledger(spark, sf))


@query("metric_delivered", _metric("""
SELECT sink, count(*) FILTER (WHERE NOT failed) AS messages FROM metric WHERE stage = 'sent'
GROUP BY sink"""))
def metric_delivered(spark, sf):
    return metrics.delivered(metric_ledger(spark, sf))


@query("metric_retried", _metric("""
SELECT error_type, count(*) AS messages FROM metric WHERE action = 'RETRY' GROUP BY error_type"""))
def metric_retried(spark, sf):
    return metrics.retried(metric_ledger(spark, sf))


@query("metric_dead_lettered", _metric("""
SELECT error_type, count(*) AS messages FROM metric WHERE disposition = 'DLQ' GROUP BY error_type"""))
def metric_dead_lettered(spark, sf):
    return metrics.dead_lettered(metric_ledger(spark, sf))


@query("metric_ignored", _metric("""
SELECT error_type, count(*) AS messages FROM metric WHERE disposition = 'IGNORE' GROUP BY error_type"""))
def metric_ignored(spark, sf):
    return metrics.ignored(metric_ledger(spark, sf))


@query("metric_latency", sql([OUTCOMES], """
SELECT o.sink, b.le, count(*) FILTER (WHERE latency_s <= b.le) AS cumulative, count(*) AS count,
       round(sum(latency_s), 3) AS sum_s
FROM outcomes o, (VALUES (0.001::DOUBLE), (0.005), (0.01), (0.025), (0.05), (0.1), (0.25), (0.5),
  (1.0), (2.5), (5.0), (10.0), ('Infinity'::DOUBLE)) AS b(le)
GROUP BY o.sink, b.le"""))
def metric_latency(spark, sf):
    histogram = metrics.latency_histogram(topics.outcomes(spark, sf))
    return histogram.withColumn("sum_s", F.round("sum_s", 3))


@query("metric_lag", sql([LEDGER, TRACKED], """
SELECT e.topic, e."partition", e.end_offset - coalesce(next_offset, 0) AS lag
FROM (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM ledger GROUP BY ALL) e
LEFT JOIN next n ON e.topic = n.topic AND e."partition" = n."partition\""""))
def metric_lag(spark, sf):
    committed = ledger.committable_offsets(tracked(spark, sf))
    return metrics.lag(topics.ledger(spark, sf), committed)


@query("metric_response_codes", _metric("""
SELECT status_code, count(*) AS messages FROM metric WHERE stage = 'sent' AND status_code > 0
GROUP BY status_code"""))
def metric_response_codes(spark, sf):
    return metrics.response_codes(metric_ledger(spark, sf))


@query("metric_offset_commits", sql([LEDGER], """
SELECT topic, "partition", count(DISTINCT batch_id) AS commits FROM ledger WHERE done
GROUP BY topic, "partition\""""))
def metric_offset_commits(spark, sf):
    commits = topics.ledger(spark, sf).filter("done").select("topic", "partition", "batch_id").distinct()
    return metrics.offset_commits(commits)


@query("metric_validation_failures", _metric("""
SELECT reason, count(*) AS messages FROM metric WHERE stage = 'invalid' GROUP BY reason"""))
def metric_validation_failures(spark, sf):
    return metrics.validation_failures(metric_ledger(spark, sf))


# --- breaker ---------------------------------------------------------------------------

def sink_outcomes(spark, sf):
    """Outcomes per sink in order of time. Sinks fail more in some stretches."""
    return topics.table(spark, sf, "events").select(
        F.col("event_type").alias("sink"), F.col("event_id").alias("seq"),
        F.expr("NOT (event_id % 10 < 5 OR (event_id div 1000) % 2 = 0 AND event_id % 10 < 9)")
        .alias("success"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("at_s"))


STATES = """
outs AS (
  SELECT event_type AS sink, event_id AS seq,
         NOT (event_id % 10 < 5 OR ((event_id // 1000) % 2 = 0 AND event_id % 10 < 9)) AS success
  FROM events),
states AS (
  SELECT sink, seq, row_number() OVER w - 1 AS position,
         CAST(count(*) FILTER (WHERE NOT success) OVER r AS BIGINT) AS failures,
         count(*) OVER r = 100
           AND (count(*) FILTER (WHERE NOT success) OVER r) * 100 // 100 >= 80 AS is_open
  FROM outs WINDOW w AS (PARTITION BY sink ORDER BY seq),
                   r AS (PARTITION BY sink ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))"""


@query("breaker_state", sql([STATES], "SELECT sink, seq, position, failures, is_open FROM states"))
def breaker_state(spark, sf):
    return breaker.breaker_state(sink_outcomes(spark, sf)).select(
        "sink", "seq", "position", "failures", "is_open")


@query("metric_breaker_open", sql([STATES], """
SELECT sink, CAST(arg_max(is_open, position) AS INTEGER) AS open FROM states GROUP BY sink"""))
def metric_breaker_open(spark, sf):
    return metrics.breaker_open(breaker.breaker_state(sink_outcomes(spark, sf)))


# For every row at which a breaker could open: the first later row that is cool or, if
# not later than that, the first one an hour later; then the chain from each sink's first.
RESET = """
timed AS (SELECT s.*, epoch_us(e.ts) AS at_us FROM states s JOIN events e ON s.seq = e.event_id),
running AS (SELECT *, max(at_us) OVER (PARTITION BY sink ORDER BY position) AS m FROM timed),
cool AS (
  SELECT sink, position, is_open, m,
         min(position) FILTER (WHERE NOT is_open) OVER (
           PARTITION BY sink ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS cool_at
  FROM running),
late AS (
  SELECT a.sink, a.position, a.cool_at, min(b.position) AS reset_at
  FROM cool a LEFT JOIN running b ON a.sink = b.sink AND b.position > a.position AND b.m >= a.m + 3600000000
  WHERE a.is_open GROUP BY ALL),
ends AS (
  SELECT sink, position, least(cool_at, reset_at) AS ends,
         CASE WHEN reset_at IS NOT NULL AND (cool_at IS NULL OR reset_at <= cool_at) THEN reset_at + 99
              ELSE cool_at END AS wanted
  FROM late),
edges AS (
  SELECT e.sink, e.position, e.ends, min(s.position) AS next
  FROM ends e LEFT JOIN states s ON e.sink = s.sink AND s.is_open AND s.position >= e.wanted GROUP BY ALL),
chain AS (
  SELECT sink, min(position) AS position FROM states WHERE is_open GROUP BY sink
  UNION
  SELECT e.sink, e.next FROM chain c JOIN edges e ON c.sink = e.sink AND c.position = e.position
  WHERE e.next IS NOT NULL)"""


@query("breaker_with_reset", sql([STATES, RESET], """
SELECT sink, seq, position, failures, EXISTS (
  SELECT 1 FROM chain c JOIN edges e ON c.sink = e.sink AND c.position = e.position
  WHERE c.sink = s.sink AND c.position <= s.position AND (e.ends IS NULL OR s.position < e.ends)) AS is_open
FROM states s""").replace("WITH ", "WITH RECURSIVE ", 1))
def breaker_with_reset(spark, sf):
    return breaker.breaker_with_reset(sink_outcomes(spark, sf), reset_s=3600.0).select(
        "sink", "seq", "position", "failures", "is_open")


@query("breaker_feed", sql([LEDGER, ATTEMPTS], """
SELECT b.sink, b.batch_id, first_offset, CAST(-1 AS BIGINT) AS "offset", CAST(0 AS INTEGER) AS attempt,
       NOT failed AS success
FROM (SELECT 'http' AS sink, batch_id, min("offset") AS first_offset,
             bool_or(NOT status_code BETWEEN 200 AND 299) AS failed
      FROM ledger WHERE stage = 'sent' GROUP BY batch_id) b
UNION ALL
SELECT 'http', l.batch_id, b.first_offset, a."offset", a.attempt, a.ok
FROM attempts a
JOIN ledger l ON a."offset" = l."offset" AND a."partition" = l."partition"
JOIN (SELECT batch_id, min("offset") AS first_offset FROM ledger WHERE stage = 'sent' GROUP BY batch_id) b
  ON l.batch_id = b.batch_id
WHERE l.stage = 'sent' AND NOT l.status_code BETWEEN 200 AND 299"""))
def breaker_feed(spark, sf):
    sent = topics.ledger(spark, sf).filter(F.col("stage") == "sent")
    batches = sent.groupBy("batch_id").agg(F.min("offset").alias("first_offset"))
    failed = sent.filter(~status.is_success("status_code"))
    tried = (failed.select(*POS, "batch_id").join(topics.attempts(spark, sf), POS)
             .join(batches, "batch_id").withColumn("sink", F.lit("http")))
    return breaker.breaker_feed(batches.withColumn("sink", F.lit("http")), failed, tried)


@query("defer_when_open", sql([STATES], """
SELECT e.event_id, coalesce(s.is_open, FALSE) AS deferred FROM events e
LEFT JOIN (SELECT sink, arg_max(is_open, position) AS is_open FROM states GROUP BY sink) s
ON e.event_type = s.sink"""))
def defer_when_open(spark, sf):
    latest = breaker.latest_state(breaker.breaker_state(sink_outcomes(spark, sf)))
    requests = topics.table(spark, sf, "events").select(
        F.col("event_type").alias("sink"), F.col("event_id").alias("first_offset"))
    send, deferred = breaker.defer_when_open(requests, latest)
    return send.select(F.col("first_offset").alias("event_id"), F.lit(False).alias("deferred")).unionByName(
        deferred.select(F.col("first_offset").alias("event_id"), F.lit(True).alias("deferred")))
