"""Topics, outcomes, responses and ledgers derived from the given tables.

Everything here is row-local: a source key that is unique and ascending serves
as offset (offsets in a topic may have gaps), so no table is shuffled just to
become a topic. Each DataFrame has its SQL twin in `relay.plans.topics_sql`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relay.operators.decode import decode_json
from relay.session import configure
from relay.sources.envelope import to_envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


EVENT_VALUE = """
CASE event_id % 20
  WHEN 0 THEN 'not json'
  WHEN 1 THEN concat('{"event_id":', event_id, ',"status":null,"value":', v, '}')
  WHEN 2 THEN concat('{"event_id":', event_id, ',"value":', v, '}')
  WHEN 3 THEN concat('{"event_id":', event_id, ',"status":5,"value":', v, '}')
  WHEN 4 THEN concat('[', event_id, ']')
  ELSE concat('{"event_id":', event_id, ',"user_id":', user_id, ',"status":"', event_type,
              '","value":', v, ',"props":', props, '}')
END"""

ORDER_VALUE = """
concat('{"order":{"id":', o_orderkey, ',"status":"', o_orderstatus,
       '","urgent":', CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END,
       ',"payment":{"amount":', amount, '}},"tags":',
       CASE o_orderkey % 3
         WHEN 0 THEN '[]'
         WHEN 1 THEN concat('["', o_orderstatus, '"]')
         ELSE concat('["', o_orderstatus, '","', o_orderpriority, '"]')
       END,
       ',"lines":[{"kind":"', o_orderstatus, '","qty":', o_orderkey % 7,
       '},{"kind":"', o_orderpriority, '","qty":', o_orderkey % 5, '}]}')"""

KEYED_VALUE = """
concat('{"customer":', o_custkey, ',"order":', o_orderkey,
       CASE WHEN o_orderkey % 5 = 0 THEN ',"status":null'
            WHEN o_orderkey % 3 <> 0 THEN concat(',"status":"', o_orderstatus, '"')
            ELSE '' END,
       CASE WHEN o_orderkey % 4 = 0 THEN concat(',"amount":', amount) ELSE '' END, '}')"""

STATUS_CODE = """
CAST(CASE event_id % 10 WHEN 0 THEN 503 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 408
     WHEN 4 THEN 422 WHEN 5 THEN 0 WHEN 6 THEN 302 ELSE 200 END AS INT)"""


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `events`: five kinds of payload, partition by user."""
    events = table(spark, sf_dir, "events").withColumn("v", F.col("value").cast("decimal(12,2)"))
    return to_envelope(events, "events", F.expr("user_id % 4"), "event_id", "user_id",
                       F.expr(EVENT_VALUE))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `orders`: nested objects and lists."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "amount", F.col("o_totalprice").cast("decimal(12,2)"))
    return to_envelope(orders, "orders", F.expr("o_custkey % 4"), "o_orderkey", "o_orderkey",
                       F.expr(ORDER_VALUE))


def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `customers`: many messages per customer, with absent and null fields."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "amount", F.col("o_totalprice").cast("decimal(12,2)"))
    return to_envelope(orders, "customers", F.expr("o_custkey % 4"), "o_orderkey",
                       F.expr("CASE WHEN o_orderkey % 10 <> 7 THEN o_custkey END"),
                       F.expr(KEYED_VALUE))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `documents`: whole texts as payload."""
    documents = table(spark, sf_dir, "documents")
    return to_envelope(documents, "documents", F.expr("doc_id % 4"), "doc_id", "doc_id",
                       F.to_json(F.struct("doc_id", "lang", "text"), {"ignoreNullFields": "false"}))


def objects(messages: DataFrame) -> DataFrame:
    """Messages with `message` parsed; NULL unless the payload is an object."""
    return decode_json(messages, objects_only=True)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed and successful deliveries of single messages of topic `events`."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.lit("events").alias("topic"), F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"), F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("event_type").cast("binary").alias("value"), F.col("event_type").alias("sink"),
        F.expr(STATUS_CODE).alias("status_code"), F.expr("event_id % 3 = 0").alias("retried"),
        F.concat(F.lit("error "), F.col("event_id").cast("string")).alias("error_message"),
        (F.col("value") / 100).alias("latency_s"), F.col("ts"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt log of every message of topic `events`."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.explode(F.expr("sequence(1, 3)")).alias("attempt"),
    ).withColumn("ok", F.expr("(offset + attempt) % 4 = 0"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record of topic `events` with all columns the metrics use."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr("concat('events-', user_id % 4, '-', event_id div 100)").alias("batch_id"),
        F.expr("CASE event_id % 20 WHEN 0 THEN 'reject' WHEN 1 THEN 'invalid' WHEN 2 THEN 'invalid' "
               "WHEN 3 THEN 'dropped' WHEN 4 THEN 'dropped' ELSE 'sent' END").alias("stage"),
        F.expr("CASE event_id % 20 WHEN 1 THEN 'status is text' WHEN 2 THEN 'has status' END")
        .alias("reason"),
        F.col("event_type").alias("sink"), F.expr(STATUS_CODE).alias("status_code"),
        F.expr("event_id % 3 = 0").alias("retried"),
        (F.col("value") / 100).alias("latency_s"),
        F.expr("(event_id div 100) % 7 <> 5").alias("done"))


def batch_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order, with `size` 7 and entries that are missing, repeated,
    out of range, numeric strings or mistyped, by the order's key."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("request_id"),
        F.lit(7).alias("size"), F.expr(RESPONSE_BODY).alias("response_body"))


RESPONSE_BODY = """
CASE o_orderkey % 10
  WHEN 8 THEN 'oops'
  WHEN 9 THEN '{"items":[]}'
  ELSE concat('{"results":[{"seq":0,"status":"success"},{"seq":"1","status":"',
              CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failed' END,
              '","error":"bad ', o_orderkey, '","is_retryable":',
              CASE WHEN o_orderkey % 4 = 0 THEN 'true' ELSE 'false' END,
              '},{"seq":2,"status":5},{"seq":', o_orderkey % 9,
              ',"status":"failed","error":7,"is_retryable":"yes"},{"seq":3,"status":"failed","is_retryable":true},',
              '{"seq":3,"status":"success"},{"seq":"x","status":"success"},{"status":"success"}]}')
END"""
