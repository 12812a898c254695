"""All queries and checks, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relay.functions import predicates as p
from relay.operators import batching, delivery, routing
from relay.plans import delivery_queries, filter_queries, table_queries, topics  # noqa: F401
from relay.plans.registry import CHECKS, QUERIES, Query, query
from relay.plans.topics_sql import DEAD, RETRYABLE, chunks, sql
from relay.session import stage

PURCHASE = "o->>'$.status' = 'purchase' AND CAST(o->>'$.value' AS DOUBLE) > 100"


@query("message_routing", sql([chunks(100, PURCHASE)], f"""
SELECT "partition", action, error_type, count(*) AS messages FROM (
  SELECT "partition", status_code,
         CASE status_code WHEN 503 THEN 'SINK_5XX_ERROR' WHEN 404 THEN 'SINK_4XX_ERROR'
              ELSE 'SINK_UNKNOWN_ERROR' END AS error_type,
         CASE WHEN status_code = 0 OR {RETRYABLE} THEN 'RETRY' WHEN {DEAD} THEN 'DLQ'
              ELSE 'IGNORE' END AS action
  FROM (SELECT "partition", CAST(CASE first_offset % 4 WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 404
               ELSE 0 END AS INTEGER) AS status_code FROM members))
WHERE status_code <> 200 GROUP BY 1, 2, 3"""))
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode, filter, batch, build bodies, take the sink's answer, fail, route, count."""
    messages = topics.objects(topics.event_messages(spark, sf_dir))
    wanted = p.eq("status", "purchase") & p.gt("value", 100)
    # Read twice, for the bodies and for the failures: decoded and cut only once.
    members = stage(batching.split_max(batching.chunk(
        messages.filter(p.truthy(wanted)).drop("message"), 100, delivery_queries.SPAN)), "members")
    kind = F.col("first_offset") % 4
    outcomes = batching.batch_body(members).withColumns({
        "status_code": F.when(kind == 0, 200).when(kind == 1, 503).when(kind == 2, 404).otherwise(0),
        "error": F.when(kind == 3, "refused")})
    failures = delivery.expand_batch_failure(outcomes, members)
    return (routing.with_action(failures).groupBy("partition", "action", "error_type")
            .agg(F.count("*").alias("messages")))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
