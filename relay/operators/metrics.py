"""Delivery metrics as aggregate tables over the ledger.

Ledger columns used here: topic, partition, offset, stage (reject, invalid,
dropped, sent), reason, sink, batch_id, status_code, error_type, failed (at the
first delivery), attempt, action, dead_letter. Every table is a grouped
aggregate, so Spark combines before the shuffle and a hot group costs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.functions import status
from relay.operators.batching import PARTITION

SENT = "sent"
DROPPED = "dropped"
INVALID = "invalid"
REJECT = "reject"

# Upper bounds of the latency buckets, in seconds.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def consumed(ledger: DataFrame) -> DataFrame:
    """Records read per partition, and how many of them passed the filter."""
    return ledger.groupBy(*PARTITION).agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("stage") == SENT).alias("passed"))


def filtered(ledger: DataFrame) -> DataFrame:
    return (ledger.filter(F.col("stage") == DROPPED).groupBy("topic")
            .agg(F.count("*").alias("messages")))


def delivered(ledger: DataFrame) -> DataFrame:
    """Messages delivered by the first request of their batch, per sink."""
    return (ledger.filter(F.col("stage") == SENT).groupBy("sink")
            .agg(F.count_if(~F.col("failed")).alias("messages")))


def _by_error_type(ledger: DataFrame, condition) -> DataFrame:
    return ledger.filter(condition).groupBy("error_type").agg(F.count("*").alias("messages"))


def retried(ledger: DataFrame) -> DataFrame:
    """Messages whose first action was a retry."""
    return _by_error_type(ledger, F.col("action") == status.RETRY)


def dead_lettered(ledger: DataFrame) -> DataFrame:
    """Messages that ended in the dead letters, at once or after retries."""
    return _by_error_type(ledger, F.col("disposition") == status.DLQ)


def ignored(ledger: DataFrame) -> DataFrame:
    """Messages given up, at once or after retries."""
    return _by_error_type(ledger, F.col("disposition") == status.IGNORE)


def latency_histogram(outcomes: DataFrame) -> DataFrame:
    """Cumulative buckets, sum and count of request latency per sink.

    One row per (sink, upper bound); the last bound is infinite.
    """
    counts = [F.count_if(F.col("latency_s") <= bound).alias(f"b{i}")
              for i, bound in enumerate(LATENCY_BUCKETS)]
    wide = outcomes.groupBy("sink").agg(
        *counts, F.count("latency_s").alias("count"), F.sum("latency_s").alias("sum_s"))
    buckets = [F.struct(F.lit(bound).alias("le"), F.col(f"b{i}").alias("cumulative"))
               for i, bound in enumerate(LATENCY_BUCKETS)]
    buckets.append(F.struct(F.lit(float("inf")).alias("le"), F.col("count").alias("cumulative")))
    return wide.select("sink", F.inline(F.array(*buckets)), "count", "sum_s")


def lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Records behind the end per partition (one past the last offset)."""
    ends = end_offsets.groupBy(*PARTITION).agg((F.max("offset") + 1).alias("end_offset"))
    return ends.join(committed, PARTITION, "left").select(
        *PARTITION, (F.col("end_offset") - F.coalesce("next_offset", F.lit(0))).alias("lag"))


def breaker_open(states: DataFrame) -> DataFrame:
    """Gauge per sink: 1 while the breaker is open."""
    return states.groupBy("sink").agg(
        F.max_by("is_open", "position").cast("int").alias("open"))


def response_codes(ledger: DataFrame) -> DataFrame:
    """Messages by the status of their first delivery; 0 is no response."""
    return (ledger.filter((F.col("stage") == SENT) & (F.col("status_code") > 0))
            .groupBy("status_code").agg(F.count("*").alias("messages")))


def offset_commits(commits: DataFrame) -> DataFrame:
    return commits.groupBy(*PARTITION).agg(F.count("*").alias("commits"))


def validation_failures(ledger: DataFrame) -> DataFrame:
    return (ledger.filter(F.col("stage") == INVALID).groupBy("reason")
            .agg(F.count("*").alias("messages")))
