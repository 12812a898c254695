"""What happens to failed messages: actions, dead letters and retry plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.functions import status
from relay.functions.status import Ranges
from relay.operators.positions import join_per_key
from relay.session import stage
from relay.sources.envelope import POSITION

ACTIONS = (status.RETRY, status.DLQ, status.IGNORE, status.FAIL)


@dataclass(frozen=True)
class RouteRanges:
    retry: Ranges = status.DEFAULT_RETRY
    dlq: Ranges = status.DEFAULT_DLQ
    fail: Ranges = status.DEFAULT_FAIL

    def action(self, code: Column | str = "status_code", retried: Column | str = "retried") -> Column:
        return status.route(code, retried, self.retry, self.dlq, self.fail)


def with_action(failures: DataFrame, ranges: RouteRanges = RouteRanges()) -> DataFrame:
    """Add `action` to failed messages."""
    return failures.withColumn("action", ranges.action())


def in_ranges_table(rows: DataFrame, ranges: DataFrame, code: str = "status_code", key: str = "sink",
                    name: str = "in_range", bin_width: int = 100) -> DataFrame:
    """Add whether `code` is in one of the ranges (`start`, `end`, inclusive) that a table
    gives for the row's `key`. Ranges may overlap; codes or keys without a range are in none.

    An interval join by bins: a range is told once for each bin of `bin_width` codes it
    touches, so a row meets the ranges of its own bin in an equi-join. Ranges of a bin
    are one list, so overlaps do not multiply rows, and a hot key is salted.
    """
    def bin_of(value: Column) -> Column:
        return F.floor(value / bin_width).cast("long")

    spans = ranges.filter(F.col("start") <= F.col("end")).select(
        key, F.struct("start", "end").alias("_range"),
        F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end")))).alias("_bin"))
    lists = spans.groupBy(key, "_bin").agg(F.collect_set("_range").alias("_ranges"))
    inside = F.exists("_ranges", lambda r: (F.col(code) >= r["start"]) & (F.col(code) <= r["end"]))
    binned = rows.withColumns({"_bin": bin_of(F.col(code)), "_spread": F.abs(F.xxhash64(*rows.columns) % 1024)})
    return (join_per_key(binned, lists, [key, "_bin"], "_spread", "left")
            .withColumn(name, F.coalesce(inside, F.lit(False))).select(*rows.columns, name))


def to_dlq(failures: DataFrame) -> DataFrame:
    """Dead letters: key and value unchanged, where and why in the headers."""
    texts = {
        "original_topic": F.col("topic"),
        "original_partition": F.col("partition").cast("string"),
        "original_offset": F.col("offset").cast("string"),
        "error_type": F.col("error_type"),
        "error_status_code": F.col("status_code").cast("string"),
        "error_message": F.col("error_message"),
    }
    headers = F.array(*[
        F.struct(F.lit(name).alias("key"), text.cast("binary").alias("value"))
        for name, text in texts.items()
    ])
    return failures.select("key", "value", headers.alias("headers"))


def retry_schedule(failures: DataFrame, max_attempts: int = 3, initial: int = 100,
                   maximum: int = 10_000, multiplier: float = 2.0) -> DataFrame:
    """One row per planned attempt with its delay and the time waited so far.

    The plan is the same for every message, so it is a constant array: rows are
    exploded in place, with no window and no shuffle.
    """
    attempts = F.sequence(F.lit(1), F.lit(max_attempts))

    def delay(attempt: Column) -> Column:
        return status.backoff_ms(attempt, initial, maximum, multiplier)

    def waited(attempt: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), attempt), F.lit(0).cast("bigint"),
                           lambda total, a: total + delay(a))

    plan = F.transform(attempts, lambda a: F.struct(
        a.alias("attempt"), delay(a).alias("delay_ms"), waited(a).alias("elapsed_ms")))
    return failures.select("*", F.inline(plan))


def resolve_attempts(failures: DataFrame, attempts: DataFrame, max_attempts: int = 3,
                     ranges: RouteRanges = RouteRanges()) -> DataFrame:
    """Final disposition of retried messages from their attempt log.

    `attempts` has (topic, partition, offset, attempt, ok). The first success
    within the limit delivers; otherwise the original error is routed again as
    retried. Adds `delivered_at`, `tries` and `disposition`.
    """
    counted = F.col("attempt") <= max_attempts
    tried = attempts.filter(counted).groupBy(*POSITION).agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("delivered_at"),
        F.max("attempt").alias("_last"))
    again = ranges.action("status_code", F.lit(True))
    return (
        failures.join(tried, POSITION, "left")
        .withColumns({
            "tries": F.coalesce("delivered_at", "_last", F.lit(0)),
            "disposition": F.when(F.col("delivered_at").isNotNull(), "DELIVERED").otherwise(again),
            "retried": F.lit(True),
        })
        .drop("_last")
    )


def handle_failures(failures: DataFrame, ranges: RouteRanges = RouteRanges(),
                    staged: bool = True) -> dict[str, DataFrame]:
    """One DataFrame per action. The routed rows are written once to the shared
    folder, so delivery upstream is not repeated per action."""
    routed = with_action(failures, ranges)
    if staged:
        routed = stage(routed, "routed")
    return {action: routed.filter(F.col("action") == action) for action in ACTIONS}


def fail_on(routed: DataFrame) -> DataFrame:
    """Stop the job with an error when a row's action is FAIL."""
    text = F.concat(F.lit("FAIL action at "), F.concat_ws("/", *POSITION),
                    F.lit(": "), F.coalesce("error_message", F.lit("")))
    action = F.when(F.col("action") == status.FAIL, F.raise_error(text).cast("string"))
    return routed.withColumn("action", action.otherwise(F.col("action")))
