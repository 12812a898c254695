"""Circuit breaker over the recent outcomes of each sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relay.operators.positions import (
    SLOT_WIDTH,
    join_per_key,
    number_rows,
    rolling,
    running_max,
    running_sum,
)
from relay.session import stage

WINDOW = 100
THRESHOLD = 80


def breaker_feed(outcomes: DataFrame, failures: DataFrame, attempts: DataFrame) -> DataFrame:
    """Outcomes that count: one per batch, then one per retry attempt.

    A batch counts as failed when any of its messages failed. `outcomes` has
    (sink, batch_id, first_offset), `failures` has batch_id, `attempts` has
    (sink, batch_id, first_offset, offset, attempt, ok). Ordered by
    (first_offset, offset, attempt); batches have offset -1.
    """
    failed = failures.select("batch_id").distinct().withColumn("_failed", F.lit(True))
    batches = outcomes.join(failed, "batch_id", "left").select(
        "sink", "batch_id", "first_offset", F.lit(-1).cast("bigint").alias("offset"),
        F.lit(0).alias("attempt"), F.col("_failed").isNull().alias("success"))
    return batches.unionByName(attempts.select(
        "sink", "batch_id", "first_offset", "offset", "attempt", F.col("ok").alias("success")))


def _open(window: int, threshold: int, failures: str, seen: str):
    """Open when the frame is full and the whole-number rate reaches the limit."""
    rate = F.floor(F.col(failures) * 100 / window)
    return (F.col(seen) == window) & (rate >= threshold)


def breaker_state(outcomes: DataFrame, n: int = WINDOW, threshold: int = THRESHOLD,
                  order: Sequence[str] = ("seq",), width: int = SLOT_WIDTH) -> DataFrame:
    """Add `position`, `failures` in the last n outcomes and `is_open`.

    (sink, order) must be unique and `order` end in an integer column. Works in
    slots, so a sink with most of the outcomes is spread over tasks.
    """
    numbered = number_rows(outcomes, ["sink"], order, "position", width)
    failed = F.when(F.col("success"), 0).otherwise(1)
    rolled = rolling(numbered, ["sink"], "position", n - 1, {
        "failures": lambda w: F.sum(failed).over(w.rowsBetween(1 - n, 0)),
    }, width)
    full = F.least(F.col("position") + 1, F.lit(n))
    return (rolled.withColumn("_seen", full)
            .withColumn("is_open", _open(n, threshold, "failures", "_seen"))
            .drop("_seen"))


def latest_state(states: DataFrame) -> DataFrame:
    """The newest breaker state of every sink."""
    return states.groupBy("sink").agg(F.max_by("is_open", "position").alias("is_open"))


def defer_when_open(requests: DataFrame, latest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests to send, requests to defer while their sink's breaker is open)."""
    known = join_per_key(requests, latest.select("sink", F.col("is_open").alias("_open")),
                         ["sink"], "first_offset", "left")
    is_open = F.coalesce("_open", F.lit(False))
    return known.filter(~is_open).drop("_open"), known.filter(is_open).drop("_open")


def breaker_with_reset(outcomes: DataFrame, reset_s: float, n: int = WINDOW,
                       threshold: int = THRESHOLD, order: Sequence[str] = ("seq",),
                       at: str = "at_s", width: int = SLOT_WIDTH) -> DataFrame:
    """Breaker that closes and forgets its window once open for `reset_s`.

    `at` is the time of an outcome in seconds; a clock that goes back counts as standing
    still. Adds `position`, `failures` and `is_open`.

    Where the breaker opens depends on its own past, but what follows an opening does
    not: each row at which it could open has one end (`openings`) and one row where it
    opens next. The rows that are reached from a sink's first are marked by pointer
    doubling: each round joins the marked rows with jumps twice as long, so a sink that
    opens very often takes the logarithm of that in rounds, spread over all tasks.

    Everything with rows per outcome, opening or run is joined by merge: files of it are
    far smaller than its rows, so by their size it would be broadcast.
    """
    steps = stage(openings(outcomes, reset_s, n, threshold, order, at, width), "openings")
    states = steps.select(*outcomes.columns, "position", "failures")
    edges = steps.filter("ends IS NOT NULL").select("sink", "position", "ends", "next")
    opened = reached(edges, steps.filter("first").select("sink", "position"))
    spans = opened.join(edges.select("sink", "position", "ends").hint("merge"), ["sink", "position"])
    changes = spans.select("sink", "position", F.lit(1).alias("change")).unionByName(
        spans.select("sink", F.col("ends").alias("position"), F.lit(-1).alias("change")))
    changes = changes.groupBy("sink", "position").agg(F.sum("change").alias("_change"))
    marked = states.join(changes.hint("merge"), ["sink", "position"], "left")
    return (running_sum(marked, ["sink"], ["position"], F.coalesce("_change", F.lit(0)), "_open", width)
            .withColumn("is_open", F.col("_open") > 0).drop("_open", "_change"))


def openings(outcomes: DataFrame, reset_s: float, n: int, threshold: int, order: Sequence[str],
             at: str, width: int) -> DataFrame:
    """Outcomes with `first` (the sink's first row at which the breaker opens) and, for
    rows at which it could open, `ends` (the row at which it would close again) and
    `next` (the next row at which it would open then, NULL if none).

    A run is a stretch of rows with the limit reached. An opening ends at the first
    row behind its run, or, after `reset_s`, at a row inside it or that row; then the next
    opening is n - 1 rows later at least. The row of the reset is found by counting:
    rows of a run follow each other, so it is the run's start plus the number of its
    rows with an earlier time, counted in slots of time.
    """
    states = stage(breaker_state(outcomes, n, threshold, order, width), "breaker")
    states = running_max(states, ["sink"], ["position"], F.round(F.col(at) * 1_000_000), "_at", width)
    hot = F.col("is_open")
    states = rolling(states, ["sink"], "position", 1, {
        "_was_hot": lambda w: F.coalesce(F.lag("is_open").over(w), F.lit(False))}, width)
    starts = F.when(hot & ~F.col("_was_hot"), 1).otherwise(0)
    states = stage(running_sum(states, ["sink"], ["position"], starts, "_run", width), "runs")

    runs = states.filter(hot).groupBy("sink", "_run").agg(
        F.min("position").alias("_from"), (F.max("position") + 1).alias("_to"))
    # Rows of a run and the one behind it, and the moments at which openings are over.
    rows = states.filter(hot | F.col("_was_hot")).select("sink", "_run", F.col("_at").alias("value"),
                                                         F.lit(None).cast("bigint").alias("position"))
    later = F.col("_at") + round(reset_s * 1_000_000)
    moments = states.filter(hot).select("sink", "_run", later.alias("value"), "position")
    slot = F.floor(F.col("value") / max(round(reset_s * 1_000_000), 1)).alias("slot")
    both = rows.unionByName(moments).select("*", slot)
    row = F.when(F.col("position").isNull(), 1).otherwise(0)
    before = (Window.partitionBy("sink", "_run").orderBy("slot")
              .rowsBetween(Window.unboundedPreceding, -1))
    slots = both.groupBy("sink", "_run", "slot").agg(F.sum(row).alias("rows")).select(
        "sink", "_run", "slot", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    # Moments come before rows of the same time, which are not earlier.
    inside = (Window.partitionBy("sink", "_run", "slot").orderBy("value", row)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = (both.withColumn("inside", F.sum(row).over(inside)).filter("position IS NOT NULL")
               .join(slots.hint("merge"), ["sink", "_run", "slot"])
               .select("sink", "_run", "position", (F.col("before") + F.col("inside")).alias("earlier")))
    reset_at = F.col("_from") + F.col("earlier")
    ends = join_per_key(earlier, runs.hint("merge"), ["sink", "_run"], "position").select(
        "sink", "position", F.least(reset_at, "_to").alias("ends"),
        F.when(reset_at <= F.col("_to"), reset_at + n - 1).otherwise(F.col("_to")).alias("_wanted"))
    # Behind the last row of all, a reset was only counted to, not reached.
    counted = states.groupBy("sink").agg(F.count("*").alias("_count"))
    ends = join_per_key(ends, counted, ["sink"], "position").withColumn(
        "_wanted", F.when(F.col("_wanted") < F.col("_count"), F.col("_wanted"))).drop("_count")
    there = states.select("sink", F.col("position").alias("_wanted"), F.col("is_open").alias("_hot"), "_run")
    ends = ends.join(there.hint("merge"), ["sink", "_wanted"], "left")
    following = runs.select("sink", (F.col("_run") - 1).alias("_run"), F.col("_from").alias("_later"))
    ends = join_per_key(ends, following.hint("merge"), ["sink", "_run"], "position", "left").select(
        "sink", "position", "ends", F.when(F.col("_hot"), F.col("_wanted")).otherwise(F.col("_later")).alias("next"))
    return states.join(ends.hint("merge"), ["sink", "position"], "left").withColumn(
        "first", hot & ~F.col("_was_hot") & (F.col("_run") == 1)).drop("is_open", "_at", "_was_hot", "_run")


def reached(edges: DataFrame, first: DataFrame) -> DataFrame:
    """The rows (sink, position) that lead from the first ones along `next`."""
    jumps = edges.select("sink", "position", "next")
    found = stage(first, "reached")
    while True:
        jumps = stage(jumps.filter("next IS NOT NULL"), "jumps")
        if jumps.isEmpty():
            return found
        more = found.join(jumps.hint("merge"), ["sink", "position"]).select("sink", F.col("next").alias("position"))
        found = stage(found.unionByName(more).distinct(), "reached")
        onward = jumps.select("sink", F.col("position").alias("next"), F.col("next").alias("_far"))
        jumps = jumps.join(onward.hint("merge"), ["sink", "next"]).select("sink", "position", F.col("_far").alias("next"))
