"""The delivery ledger: which offsets are done and how far a partition got.

One row per record read: topic, partition, offset, batch_id and `committable`,
plus the columns the metrics use (see `relay.operators.metrics`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relay.operators.batching import PARTITION
from relay.operators.positions import SLOT_WIDTH, join_per_key


def mark_done(ledger: DataFrame, done: DataFrame) -> DataFrame:
    """Make the offsets of finished batches committable. Batches the ledger does
    not know are ignored; a batch has few rows, so the join has no hot key."""
    finished = done.select("batch_id").distinct().withColumn("_done", F.lit(True))
    return (ledger.join(finished, "batch_id", "left")
            .withColumn("committable", F.col("committable") | F.col("_done").isNotNull())
            .select(*ledger.columns))


def mark_immediate(ledger: DataFrame, skipped: DataFrame) -> DataFrame:
    """Append records that need no delivery; they are committable at once."""
    rows = skipped.select(*[c for c in ledger.columns if c in skipped.columns and c != "committable"])
    return ledger.unionByName(rows.withColumn("committable", F.lit(True)), allowMissingColumns=True)


def _stretches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Open offsets, and done offsets between two open ones as one row. Open offsets
    that a done row covers are done."""
    in_order = Window.partitionBy(*keys).orderBy("first", F.desc("committable"))
    done, until = F.col("committable"), in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(done, F.col("next"))).over(until)
    rows = rows.withColumn("_reach", reach).filter(done | F.col("_reach").isNull() | (F.col("_reach") <= F.col("first")))
    rows = rows.withColumn("_opened", F.count_if(~done).over(until))
    return rows.groupBy(*keys, "committable", "_opened").agg(
        F.min("first").alias("first"), F.max("next").alias("next")).drop("_opened")


def intervals(ledger: DataFrame, previous: DataFrame | None = None, width: int = SLOT_WIDTH) -> DataFrame:
    """What is known of each partition's offsets, as (topic, partition, first, next,
    committable): a row for every stretch of done offsets that no registered open one
    interrupts, and a row for every open offset.

    `previous` is the same of earlier micro-batches; the result takes the ledger's rows
    in. It has as many rows as there are open offsets and stretches between them,
    however many offsets are done. Offsets of a partition are registered in ascending
    order, so one that comes again inside a done stretch is done. Tasks order slots of
    `width` offsets; only stretches and open offsets meet for a whole partition.
    """
    rows = ledger.select(*PARTITION, F.col("offset").alias("first"), (F.col("offset") + 1).alias("next"), "committable")
    if previous is not None:  # before slots are cut: its open offsets interrupt the new rows, too
        rows = rows.unionByName(previous.select(*PARTITION, "first", "next", "committable"))
    slot = F.col("first") - F.pmod(F.col("first"), F.lit(width).cast("bigint"))
    found = _stretches(rows.withColumn("_slot", slot), [*PARTITION, "_slot"]).drop("_slot")
    return _stretches(found, PARTITION)


def committed(known: DataFrame) -> DataFrame:
    """Next offset to read per partition from its `intervals`: the end of the first
    stretch. No row where the first offset is open."""
    first = known.groupBy(*PARTITION).agg(F.min_by(F.struct("committable", "next"), "first").alias("_first"))
    return first.filter("_first.committable").select(*PARTITION, F.col("_first.next").alias("next_offset"))


def committable_offsets(ledger: DataFrame) -> DataFrame:
    """Next offset to read per partition: one past the registered offsets that
    come before the first one not committable. No row where nothing is done.

    Two partial aggregates and no window: the first gap of each partition, then
    the highest offset below it.
    """
    rows = ledger.select(*PARTITION, "offset", "committable")
    gaps = (rows.filter(~F.col("committable")).groupBy(*PARTITION)
            .agg(F.min("offset").alias("_gap")))
    below = join_per_key(rows.filter("committable"), gaps, PARTITION, "offset", "left").filter(
        F.col("_gap").isNull() | (F.col("offset") < F.col("_gap")))
    return below.groupBy(*PARTITION).agg((F.max("offset") + 1).alias("next_offset"))


def prune(ledger: DataFrame, committed: DataFrame) -> DataFrame:
    """Drop the offsets below each partition's committed offset."""
    limits = committed.select(*PARTITION, F.col("next_offset").alias("_limit"))
    known = join_per_key(ledger, limits, PARTITION, "offset", "left")
    return known.filter(F.col("_limit").isNull() | (F.col("offset") >= F.col("_limit"))).drop("_limit")


def commit_report(previous: DataFrame, now: DataFrame) -> DataFrame:
    """Partitions whose next offset moved on since the last commit.

    Both sides have one row per partition of a topic.
    """
    before = previous.groupBy(*PARTITION).agg(F.max("next_offset").alias("previous_offset"))
    return (now.join(before, PARTITION, "left")
            .filter(F.col("previous_offset").isNull() | (F.col("next_offset") > F.col("previous_offset")))
            .select(*PARTITION, "previous_offset", "next_offset"))
