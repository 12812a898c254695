"""Positions and rolling frames that hold when one group has most of the rows.

A plain window over (topic, partition) puts a whole partition into one task.
Here the order column is cut into slots of `width` values. An integer order
column that is unique in its group has at most `width` rows in a slot, so every
task sorts a bounded number of rows; only one summary row per slot, a
`width`-th of a densely numbered input, is ordered within its group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_WIDTH = 65_536


def _slot_of(order: str, width: int) -> Column:
    """Start of the slot a value falls in (exact for every bigint)."""
    return F.col(order) - F.pmod(F.col(order), F.lit(width).cast("bigint"))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                name: str, width: int = SLOT_WIDTH, descending: bool = False) -> DataFrame:
    """Add the sum of `value` over a row and all rows before it in its group.

    `order` ends in an integer column; (keys, order) must be unique and keys
    not NULL. The summary of slots is joined back on (keys, slot), where the hottest
    value has `width` rows. With many small groups it has nearly as many rows as the
    input, which file sizes do not tell, so it is never broadcast; the rows need that
    shuffle and order for their sums anyway.
    """
    return _running(df, keys, order, value, name, width, descending, F.sum,
                    lambda before, inside: F.coalesce(before, F.lit(0)) + inside)


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                name: str, width: int = SLOT_WIDTH) -> DataFrame:
    """As `running_sum`, with the largest integer value in place of the sum."""
    return _running(df, keys, order, value, name, width, False, F.max, F.greatest)


def _running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, width: int,
             descending: bool, total: Callable[[str], Column], add: Callable[[Column, Column], Column]) -> DataFrame:
    *outer, last = order
    slot_keys = [*keys, *outer, "_slot"]
    rows = df.withColumns({"_slot": _slot_of(last, width), "_value": value.cast("bigint")})

    def sort(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    before = (Window.partitionBy(*keys).orderBy(*[sort(c) for c in [*outer, "_slot"]])
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy(*slot_keys).agg(total("_value").alias("_total")).select(
        *slot_keys, total("_total").over(before).alias("_before"))

    inside = (Window.partitionBy(*slot_keys).orderBy(sort(last))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.join(starts.hint("merge"), slot_keys)
            .withColumn(name, add(F.col("_before"), total("_value").over(inside)))
            .select(*df.columns, name))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position",
                width: int = SLOT_WIDTH, descending: bool = False) -> DataFrame:
    """Add the 0-based position of each row in its group."""
    numbered = running_sum(df, keys, order, F.lit(1), name, width, descending)
    return numbered.withColumn(name, F.col(name) - 1)


def rolling(df: DataFrame, keys: Sequence[str], position: str, reach: int,
            columns: dict[str, Column], width: int = SLOT_WIDTH) -> DataFrame:
    """Add window columns that look back at most `reach` rows.

    `position` counts the rows of a group without gaps. The last `reach` rows
    of each slot are copied in front of the next one, so every frame is whole
    inside its slot. `columns` maps names to functions of the window to use:
    they are applied in order, later ones may use earlier ones.
    """
    width = max(width, reach)
    own = _slot_of(position, width)
    near_end = F.col(position) - own >= width - reach
    copies = F.when(near_end, F.array(own, own + width)).otherwise(F.array(own))
    wide = df.withColumn("_slot", F.explode(copies))
    window = Window.partitionBy(*keys, "_slot").orderBy(position)
    for name, build in columns.items():
        wide = wide.withColumn(name, build(window))
    return wide.filter(F.col("_slot") == own).drop("_slot")


def join_per_key(rows: DataFrame, summary: DataFrame, keys: Sequence[str], spread: str,
                 how: str = "inner", salts: int | None = None) -> DataFrame:
    """Join rows with a table that has one row per key, safe for hot keys.

    The summary is repeated once per salt and rows pick a salt from the integer
    column `spread`, so one key spreads over `salts` tasks when the join has to
    shuffle. There are as many salts as shuffle partitions, unless given. When the
    summary turns out small AQE broadcasts it instead.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.col(spread), F.lit(salts)).cast("int")
    repeated = summary.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
