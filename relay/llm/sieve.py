"""Keeping rows that cannot match out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.llm.common import fresh
from relay.session import stage

SIEVE_WORDS = 1 << 16


def constant_array(values: DataFrame, size: int, label: str) -> Column:
    """The values (at, value) of `size` places as an array that expressions can look up,
    0 where there is none. It is a stored row, read by a scalar subquery: plans name it,
    and do not hold its entries. It must not stand inside a lambda function."""
    places = values.sparkSession.range(size, numPartitions=1).select(F.col("id").cast("int").alias("place"))
    each = F.struct("place", F.coalesce("value", F.lit(0)).alias("value"))
    row = (places.join(values, F.col("place") == F.col("at"), "left").coalesce(8).agg(F.sort_array(F.collect_list(each)).alias("all"))
           .select(F.transform("all", lambda x: x["value"]).alias("all")))
    return stage(row, label).scalar()


def sieve(ids: DataFrame, of: str = "doc_id", words: int = SIEVE_WORDS) -> Column:
    """A condition on the column `of` that every id of a table meets and most others do not.

    A bit map of fixed size, filled by an aggregate with at most `words` rows. When
    it is full it lets everything pass. Null ids do not meet it.
    """
    h = F.xxhash64(of)
    at = F.pmod(F.shiftright(h, 6), F.lit(words)).cast("int")
    bit = F.pmod(h, F.lit(64)).cast("int")
    filled = (ids.select(at.alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
              .groupBy("at").agg(F.bit_or("bit").alias("value")))
    held = constant_array(filled, words, "sieve")
    return F.col(of).isNotNull() & (F.getbit(F.get(held, at), bit) == 1)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in a stored table of doc_ids. Only those that
    may be in it are shuffled; documents without doc_id stay."""
    may = F.coalesce(sieve(ids), F.lit(False))
    name = fresh("_gone", docs)
    gone = ids.select(F.col("doc_id").alias(name)).distinct()
    rest = docs.filter(may).join(gone, F.col("doc_id") == F.col(name), "left_anti")
    return docs.filter(~may).unionByName(rest)
