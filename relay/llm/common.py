"""Reading tables and numbering rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NUMBER_BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, *tables: DataFrame) -> str:
    """The name, or a longer one that no column of the tables has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def said(role: str, text: str) -> Column:
    """A digest of 32 bytes that is equal for equal (role, text)."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), F.col(role), F.col(text)), 256))


def number_within(df: DataFrame, groups: list[str], row: str, name: str) -> DataFrame:
    """Add `name`: the rows of each group numbered from 0 without gaps.

    `row` is a long that is unique in the table; `df` must be a stored table, as it
    is read twice. A group may hold any share of the rows: its rows are dealt into
    NUMBER_BUCKETS buckets, a task orders one bucket, and only the bucket counts, at
    most NUMBER_BUCKETS rows per group, are summed up in order.
    """
    bucket = F.pmod(F.xxhash64(row), F.lit(NUMBER_BUCKETS)).cast("int")
    dealt = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(*keys).count()
              .select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                      F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(row)) - 1
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    condition: Column = same[0]
    for part in same[1:]:
        condition = condition & part
    return (dealt.withColumn("_inside", inside).join(starts, condition)
            .withColumn(name, F.col("_start") + F.col("_inside"))
            .drop("_bucket", "_inside", "_start", *[f"_s_{k}" for k in keys]))
