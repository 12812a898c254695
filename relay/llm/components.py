"""Connected components of a table of links, without driver or single-task steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.session import stage


# Links that a task goes through at least: few links in many tasks would only make
# shuffles of files without rows.
LINKS_A_TASK = 50_000


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v): the smallest node that can
    be reached. Nodes without a link to another node are left out.

    Alternates two steps until nothing changes, which takes about log2 of the longest
    chain: every node's larger neighbours are linked to its smallest one, then its
    smaller neighbours. Minima are combined before the shuffle, so a node with very
    many links costs no more than others; each round is a stored table.
    """
    links = stage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "links")
    mark = _mark(links)
    while True:
        # No round makes links: those of a round are at most those of the one before.
        tasks = max(8, mark[0] // LINKS_A_TASK)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").coalesce(tasks)
        links = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
                      .coalesce(tasks), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
