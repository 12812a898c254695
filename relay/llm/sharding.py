"""Shards drawn down a weighted tree: region, rack, shard.

At every level a row draws one hash per child, divides its negative logarithm by the
child's weight and goes to the smallest draw. A child's weight is the sum of the
weights below it, so every shard gets rows in proportion to its weight. A draw
depends on the key and the child alone: when a weight changes, rows only move into
or out of the children whose weights changed, and nothing moves in other subtrees.

Expressions only, no shuffle; the key may be null (all null keys share one shard),
rows may repeat (equal keys go to the same shard), and an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.llm.common import number_within
from relay.session import stage

BASE_SHARDS, SHARDS_PER_RACK, RACKS_PER_REGION = 16, 4, 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int) -> list[Leaf]:
    """The first 16 shards stand four to a rack and two racks to a region. Each later
    shard opens a region of its own, so that the weight of no older subtree changes
    and a grown tree takes rows only into the new shard."""
    if shards < 1:
        raise ValueError("at least one shard")
    leaves = []
    for shard in range(shards):
        rack = shard // SHARDS_PER_RACK if shard < BASE_SHARDS else BASE_SHARDS // SHARDS_PER_RACK + shard - BASE_SHARDS
        region = rack // RACKS_PER_REGION if shard < BASE_SHARDS else BASE_SHARDS + shard
        leaves.append(Leaf(region, rack, shard))
    return leaves


def draw(key: Column, level: str, child: int, weight: float) -> Column:
    """An exponential draw of rate `weight`, the same for a key and a child everywhere."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 11)
    return -F.log((bits.cast("double") + 0.5) * F.lit(2.0 ** -53)) / F.lit(float(weight))


def _smallest(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    drawn = [F.struct(draw(key, level, child, w).alias("drawn"), F.lit(child).alias("child"))
             for child, w in weights.items()]
    return F.least(*drawn)["child"]


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key in a tree. Shards of weight 0 get nothing."""
    leaves = [leaf for leaf in leaves if leaf.weight > 0]
    if not leaves:
        raise ValueError("all weights are 0")

    def weights(of, among):
        total: dict[int, float] = {}
        for leaf in among:
            total[of(leaf)] = total.get(of(leaf), 0.0) + leaf.weight
        return total

    def inside(level, children, below):
        """Draw one of the children, then go on below the one drawn."""
        drawn = _smallest(key, level, children)
        chosen = None
        for child in children:
            then = below(child)
            chosen = F.when(drawn == child, then) if chosen is None else chosen.when(drawn == child, then)
        return chosen

    def shards(rack):
        return _smallest(key, "shard", weights(lambda x: x.shard, [x for x in leaves if x.rack == rack]))

    def racks(region):
        among = [x for x in leaves if x.region == region]
        return inside("rack", weights(lambda x: x.rack, among), shards)

    return inside("region", weights(lambda x: x.region, leaves), racks).cast("int")


def place(df: DataFrame, key: str, leaves: list[Leaf], name: str = "shard") -> DataFrame:
    """Add the shard of every row. All rows and columns stay."""
    return df.withColumn(name, shard_of(F.col(key), leaves))


def manifest(docs: DataFrame, shards: int = BASE_SHARDS) -> DataFrame:
    """Where every document goes, and its place there.

    doc_id, size (bytes of the text, none for null, plus 1), text_crc32 (0 for null),
    law, shard, slot (rows of a shard numbered from 0) and grown_shard (the shard in a
    tree with one more). Texts are read once; only the digests are stored and
    numbered, so a shard of any size needs no task of its own.
    """
    digest = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"))
    digest = place(digest, "doc_id", topology(shards))
    digest = place(digest, "doc_id", topology(shards + 1), "grown_shard")
    stored = stage(digest.withColumn("_row", F.monotonically_increasing_id()), "sharding")
    return number_within(stored, ["shard"], "_row", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
