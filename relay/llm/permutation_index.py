"""Approximate nearest neighbours by a permutation index.

Vectors are represented by the order of their nearest pivots: the PREFIX nearest of
PIVOTS, which are picked far from each other out of a bounded sample. In each block of
rows every pivot has an inverted file: the place that the pivot takes in the order of
each row, PREFIX where it is not among the nearest. A query reads the files of its own
nearest pivots and sums up PREFIX - max(place of the query, place of the row), which is
the footrule distance of the two orders turned round: footrule = PREFIX * (PREFIX + 1)
- 2 * sum - (places behind PREFIX, the same for all). Rows within a footrule radius are
candidates, and their inner products with the query are computed in double precision.

The radius is the quantile SHARE of the distances among sampled vectors, so it follows
the data, and all rows within it are candidates: there is no cap, and a group of near
copies is inside or outside as a whole. One radius does not fit every query, so each
query also ranks the rows by footrule for itself: of each block, the share SHARE nearest
to it and at least CANDIDATES rows, with all that tie with the last, are candidates, too.
Tables of up to CANDIDATES rows are compared whole, and no query goes short. Pivot orders
tell directions but not lengths, which inner products follow as well: rows are ranked
among those of their own length, up to a factor of STEP, so long ones get their turn.
Every row is indexed. Rows and queries are dealt into blocks of bounded size, and each
pair of blocks is one task.

Vectors that are null, zero or of another length than most, hold null or non-finite
components, or have a null id take no part. Rows that repeat an id are candidates of
their own; a query is never compared with rows of its own id. Ties go to the smaller
id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relay.session import ship, stage

PIVOTS = 192
PREFIX = 128
SHARE = 0.25
CANDIDATES = 1024
STEP = 1.25
SAMPLE = 2000
ROW_BLOCK = 8192
QUERY_BLOCK = 2048


def usable(df: DataFrame, vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def pick_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Vectors of the sample, each the least similar to those picked before."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def places(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Place of every pivot in the order of each vector, one row per pivot."""
    prefix = min(PREFIX, len(pivots))
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]
    out = np.full((len(vectors), len(pivots)), prefix, np.uint8)
    np.put_along_axis(out, order, np.broadcast_to(np.arange(prefix, dtype=np.uint8), order.shape), axis=1)
    return np.ascontiguousarray(out.T)


def agreement(query: np.ndarray, files: np.ndarray, prefix: int) -> np.ndarray:
    """Footrule of a query with all rows of a block, turned round: large is near."""
    total = np.zeros(files.shape[1], np.uint16)
    for pivot in np.flatnonzero(query < prefix):
        total += prefix - np.maximum(files[pivot], query[pivot])
    return total


def radius(sample: np.ndarray, pivots: np.ndarray, share: float) -> float:
    """The agreement that the given share of pairs of the sample reaches."""
    files = places(sample, pivots)
    prefix = min(PREFIX, len(pivots))
    some = np.unique(np.linspace(0, len(sample) - 1, min(400, len(sample))).astype(int))
    each = []
    for i in some:
        near = agreement(files[:, i], files, prefix)
        each.append(np.delete(near, i))
    values = np.concatenate(each)
    return float(np.quantile(values, 1 - share)) if len(values) else 0.0


def by_length(vectors: np.ndarray) -> list[np.ndarray]:
    """Rows of a block by classes of their lengths."""
    length = np.maximum(np.linalg.norm(vectors, axis=1), np.finfo(float).tiny)
    # Classes are centred on length 1, so rounding does not split unit vectors.
    kind = np.round(np.log(length) / np.log(STEP))
    return [np.flatnonzero(kind == k) for k in np.unique(kind)]


def candidates(agrees: np.ndarray, limit: float, classes: list[np.ndarray], share: float, spare: int) -> np.ndarray:
    """Which rows of a block a query is compared with; `spare` rows have its own id."""
    near = agrees >= limit
    for rows in classes:
        take = max(CANDIDATES, int(np.ceil(share * len(rows)))) + spare
        if take >= len(rows):
            near[rows] = True
        else:
            own = agrees[rows]
            near[rows] |= own >= np.partition(own, len(own) - take)[len(own) - take]
    return near


def search(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
           share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for every row that
    meets the condition `queries`."""
    spark = ship(rows.sparkSession)
    kept = rows.filter(F.col(key).isNotNull() & usable(rows, vector)).select(
        F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asks"))
    kept = stage(kept, "vectors")
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], empty)
    kept = kept.filter(F.size("v") == common["n"])
    count, asking = kept.agg(F.count("*"), F.count_if("asks")).first()
    # The sample: the rows with the smallest hashes, as many at every size.
    sample = np.array([r["v"] for r in kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()])
    pivots = pick_pivots(sample)
    limit = radius(sample, pivots, share)
    prefix = min(PREFIX, len(pivots))
    row_blocks, query_blocks = -(-count // ROW_BLOCK), max(1, -(-asking // QUERY_BLOCK))

    deal = F.xxhash64("id", F.lit("deal"))
    left = kept.select("id", "v", F.pmod(deal, F.lit(row_blocks)).cast("int").alias("r"),
                       F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"))
    right = kept.filter("asks").select("id", "v", F.pmod(deal, F.lit(query_blocks)).cast("int").alias("q"),
                                       F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("r"))

    def nearest(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(asked):
            block = block.sort_values("id", kind="stable")
            ids, vectors = block["id"].to_numpy(), np.stack(block["v"].to_numpy())
            own = np.stack(asked["v"].to_numpy())
            files, orders = places(vectors, pivots), places(own, pivots)
            classes = by_length(vectors)
            for i, query in enumerate(asked["id"].to_numpy()):
                others = ids != query
                agrees = agreement(orders[:, i], files, prefix)
                near = np.flatnonzero(candidates(agrees, limit, classes, share, np.count_nonzero(~others)) & others)
                scores = vectors[near] @ own[i]
                if len(near) > k:
                    # All that tie with the k-th stay; the smaller ids win.
                    worst = np.partition(scores, len(scores) - k)[len(scores) - k]
                    near, scores = near[scores >= worst], scores[scores >= worst]
                best = np.argsort(-scores, kind="stable")[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[near[best]], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInPandas(
        nearest, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
