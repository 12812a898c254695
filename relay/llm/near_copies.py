"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full sets.

Two collections of half keys, A (24 of 3 minhashes) and B (15 of 2), are computed for
each set of shingles: 102 minhash values. Table (i, j) has the key (A_i, B_j), so they
make 360 tables of 5 values each. Sets of similarity s meet in a table with
probability (1 - (1 - s^3)^24) * (1 - (1 - s^2)^15): above 0.999993 at 0.75.

1. Equal sets are one node: copies are counted, not compared.
2. Half keys A that two nodes share are found first; only those are combined with B.
3. Nodes with more than a quarter of shingles that no other node holds cannot be linked
   and go out. That spares groups of half-similar texts all their pairs.
4. In turns, each table has a centre, every node of another component is paired with
   the centre it meets most often, and these pairs are compared on full sets. Each turn
   is linear in the nodes and links most of a group of copies, until few pairs do.
5. Where tables still hold nodes of different components, all pairs across components
   that meet are compared, each once. So no link is lost between nodes that meet, and
   no pair inside a component is made.

Documents with null or empty texts, or a null doc_id, are linked with nothing. Rows
that repeat a doc_id count as one document with several texts. Other columns than
doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.llm import words
from relay.llm.components import components
from relay.llm.sieve import sieve
from relay.session import ship, stage

SHINGLE = 5
PERCENT = 75
A_KEYS, A_WIDTH = 24, 3
B_KEYS, B_WIDTH = 15, 2
# More turns save pairs of the last step and do not change the result.
TURNS = 8
YIELD = 0.05
_CHUNK = 1 << 14


def minhash_parameters(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    factors = random.integers(0, 2 ** 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 2 ** 63, count, dtype=np.uint64)


def minhashes(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    best = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        hashed = np.multiply.outer(factors, shingles[i:i + _CHUNK]) + shifts[:, None]
        np.minimum(best, hashed.min(axis=1), out=best)
    return best


def half_keys(values: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Runs of `width` minhash values hashed together with their place, for one set or,
    in rows, for many."""
    parts = values.reshape(*values.shape[:-1], values.shape[-1] // width, width)
    key = np.arange(parts.shape[-2], dtype=np.uint64) + np.uint64(salt)
    for i in range(width):
        key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[..., i])
    return key.astype(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, two hashes of the set, half keys a and b."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = minhash_parameters(A_KEYS * A_WIDTH + B_KEYS * B_WIDTH, 7)
        cut = A_KEYS * A_WIDTH
        for batch in batches:
            for part in words.slices(batch):
                own, begins = words.hashes(part.column("text"))
                n, s1, s2, values = [], [], [], []
                for i in range(part.num_rows):
                    held = words.shingle_set(own[begins[i]:begins[i + 1]], SHINGLE)
                    n.append(len(held))
                    # Sums of mixed values: equal sets have equal sums, others hardly.
                    s1.append(int(held.sum(dtype=np.uint64).astype(np.int64)))
                    s2.append(int(words.mix(held ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    if len(held):
                        values.append(minhashes(held, factors, shifts))
                rows = np.array(values, dtype=np.uint64).reshape(len(values), len(factors))
                # Empty sets have no keys.
                starts = np.concatenate([[0], np.cumsum(np.array(n) > 0)])
                a, b = (pa.ListArray.from_arrays(pa.array(starts * keys.shape[1], pa.int32()), pa.array(keys.ravel()))
                        for keys in (half_keys(rows[:, :cut], A_WIDTH, 1), half_keys(rows[:, cut:], B_WIDTH, 1001)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                     pa.array(s2, pa.int64()), a, b], ["doc_id", "n_shingles", "s1", "s2", "a", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, s1 long, s2 long, a array<long>, b array<long>")


def shingle_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, shingle) of the full sets of the documents in a stored table of ids."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                own, begins = words.hashes(part.column("text"))
                each = [words.shingle_set(own[begins[i]:begins[i + 1]], SHINGLE) for i in range(part.num_rows)]
                n = np.array([len(s) for s in each], dtype=np.int64)
                doc = np.repeat(np.asarray(part.column("doc_id"), dtype=np.int64), n)
                shingle = np.concatenate(each).astype(np.int64) if each else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(np.repeat(n, n)), pa.array(shingle)],
                                                 ["doc_id", "n_shingles", "shingle"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(sieve(ids))
    return texts.mapInArrow(run, "doc_id long, n_shingles long, shingle long").join(ids, "doc_id", "left_semi")


def linkable(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Those ids whose sets can be linked with another one of them at all.

    A link needs three quarters of either set in common, so shingles that stand in no
    other set must not be more than a quarter. They are counted without a join: a
    shingle with one document is that document's own.
    """
    rows = shingle_rows(docs, ids)
    held = rows.groupBy("shingle").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id"),
                                       F.min("n_shingles").alias("n_shingles"))
    own = held.filter("c = 1").groupBy("doc_id", "n_shingles").agg(F.count("*").alias("own"))
    sizes = ids.join(own, ["doc_id", "n_shingles"], "left")
    return (sizes.filter((100 - PERCENT) * F.col("n_shingles") >= 100 * F.coalesce("own", F.lit(0)))
            .select("doc_id").distinct())


def confirm(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those pairs (u, v) whose full shingle sets are similar enough."""
    ship(docs.sparkSession)
    ids = pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(sieve(ids))
    # u is the member of a star, v its centre: rows come grouped by centre.
    joined = (pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u")
              .join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last_set = None, None
        for batch in batches:
            for part in words.slices(batch, "text_u"):
                own, begins = words.hashes(part.column("text_u"))
                linked = []
                for i, text in enumerate(part.column("text_v").to_pylist()):
                    if text != last_text:
                        other, _ = words.hashes(pa.array([text]))
                        last_text, last_set = text, words.shingle_set(other, SHINGLE)
                    held = words.shingle_set(own[begins[i]:begins[i + 1]], SHINGLE)
                    small, large = sorted((held, last_set), key=len)
                    if not len(small) or 100 * len(small) < PERCENT * len(large):
                        linked.append(False)
                        continue
                    at = np.searchsorted(large, small)
                    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                    linked.append(100 * common >= PERCENT * (len(small) + len(large) - common))
                yield pa.RecordBatch.from_arrays(
                    [part.column("u"), part.column("v")], ["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return joined.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long").distinct()


def mixed(tables: DataFrame, label: DataFrame | None) -> DataFrame:
    """The rows of those tables that hold nodes of several components."""
    if label is None:
        placed = tables.withColumn("component", F.col("doc_id"))
    else:
        placed = (tables.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                  .withColumn("component", F.coalesce("component", "doc_id")))
    several = (placed.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q"))
               .filter("p < q").select("key"))
    return placed.join(several, "key")


def stars(placed: DataFrame, turn: int) -> DataFrame:
    """For every node the centre it meets most often: in each table one node, smallest in
    an order that changes with the turn, is the centre of all that are not yet its own."""
    centre = placed.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)).alias("o"), "doc_id", "component")).alias("c"))
    met = (placed.join(centre, "key").filter("component <> c.component")
           .groupBy(F.col("doc_id").alias("u"), F.col("c.doc_id").alias("v")).agg(F.count("*").alias("met")))
    return met.groupBy("u").agg(F.max_by("v", F.struct("met", "v")).alias("v"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    docs = docs.select("doc_id", "text")
    sketches = stage(sketch(docs), "sketches")
    sets = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    first = sets.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node"))
    member = stage(sets.select("doc_id", "s1", "s2", "n_shingles").join(first, ["s1", "s2", "n_shingles"])
                   .select("doc_id", "n_shingles", "node", "s1", "s2"), "members")
    nodes = stage(sets.join(first.select(F.col("node").alias("doc_id"), "s1", "s2", "n_shingles"),
                            ["doc_id", "s1", "s2", "n_shingles"], "left_semi")
                  .select("doc_id", "n_shingles", "a", "b"), "nodes")

    halves = nodes.select("doc_id", F.explode("a").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    found = halves.join(shared, "half").groupBy("doc_id").agg(F.collect_set("half").alias("halves"))
    every = (found.join(nodes.select("doc_id", "b"), "doc_id")
             .select("doc_id", F.explode("halves").alias("half"), "b")
             .select("doc_id", "half", F.explode("b").alias("other"))
             .select("doc_id", F.xxhash64("half", "other").alias("key")))
    every = stage(every, "tables")
    met = mixed(every, None).select("doc_id").distinct().join(nodes.select("doc_id", "n_shingles"), "doc_id")
    alive = linkable(docs, stage(met, "met"))
    tables = stage(every.join(alive, "doc_id", "left_semi"), "tables")

    links, tried, label = None, None, None
    for turn in range(TURNS):
        pairs = stage(stars(mixed(tables, label), turn), "stars")
        found = stage(confirm(docs, pairs), "links")
        links = found if links is None else links.unionByName(found)
        tried = pairs if tried is None else tried.unionByName(pairs)
        label = components(links)
        if turn and found.count() <= YIELD * pairs.count():
            break

    # Every pair of nodes that meets across components, in its first common half key.
    rest = mixed(tables, label).select("doc_id", "component").distinct()
    able = stage(rest.join(nodes.select("doc_id", "n_shingles"), "doc_id").select("doc_id", "n_shingles"), "able")
    rest = rest.join(linkable(docs, able), "doc_id", "left_semi")
    rest = stage(rest.join(nodes, "doc_id").select("doc_id", "component", "n_shingles", "a", "b"), "rest")
    rest = rest.withColumn("half", F.explode("a"))
    left, right = rest.alias("l"), rest.alias("r")
    across = (left.join(right, (F.col("l.half") == F.col("r.half")) & (F.col("l.component") < F.col("r.component"))
                        & (100 * F.col("l.n_shingles") >= PERCENT * F.col("r.n_shingles"))
                        & (100 * F.col("r.n_shingles") >= PERCENT * F.col("l.n_shingles"))
                        & (F.col("l.half") == F.array_min(F.array_intersect("l.a", "r.a")))
                        & F.arrays_overlap("l.b", "r.b"))
              .select(F.greatest("l.doc_id", "r.doc_id").alias("u"), F.least("l.doc_id", "r.doc_id").alias("v")))
    tried = tried.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    more = confirm(docs, stage(across.join(tried, ["u", "v"], "left_anti").distinct(), "across"))

    # Rows of one doc_id with different texts: their sets belong together.
    several = member.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("w")).filter("v < w")
    same_id = member.join(several.select("doc_id", "v"), "doc_id").select(F.col("node").alias("u"), "v")
    label = components(links.unionByName(more).unionByName(same_id))

    linked = (member.join(label, "node", "left")
              .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id")))
    alone = (sketches.filter("n_shingles = 0 OR doc_id IS NULL")
             .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
